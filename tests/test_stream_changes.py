"""Keyed changes as a stream against the batch operators and the one-at-a-time loop."""

import os
import random

import pytest
from pyspark.sql import functions as F

from aerolake.operators import changes, stats
from aerolake.streaming import changes as keyed
from aerolake.streaming import stats as kept
from test_changes import EMAILS, NOW, REQUESTS, random_requests, serial, shown, user, users_df


def run(spark, folder, users, batches, name="keyed", files_per_batch=None):
    """Each batch is put down and worked off by a stream that is started for it."""
    feed = f"{folder}/feed"
    for rows in batches:
        spark.createDataFrame(rows, REQUESTS).coalesce(1).write.mode("append").parquet(f"{folder}/requests")
        query = keyed.stream_changes(spark, users, f"{folder}/requests", feed, f"{folder}/checkpoint", name, F.lit(NOW),
                                     files_per_batch=files_per_batch)
        query.awaitTermination()
    return spark.read.schema(keyed.FEED).parquet(feed)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_restarts_equal_one_at_a_time(spark, folder):
    rng = random.Random(4)
    users = [user(e) for e in EMAILS[:6]] + [user("idle@x.org", role="admin")]
    requests = random_requests(rng, 150, ["insert", "delete", "update"], EMAILS, hot_share=0.5)
    start = users_df(spark, users)
    feed = run(spark, folder, start, [requests[:60], requests[60:61], requests[61:]])
    table, outcomes = serial(users, requests)
    assert {r.ordinal: r.outcome for r in keyed.request_outcomes(feed).collect()} == outcomes
    assert shown(keyed.users_after(start, feed).collect()) == shown(table.values())


@pytest.mark.parametrize("kind", ["insert", "update", "delete"])
def test_equals_the_batch_operators(spark, folder, kind):
    rng = random.Random(8)
    users = users_df(spark, [user(e) for e in EMAILS[:6]])
    requests = random_requests(rng, 80, [kind], EMAILS)
    requests += [(500, kind, EMAILS[0], {"phone_number": "not a number"}), (501, kind, EMAILS[1], {"unknown": "x"})]
    batch = spark.createDataFrame(requests, REQUESTS)
    if kind == "insert":
        after, judged = changes.insert_if_absent(users, batch, F.lit(NOW))
    elif kind == "update":
        after, judged = changes.partial_update(users, batch, F.lit(NOW))
    else:
        after, _, judged = changes.delete_by_email(users, batch)
    feed = run(spark, folder, users, [requests[:40], requests[40:]])
    assert sorted(keyed.request_outcomes(feed).collect()) == sorted(judged.select("ordinal", "op", "email", "outcome").collect())
    columns = after.columns
    assert sorted(map(repr, keyed.users_after(users, feed).select(columns).collect())) == sorted(map(repr, after.collect()))


def test_a_move_stops_the_stream(spark, folder):
    with pytest.raises(Exception, match="apply_changes"):
        run(spark, folder, users_df(spark, [user("a@x.org")]), [[(0, "update", "a@x.org", {"email": "b@x.org"})]], "moving")


def test_nothing_new_changes_nothing(spark, folder):
    users = users_df(spark, [user("a@x.org")])
    requests = [(0, "delete", "a@x.org", {}), (1, "insert", None, {"name": "n"}), (2, "update", "z@x.org", {"name": "n"})]
    feed = run(spark, folder, users, [requests, requests[:0]])
    assert {r.ordinal: r.outcome for r in keyed.request_outcomes(feed).collect()} == {0: "ok", 1: "rejected", 2: "not_found"}
    assert keyed.users_after(users, feed).collect() == []


def test_counts_follow_the_feed(spark, folder):
    """After every restart the kept statistics are those of a recount; a repeated batch counts once."""
    rng = random.Random(6)
    users = users_df(spark, [user(e, role=rng.choice(["admin", "user", None])) for e in EMAILS[:8]])
    requests = random_requests(rng, 90, ["insert", "delete", "update"], EMAILS)
    counts = f"{folder}/counts"
    kept.start_counts(users, counts)
    recount = lambda rows: sorted(map(repr, stats.user_stats(rows).collect()))
    assert sorted(map(repr, kept.current_stats(spark, counts).collect())) == recount(users)
    for i, part in enumerate((requests[:30], requests[30:31], requests[31:])):
        feed = run(spark, folder, users, [part])
        for _ in range(2):  # the second finds nothing new
            kept.keep_counts(spark, f"{folder}/feed", counts, f"{folder}/counts-checkpoint", f"counts{i}").awaitTermination()
        assert sorted(map(repr, kept.current_stats(spark, counts).collect())) == recount(keyed.users_after(users, feed))
    os.unlink(f"{counts}/v=3/_SUCCESS")  # a batch that was not finished is not shown
    assert sorted(map(repr, kept.current_stats(spark, counts).collect())) != recount(keyed.users_after(users, feed))


def test_all_users_gone(spark):
    before = spark.createDataFrame([("admin", None, "no", 3)], "role string, signatureStatus string, notifications string, c long")
    gone = spark.createDataFrame([("admin", None, "no", -3)], before.schema)
    left = stats.merged_combinations(before, gone)
    assert left.collect() == [] and [(r.breakdown, r.n) for r in stats.stats_of(left).collect()] == [("total", 0)]


def test_a_batch_holds_a_bounded_number_of_requests(spark, folder, monkeypatch):
    """Files follow each other by ordinal, none is large, and the result is that of one at a time."""
    from aerolake.plans import q_stream_changes

    monkeypatch.setattr(q_stream_changes, "MOST_REQUESTS", 20)
    users = [user(e) for e in EMAILS[:6]]
    requests = random_requests(random.Random(11), 90, ["insert", "delete", "update"], EMAILS, hot_share=0.7)
    batch = spark.createDataFrame(requests, REQUESTS)
    q_stream_changes.in_files(batch, f"{folder}/requests")
    files = spark.read.parquet(f"{folder}/requests").groupBy(F.input_file_name()).agg(
        F.count("*").alias("n"), F.min("ordinal").alias("low"), F.max("ordinal").alias("high"),
        F.max("_metadata.file_modification_time").alias("at")).orderBy("at").collect()
    assert sum(f.n for f in files) == 90 and max(f.n for f in files) <= 30
    assert all(a.high < b.low for a, b in zip(files, files[1:]))
    feed = q_stream_changes.in_two_runs(spark, users_df(spark, users), batch)
    table, outcomes = serial(users, requests)
    assert {r.ordinal: r.outcome for r in keyed.request_outcomes(feed).collect()} == outcomes
    assert len({r.email for r in feed.collect()}) > 1
    assert shown([{**u.asDict(), "updated_at": None, "created_at": None} for u in keyed.users_after(users_df(spark, users), feed).collect()]
                 ) == shown([{**dict(u), "updated_at": None, "created_at": None} for u in table.values()])


def test_one_address_in_one_batch_is_judged_in_parts(spark, folder):
    """Spans of a few ordinals, most requests for one address, and two with one ordinal: as one at a time."""
    users = [user(e) for e in EMAILS[:4]]
    requests = random_requests(random.Random(3), 120, ["insert", "delete", "update"], EMAILS, hot_share=0.8)
    state = users_df(spark, users)
    keyed._fill(spark, state, f"{folder}/home")
    stored = spark.read.schema(keyed.STATE).parquet(f"{folder}/home/v=0")
    batch = spark.createDataFrame(requests, REQUESTS)
    judged = keyed.judge(keyed.in_lives(keyed._stored(spark, keyed.ready_requests(batch), f"{folder}/ready"), span=7), stored)
    assert {r.ordinal: r.outcome for r in judged.collect()} == serial(users, requests)[1]
    fresh = [(0, "insert", "new@x.org", {"name": "N", "phone_number": "559100000000", "password": "long enough"})] * 2
    twice = keyed._stored(spark, keyed.ready_requests(spark.createDataFrame(fresh, REQUESTS)), f"{folder}/twice")
    assert sorted(r.outcome for r in keyed.judge(keyed.in_lives(twice), stored).collect()) == ["conflict", "ok"]


def test_a_batch_that_runs_again_adds_nothing(spark, folder):
    """It died before or after its commit: the feed has it once and the next state is the same."""
    home, feed = f"{folder}/home", f"{folder}/feed"
    keyed._fill(spark, users_df(spark, [user("a@x.org"), user("b@x.org")]), home)
    batch = spark.createDataFrame([(0, "update", "a@x.org", {"name": "n"}), (1, "delete", "b@x.org", {})], REQUESTS)
    shows = lambda: (sorted(map(repr, spark.read.schema(keyed.FEED).parquet(feed).collect())),
                     sorted(map(repr, spark.read.schema(keyed.STATE).parquet(f"{home}/v=1").collect())))
    keyed.change_users(spark, batch, home, feed, 0, F.lit(NOW))
    first = shows()
    keyed.change_users(spark, batch, home, feed, 0, F.lit(NOW))
    os.unlink(f"{home}/_commits/batch-0.done")  # it died before it was finished
    keyed.change_users(spark, batch, home, feed, 0, F.lit(NOW))
    assert shows() == first and len(first[0]) == 4 and len(first[1]) == 1
