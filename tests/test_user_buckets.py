"""The bucketed user table: equal to the batch operators, and no file touched that need not be."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from aerolake.operators import changes
from aerolake.plans import user_buckets as ub
from test_changes import NOW, REQUESTS, random_requests, shown, user, users_df

EMAILS = [f"u{i}@x.org" for i in range(40)]
BUCKETS = 8


@pytest.fixture()
def table(spark, folder):
    name = f"users_{uuid.uuid4().hex}"
    ub.create_user_table(spark, name, f"{folder}/users", BUCKETS, users_df(spark, [user(e) for e in EMAILS]))
    yield name
    spark.sql(f"DROP TABLE {name}")


def files(spark, table):
    """The data files of each bucket's folder."""
    out = {}
    for top, _, names in os.walk(ub.location_of(spark, table).removeprefix("file:")):
        found = {n for n in names if n.endswith(".parquet")}
        if found:
            out[int(os.path.basename(top).split("=")[1])] = found
    return out


def slots_of(spark, emails):
    rows = spark.createDataFrame([(e,) for e in emails], "email string")
    return {r[0] for r in rows.select(ub.slot_of(F.col("email"), BUCKETS)).collect()}


def test_a_bucket_is_a_folder(spark, table):
    found = files(spark, table)
    assert set(found) == slots_of(spark, EMAILS) and all(len(f) == 1 for f in found.values())
    for slot, names in found.items():
        assert all(f"_{slot:05d}" in n for n in names)  # Spark's own bucket number


@pytest.mark.parametrize("kind", ["insert", "update", "delete"])
def test_equal_to_the_batch_operators(spark, table, kind):
    rng = random.Random(2)
    emails = EMAILS[:12] + [f"new{i}@x.org" for i in range(6)]
    requests = spark.createDataFrame(random_requests(rng, 60, [kind], emails), REQUESTS)
    before = users_df(spark, [user(e) for e in EMAILS])
    if kind == "insert":
        after, judged = changes.insert_if_absent(before, requests, F.lit(NOW))
        got = ub.insert_users(spark, table, requests, F.lit(NOW))
    elif kind == "update":
        after, judged = changes.partial_update(before, requests, F.lit(NOW))
        got = ub.update_users(spark, table, requests, F.lit(NOW))
    else:
        after, _, judged = changes.delete_by_email(before, requests)
        got = ub.delete_users(spark, table, requests)
    assert {r.ordinal: r.outcome for r in got.collect()} == {r.ordinal: r.outcome for r in judged.collect()}
    assert shown(ub.users_of(spark, table).collect()) == shown(after.collect())


def test_only_changed_buckets_are_replaced(spark, table):
    before = files(spark, table)
    requests = [(0, "update", EMAILS[0], {"name": "changed"}), (1, "update", "nobody@x.org", {"name": "changed"}),
                (2, "update", EMAILS[1], {})]
    outcomes = ub.update_users(spark, table, spark.createDataFrame(requests, REQUESTS), F.lit(NOW))
    assert {r.ordinal: r.outcome for r in outcomes.collect()} == {0: "ok", 1: "not_found", 2: "no_fields"}
    after, touched = files(spark, table), slots_of(spark, [EMAILS[0]])
    assert {s for s in before if before[s] != after[s]} == touched
    assert ub.users_of(spark, table).count() == len(EMAILS)


def test_inserts_add_files_only(spark, table):
    before = files(spark, table)
    change = dict(name="n", phone_number="1" * 11, password="p" * 8, role="user", notifications="yes")
    requests = spark.createDataFrame([(0, "insert", "fresh@x.org", change), (1, "insert", EMAILS[3], change)], REQUESTS)
    ub.insert_users(spark, table, requests, F.lit(NOW))
    after = files(spark, table)
    assert all(before[s] <= after[s] for s in before)
    assert {s for s in after if after[s] != before.get(s)} == slots_of(spark, ["fresh@x.org"])


def test_an_emptied_bucket_is_empty(spark, table):
    slot = min(files(spark, table))
    gone = [e for e in EMAILS if slots_of(spark, [e]) == {slot}]
    requests = spark.createDataFrame([(i, "delete", e, {}) for i, e in enumerate(gone)], REQUESTS)
    ub.delete_users(spark, table, requests)
    assert {r.email for r in ub.users_of(spark, table).collect()} == set(EMAILS) - set(gone)
    assert slot not in files(spark, table)
    again = spark.createDataFrame([(0, "insert", gone[0], dict(name="n", phone_number="1" * 11, password="p" * 8,
                                                             role="user", notifications="yes"))], REQUESTS)
    ub.insert_users(spark, table, again, F.lit(NOW))
    assert ub.users_of(spark, table).filter(F.col("email") == gone[0]).count() == 1


def test_nothing_to_do(spark, table):
    before = files(spark, table)
    none = spark.createDataFrame([], REQUESTS)
    for judged in (ub.update_users(spark, table, none, F.lit(NOW)), ub.delete_users(spark, table, none),
                   ub.insert_users(spark, table, none, F.lit(NOW))):
        assert judged.collect() == []
    assert files(spark, table) == before


def above_users(plan):
    """The operators between the scan of the users and the join above it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "slot=" in line or "Bucketed: true" in line)
    out, depth = [], len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            depth = own
            out.append(line)
            if "Join" in line:
                break
    return "\n".join(out)


def test_joins_read_users_where_they_lie(spark, table):
    requests = spark.createDataFrame([(0, "update", EMAILS[0], {"name": "x"})], REQUESTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        for df in (requests.join(ub.users_of(spark, table), "email", "left"),
                   changes.delete_by_email(ub.users_of(spark, table), requests)[0],
                   changes.partial_update(ub.users_of(spark, table), requests, F.lit(NOW))[0]):
            plan = df._jdf.queryExecution().executedPlan().toString()
            above = above_users(plan)
            assert "Join" in above and "Exchange" not in above, plan
        one = ub.user_by_email(spark, table, EMAILS[0])
        scan = one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
        (slot,) = slots_of(spark, [EMAILS[0]])
        assert f"= {slot})" in scan.split("PushedFilters")[0] and one.collect()[0].email == EMAILS[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
