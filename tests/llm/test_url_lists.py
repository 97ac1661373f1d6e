import datetime as dt
import random

import pytest

from aerolake.llm import url_lists

DAY = dt.datetime(2024, 1, 1)


def brute(captures, edits):
    """For each capture: the keys whose last edit by then is a listing, and since when."""
    by_key = {}
    for key, at, listed in edits:
        if None not in (key, at, listed):
            own = by_key.setdefault(key.lower(), {})
            own[at] = max(listed, own.get(at, False))
    out = []
    for page_id, url, at in captures:
        host = None
        if url and "://" in url:
            host = url.split("://")[1].split("/")[0].split("@")[-1].split(":")[0].lower() or None
        active = []
        labels = host.split(".") if host and at else []
        for i in range(max(len(labels) - 1, min(len(labels), 1))):
            key, since, state = ".".join(labels[i:]), None, False
            for t, listed in sorted(by_key.get(key, {}).items()):
                if t <= at:
                    since, state = (t if listed and not state else since), listed
            if state:
                active.append((key, since))
        best = max(active, key=lambda a: len(a[0]), default=(None, None))
        out.append((page_id, url, host, at, len(active), *best, bool(active)))
    return out


def frames(spark, captures, edits):
    return (spark.createDataFrame([c + ("x", "y") for c in captures],
                                  "page_id long, url string, fetched_at timestamp, host string, key string"),
            spark.createDataFrame([e + (1,) for e in edits], "key string, at timestamp, listed boolean, span int"))


@pytest.mark.parametrize("span", [3600, 60, 86_400])
def test_random_lists_match_a_loop(spark, span):
    rng = random.Random(span)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.net", "one", "A.X.org"]
    moment = lambda: DAY + dt.timedelta(minutes=rng.randint(0, 3000))
    edits = [(rng.choice(hosts), moment(), rng.random() < 0.5) for _ in range(150)]
    edits += [(None, DAY, True), ("x.org", None, True), ("y.net", DAY, None)]
    edits += [("y.net", DAY, True), ("y.net", DAY, False), ("y.net", DAY, True)]  # ties and repeats
    captures = [(i, f"http://u@{rng.choice(hosts)}:80/p?q", moment()) for i in range(150)]
    captures += [captures[0], (200, None, DAY), (201, "no url", DAY), (202, "http://x.org/", None), (None, "https://y.net", DAY)]
    got = [tuple(r) for r in url_lists.judge_captures(*frames(spark, captures, edits), span_seconds=span).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(captures, edits)))


def test_empty_tables(spark):
    capture = [(1, "http://x.org", DAY)]
    assert url_lists.judge_captures(*frames(spark, [], [("x.org", DAY, True)])).collect() == []
    assert [r.blocked for r in url_lists.judge_captures(*frames(spark, capture, [])).collect()] == [False]


def test_intervals(spark):
    at = lambda h: DAY + dt.timedelta(hours=h)
    edits = spark.createDataFrame([("k", at(1), True), ("k", at(2), True), ("k", at(30), False), ("k", at(31), False),
                                   ("k", at(40), True)], "key string, at timestamp, listed boolean")
    got = sorted(tuple(r) for r in url_lists.validity_intervals(edits).collect())
    assert got == [("k", at(1), at(30)), ("k", at(40), None)]


def test_a_hot_key_is_many_windows(spark):
    plan = url_lists.judge_captures(*frames(spark, [(1, "http://x.org", DAY)], [("x.org", DAY, True)]))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
