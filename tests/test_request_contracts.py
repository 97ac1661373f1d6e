"""Change requests are checked against their contract before they act."""

from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import changes

REQUESTS = "ordinal long, op string, email string, changes map<string,string>"
FULL = {"name": "new", "phone_number": "12345678901", "password": "longenough"}


def now():
    return F.lit("2025-01-01").cast("timestamp_ntz")


UPDATES = [
    ({"name": ""}, "ok"), ({"foo": "1"}, "no_fields"), ({}, "no_fields"), ({"phoneNumber": "12345678901"}, "ok"),
    ({"role": "root"}, "rejected"), ({"name": "n" * 150}, "rejected"), ({"password": "x"}, "rejected"),
    ({"name": None}, "rejected"), ({"role": None}, "ok"), ({"phone_number": "1"}, "rejected"),
    ({"notifications": "maybe"}, "rejected"), ({"email": "no address"}, "rejected"), (None, "no_fields"),
    ({"phoneNumber": "12345678902", "phone_number": "1"}, "ok"),
]
INSERTS = [
    ({"role": "root"}, "rejected"), ({**FULL, "role": "root"}, "rejected"), ({**FULL, "name": ""}, "rejected"),
    ({**FULL, "password": "x"}, "rejected"), ({"name": "n", "phone_number": "12345678901"}, "rejected"),
    ({**FULL, "phoneNumber": "98765432101"}, "ok"), (FULL, "conflict"),
]


def users(spark):
    rows = [(f"u{i}", "A", f"a{i}@x.org", "longenough", None, "12345678900", "user", None, None, None)
            for i in range(len(UPDATES))]
    names = model.USER_COLUMNS
    kinds = ["timestamp_ntz" if c.endswith("_at") else "string" for c in names]
    return spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in zip(names, kinds)))


def test_updates(spark):
    asked = spark.createDataFrame(
        [(i, "update", f"a{i}@x.org", c) for i, (c, _) in enumerate(UPDATES)], REQUESTS)
    want = {i: outcome for i, (_, outcome) in enumerate(UPDATES)}
    before = {r.email: r for r in users(spark).collect()}
    for run in (changes.partial_update, changes.apply_changes):
        after, judged = run(users(spark), asked, now())
        assert {r.ordinal: r.outcome for r in judged.collect()} == want
        rows = {r.email: r for r in after.collect()}
        assert rows["a0@x.org"].name == "" and rows["a8@x.org"].role is None
        assert rows["a3@x.org"].phone_number == "12345678901" and rows["a13@x.org"].phone_number == "12345678902"
        for i, outcome in want.items():
            if outcome != "ok":
                assert rows[f"a{i}@x.org"] == before[f"a{i}@x.org"]
    assert {r.ordinal: r.outcome for r in changes.judge_updates(users(spark), asked).collect()} == want


def test_inserts(spark):
    asked = spark.createDataFrame([(i, "insert", "new@x.org", c) for i, (c, _) in enumerate(INSERTS)], REQUESTS)
    for run in (changes.insert_if_absent, changes.apply_changes):
        after, judged = run(users(spark), asked, now())
        assert {r.ordinal: r.outcome for r in judged.collect()} == {i: o for i, (_, o) in enumerate(INSERTS)}
        assert [r.phone_number for r in after.filter("email = 'new@x.org'").collect()] == ["98765432101"]
