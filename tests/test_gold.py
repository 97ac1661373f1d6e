"""The normalised form: pollutants as rows, places with lasting keys."""

from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import gold
from test_operators import frame, plan


def test_long_form(spark):
    columns = [f"{p}_{old}" for p in model.POLLUTANTS for old in gold.MEASURED.values()]
    full = [f"{c}!" if not c.endswith("_valor") else i for i, c in enumerate(columns)]
    first = list(model.POLLUTANTS)[0]
    only_value = [1.5 if c == f"{first}_valor" else None for c in columns]
    schema = "regiao string, data_medicao string, " + ", ".join(
        f"{c} {'double' if c.endswith('_valor') else 'string'}" for c in columns)
    rows = [("a", "t", *[float(v) if isinstance(v, int) else v for v in full]), ("b", None, *only_value), (None, "t", *[None] * len(columns))]
    got = gold.long_pollutants(frame(spark, rows, schema))
    assert got.columns == ["regiao", "data_medicao", "position", *gold.MEASURED]
    found = got.collect()
    assert [r.position for r in found if r.regiao == "a"] == list(range(len(model.POLLUTANTS)))
    assert [(r.position, r.code, r.concentration) for r in found if r.regiao == "b"] == [(0, None, 1.5)]
    assert len(found) == len(model.POLLUTANTS) + 1
    assert "Exchange" not in plan(got)


def test_places_keep_their_keys(spark):
    none = spark.createDataFrame([], gold.PLACES)
    names = frame(spark, [("b",), ("a",), (None,), ("b",)], "regiao string")
    one = gold.extend_places(none, names, "regiao")
    assert sorted(map(tuple, one.collect())) == [(1, "a"), (2, "b")]
    again = gold.extend_places(one, names, "regiao")
    assert sorted(again.collect()) == sorted(one.collect())
    more = gold.extend_places(one, frame(spark, [("B",), ("aa",), ("a",), ("",)], "regiao string"), "regiao")
    assert sorted(map(tuple, more.collect())) == [(1, "a"), (2, "b"), (3, ""), (4, "B"), (5, "aa")]
    assert gold.extend_places(none, names.limit(0), "regiao").collect() == []


def test_rows_get_keys(spark):
    places = frame(spark, [(1, "a"), (2, "b")], gold.PLACES)
    rows = frame(spark, [("a", 1), ("b", 2), ("x", 3), (None, 4), ("a", 5)], "regiao string, v int")
    got = gold.with_place_keys(rows, places, "regiao")
    assert got.columns == ["place_id", "v"]
    assert {r.v: r.place_id for r in got.collect()} == {1: 1, 2: 2, 3: None, 4: None, 5: 1}
    assert rows.filter(F.col("regiao") == "a").count() == 2


def test_few_places_move_no_rows(spark):
    places = frame(spark, [(1, "a"), (2, "b")], gold.PLACES)
    rows = spark.range(100).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' END AS regiao", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gold.with_place_keys(rows, places, "regiao")
        assert "BroadcastHashJoin" in plan(got) and "hashpartitioning" not in plan(got)
        assert got.filter("place_id = 1").count() == 34
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
