"""One commit for several tables, and ids for several writers."""

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import test_operators
from aerolake.plans import commits, etl, tables
from pyspark import cloudpickle
from test_operators import air_stub, catalog, frame, weather_stub  # noqa: F401  a fixture

cloudpickle.register_pickle_by_value(test_operators)  # its stubs run on the workers

TABLES = ("bronze.weather_api_data", "silver.weather_api_data", "bronze.google_api_data", "silver.google_api_data")


class Killed(Exception):
    pass


def places(spark):
    rows = [("P0", 10.0, 1.0, 0), ("P1", 20.0, 1.0, 1), ("P2", 30.0, 2.0, 2)]
    return frame(spark, rows, "nome string, latitude double, longitude double, ordinal long")


def odd_weather(method, url, params, payload):
    """One document that silver refuses."""
    status, body = weather_stub(method, url, params, payload)
    answer = json.loads(body)
    if float(params["lat"]) == 20.0:
        answer["wind"]["speed"] = 12345.6
    return status, json.dumps(answer)


def run_job(spark, prefix, run):
    return etl.air_quality_etl(spark, places(spark), odd_weather, air_stub, prefix, run=run)


def content(spark, prefix):
    """Rows of all tables and the refused documents, without ids and stamps."""
    out = {}
    for name in TABLES:
        spark.catalog.refreshTable(prefix + name)
        rows = spark.table(prefix + name).drop("id", "created_at").collect()
        out[name] = sorted(map(repr, rows))
    try:
        bad = spark.read.parquet(tables.quarantine_of(spark, prefix + "bronze.weather_api_data"))
        out["refused"] = sorted(r.problems for r in bad.collect())
    except Exception:
        out["refused"] = []
    return out


def test_killed_anywhere_then_run_again(spark, catalog, monkeypatch):  # noqa: F811
    """The job dies at its n-th write or move, is started again, and the result is that of one run."""
    assert run_job(spark, catalog, "h0")
    once = content(spark, catalog)
    assert [len(once[t]) for t in TABLES] == [2, 2, 3, 3] and once["refused"] == ["velocidade_vento"]
    seen = set()
    for n, (step, owner) in enumerate([("_stage", commits), ("create", commits.Folder), ("move", commits.Folder),
                                       ("create", commits.Folder)]):
        allowed = {0: 4, 1: 2, 2: 3, 3: 3}[n]
        real, count = getattr(owner, step), [0]

        def dying(*args, real=real, count=count, allowed=allowed, **kw):
            count[0] += 1
            if count[0] > allowed:
                raise Killed
            return real(*args, **kw)

        before = content(spark, catalog)
        monkeypatch.setattr(owner, step, dying)
        with pytest.raises(Killed):
            run_job(spark, catalog, f"h{n + 1}")
        monkeypatch.setattr(owner, step, real)
        committed = bool(commits.finish(spark, tables.location_of(spark, catalog + tables.WEATHER_BRONZE)))
        after = content(spark, catalog)
        whole = {k: sorted(before[k] + once[k]) for k in once}
        assert after == (whole if committed else before)  # all or nothing
        assert run_job(spark, catalog, f"h{n + 1}") is not committed
        assert content(spark, catalog) == whole
        assert run_job(spark, catalog, f"h{n + 1}") is False
        seen.add(committed)
    assert seen == {True, False}
    for name in TABLES:
        ids = [r.id for r in spark.table(catalog + name).collect()]
        assert len(ids) == len(set(ids))


def test_two_attempts_of_one_run(spark, catalog, folder):  # noqa: F811
    rows = spark.range(5).select("id", F.lit("{}").alias("data"))
    name = catalog + tables.WEATHER_BRONZE
    output = lambda: [commits.Output(rows, tables.location_of(spark, name), name)]
    real = commits.Folder.create

    def late(self, file, text):
        if file == "h.commit" and not commits.Folder.names(self):
            real(self, file, json.dumps([]))  # the other attempt comes first
        return real(self, file, text)

    commits.Folder.create = late
    try:
        assert commits.commit(spark, tables.location_of(spark, name), "h", output()) is False
    finally:
        commits.Folder.create = real
    assert spark.table(name).count() == 0


def test_concurrent_writers_get_ids_of_their_own(spark, catalog):  # noqa: F811
    name = catalog + tables.WEATHER_BRONZE

    def append(i):
        rows = spark.range(20 + i).select(F.lit('{"p": {}}').alias("data"))
        tables.bronze_append(spark, rows, name)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(append, range(6)))
    spark.catalog.refreshTable(name)
    ids = sorted(r.id for r in spark.table(name).select("id").collect())
    assert ids == list(range(1, sum(20 + i for i in range(6)) + 1))


def test_ids_go_on_after_rows_that_came_another_way(spark, catalog):  # noqa: F811
    name = catalog + tables.WEATHER_BRONZE
    spark.createDataFrame([(41, "{}")], "id long, data string").write.insertInto(name)
    location = tables.location_of(spark, name)
    assert commits.reserve_ids(spark, name, location, 5) == 41
    assert commits.reserve_ids(spark, name, location, 0) == 46
    assert commits.reserve_ids(spark, name, location, 1) == 46


def test_documents_are_appended_without_a_second_copy(spark, folder, monkeypatch):
    """Ids go on without gaps, also for rows that come in other tasks than they were counted in."""
    prefix = f"once_{uuid.uuid4().hex[:8]}_"
    tables.create_schemas(spark, prefix, folder)
    tables.create_tables(spark, folder, prefix)
    name = prefix + tables.AIR_BRONZE
    stored_again = []
    numbered = tables.surrogate_id
    monkeypatch.setattr(tables, "surrogate_id", lambda *a, **k: (stored_again.append(1), numbered(*a, **k))[1])
    rows = spark.range(0, 100, 1, 7).selectExpr("cast(id AS string) AS data")
    tables.bronze_append(spark, rows.filter("data NOT LIKE '3%'"), name)
    tables.bronze_append(spark, rows.limit(0), name)
    tables.bronze_append(spark, rows, name)
    got = spark.table(name).collect()
    assert not stored_again and sorted(r.id for r in got) == list(range(1, 190)) and len({r.data for r in got}) == 100
    counted, calls = tables.numbering.task_offsets, []

    def miscounted(counts):
        calls.append(1)
        return counted(counts.filter("_task != 5") if len(calls) == 1 else counts)

    monkeypatch.setattr(tables.numbering, "task_offsets", miscounted)
    tables.bronze_append(spark, rows, name)
    got = spark.table(name).collect()
    assert stored_again and len(got) == 289 == len({r.id for r in got}) and sorted(r.data for r in got if r.id > 189) == sorted(map(str, range(100)))
