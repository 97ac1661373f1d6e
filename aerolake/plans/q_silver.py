"""Queries: silver builders, batch and incremental, bronze and the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aerolake.functions import documents
from aerolake.operators import numbering, silver
from aerolake.plans import bindings as b
from aerolake.plans import tables
from aerolake.plans.commits import Folder
from aerolake.plans.registry import query
from aerolake.session import shared_folder
from aerolake.streaming import silver as incremental

_KEYS = ", ".join(b.MEASURE_KEYS)


def _air(spark, sf):
    return b.air_bronze(b.measures(spark, sf))


@query("aq_index_universal",
       f"WITH {b.MEASURES_SQL} SELECT {_KEYS}, {b.UNIVERSAL_COLUMNS_SQL} FROM measures")
def aq_index_universal(spark, sf):
    return silver.aq_index_universal(_air(spark, sf), b.MEASURE_KEYS)


@query("aq_index_br", f"WITH {b.MEASURES_SQL} SELECT {_KEYS}, {b.BR_COLUMNS_SQL} FROM measures")
def aq_index_br(spark, sf):
    return silver.aq_index_br(_air(spark, sf), b.MEASURE_KEYS)


@query("aq_pollutants_wide",
       f"WITH {b.MEASURES_SQL} SELECT {_KEYS}, {b.POLLUTANT_COLUMNS_SQL} FROM measures")
def aq_pollutants_wide(spark, sf):
    return silver.aq_pollutants_wide(_air(spark, sf), b.MEASURE_KEYS)


_SILVER_AIR_SQL = f"""
WITH {b.MEASURES_SQL}
SELECT {_KEYS}, l_shipdate AS data_medicao, place AS regiao, {b.UNIVERSAL_COLUMNS_SQL},
       {b.BR_COLUMNS_SQL}, {b.POLLUTANT_COLUMNS_SQL} FROM measures"""


@query("silver_air_quality", _SILVER_AIR_SQL)
def silver_air_quality(spark, sf):
    return silver.silver_air_quality(_air(spark, sf), b.MEASURE_KEYS)


_SILVER_WEATHER_SQL = (
    f"WITH {b.READINGS_SQL} SELECT event_id AS id, {b.SILVER_WEATHER_COLUMNS_SQL} FROM readings"
)


@query("silver_weather", _SILVER_WEATHER_SQL)
def silver_weather(spark, sf):
    return silver.silver_weather(b.weather_bronze(b.readings(spark, sf)), ("id",))


MOST_ROWS_PER_FILE = 250_000
MOST_FILES_PER_BATCH = 32


def _bronze_files(spark, rows):
    """The rows in files of the input's own partitions, and how many of them make a micro-batch.

    A batch costs the same few seconds however small it is, so files and batches grow with the
    rows: some eight batches, more only when they would go beyond 32 files of 250,000 rows.
    """
    folder = shared_folder(spark, "incoming")
    per_file = min(max(5000, rows.count() // 64), MOST_ROWS_PER_FILE)
    rows.write.option("maxRecordsPerFile", per_file).parquet(folder)
    files = sum(n.endswith(".parquet") for n in Folder(spark, folder).names())
    return folder, min(max(2, files // 8), MOST_FILES_PER_BATCH)


@query("stream_silver_air_quality", f"""
WITH {b.MEASURES_SQL}
SELECT l_orderkey AS id, l_shipdate AS data_medicao, place AS regiao, {b.UNIVERSAL_COLUMNS_SQL},
       {b.BR_COLUMNS_SQL}, {b.POLLUTANT_COLUMNS_SQL} FROM measures""")
def stream_silver_air_quality(spark, sf):
    bronze, files_per_batch = _bronze_files(
        spark, _air(spark, sf).select(F.col("l_orderkey").alias("id"), "data"))
    target, checkpoint = shared_folder(spark, "silver"), shared_folder(spark, "progress")
    incremental.stream_silver_air_quality(
        spark, bronze, target, checkpoint, name=f"air-{uuid.uuid4().hex}", files_per_batch=files_per_batch
    ).awaitTermination()
    return spark.read.parquet(target).drop("created_at")


@query("stream_silver_rerun", f"""
WITH {b.MEASURES_SQL}, firsts AS (
  SELECT place AS regiao, l_shipdate AS data_medicao, min(l_orderkey) AS id FROM measures GROUP BY place, l_shipdate)
SELECT regiao, data_medicao, id FROM firsts""")
def stream_silver_rerun(spark, sf):
    """Documents of one place and time, and all of them landed again: one silver row each."""
    # A place is named after its supplier; line items are narrower to shuffle than measures.
    lines, key = b.table(spark, sf, "lineitem"), ["l_suppkey", "l_shipdate"]
    firsts = lines.groupBy(*key).agg(F.min("l_orderkey").alias("l_orderkey"))
    rows = b.measured(lines.join(firsts, [*key, "l_orderkey"], "left_semi"))
    source, target, checkpoint = shared_folder(spark, "bronze"), shared_folder(spark, "silver"), shared_folder(spark, "progress")
    landed = b.air_bronze(rows).select((F.col("l_orderkey")).alias("id"), "data")
    for turn in range(2):
        landed.write.mode("append").parquet(source)
        incremental.stream_silver_air_quality(
            spark, source, target, checkpoint, name=f"rerun-{uuid.uuid4().hex}", once_by=("regiao", "data_medicao")).awaitTermination()
        landed = spark.read.schema(landed.schema).parquet(source)  # all of them again, as they were stored
    return spark.read.parquet(target).select("regiao", "data_medicao", "id")


@query("stream_silver_weather", _SILVER_WEATHER_SQL)
def stream_silver_weather(spark, sf):
    bronze, files_per_batch = _bronze_files(spark, b.weather_bronze(b.readings(spark, sf)))
    target, checkpoint = shared_folder(spark, "silver"), shared_folder(spark, "progress")
    incremental.stream_silver_weather(
        spark, bronze, target, checkpoint, name=f"weather-{uuid.uuid4().hex}", files_per_batch=files_per_batch
    ).awaitTermination()
    return spark.read.parquet(target).drop("created_at")


@query("install_once", _SILVER_WEATHER_SQL)
def install_once(spark, sf):
    """Three runs of one named stream: half of the rows, nothing new, the rest."""
    rows = b.weather_bronze(b.readings(spark, sf))
    bronze, target = shared_folder(spark, "incoming"), shared_folder(spark, "silver")
    checkpoint, name = shared_folder(spark, "progress"), f"once-{uuid.uuid4().hex}"
    early = F.col("id") % 2 == 0

    def run():
        incremental.stream_silver_weather(
            spark, bronze, target, checkpoint, name=name).awaitTermination()

    rows.filter(early).write.parquet(bronze)
    run()
    run()
    rows.filter(~early).write.mode("append").parquet(bronze)
    run()
    return spark.read.parquet(target).drop("created_at")


@query("atomic_pair", f"""
WITH {b.READINGS_SQL}
SELECT 'bronze' AS part, event_id AS id, CAST(NULL AS DECIMAL(5,2)) AS temperatura,
       CAST(NULL AS VARCHAR) AS problems FROM readings WHERE event_id % 10 <> 0
UNION ALL
SELECT 'silver', event_id, CAST(temp AS DECIMAL(5,2)), NULL FROM readings WHERE event_id % 10 <> 0
UNION ALL
SELECT 'quarantine', event_id, NULL, 'velocidade_vento' FROM readings WHERE event_id % 10 = 0""")
def atomic_pair(spark, sf):
    speed = "CASE WHEN event_id % 10 = 0 THEN 123.45 ELSE speed END"
    incoming, files_per_batch = _bronze_files(spark, b.weather_bronze(b.readings(spark, sf), speed))
    target, checkpoint = shared_folder(spark, "pair"), shared_folder(spark, "progress")
    incremental.atomic_pair(
        spark, silver.silver_weather, incoming, target, checkpoint,
        f"pair-{uuid.uuid4().hex}", files_per_batch=files_per_batch,
    ).awaitTermination()
    no_number, no_text = F.lit(None).cast("decimal(5,2)"), F.lit(None).cast("string")
    shown = {
        "bronze": (no_number, no_text),
        "silver": (F.col("temperatura"), no_text),
        "quarantine": (no_number, F.col("problems")),
    }
    parts = [
        incremental.read_pair(spark, target, part).select(
            F.lit(part).alias("part"), "id", number.alias("temperatura"), text.alias("problems"))
        for part, (number, text) in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _fresh_catalog(spark):
    """Schemas and tables of their own for one run."""
    prefix, folder = f"run_{uuid.uuid4().hex[:12]}_", shared_folder(spark, "tables")
    tables.create_schemas(spark, prefix, folder)
    tables.create_tables(spark, folder, prefix)
    return prefix


@query("bronze_append_weather", f"""
WITH {b.READINGS_SQL}, n AS (SELECT count(*) AS n FROM readings)
SELECT row_number() OVER (PARTITION BY turn ORDER BY event_id) + turn * n AS id, place AS root
FROM readings, n, (VALUES (0), (1)) AS t(turn)""")
def bronze_append_weather(spark, sf):
    """Two appends: the second goes on after the first one's ids."""
    prefix = _fresh_catalog(spark)
    rows = b.weather_bronze(b.readings(spark, sf)).withColumnRenamed("id", "event_id")
    for _ in range(2):
        tables.bronze_append_weather(spark, rows, prefix, ("event_id",))
    stored = spark.table(f"{prefix}bronze.weather_api_data")
    return stored.select("id", documents.root_key(F.col("data")).alias("root"))


@query("bronze_append_air_quality", f"""
WITH {b.MEASURES_SQL}
SELECT count(*) AS rows, min(id) AS first, max(id) AS last, count(DISTINCT id) AS ids,
       count(DISTINCT place) AS places
FROM (SELECT row_number() OVER () AS id, place FROM measures)""")
def bronze_append_air_quality(spark, sf):
    prefix = _fresh_catalog(spark)
    tables.bronze_append_air_quality(spark, _air(spark, sf), prefix)
    stored = spark.table(f"{prefix}bronze.google_api_data")
    # Two distinct counts in one aggregation would copy every row; ids are counted without the documents.
    ids = stored.agg(
        F.count("*").alias("rows"), F.min("id").alias("first"), F.max("id").alias("last"), F.countDistinct("id").alias("ids"))
    places = stored.select(documents.root_key(F.col("data")).alias("place")).agg(F.countDistinct("place").alias("places"))
    return ids.crossJoin(places)


@query("create_schemas", """
SELECT s AS schema, c_custkey FROM customer, (VALUES ('bronze'), ('silver'), ('gold'), ('dev')) AS t(s)""")
def create_schemas(spark, sf):
    """A table in every schema, and a second call that finds them there."""
    prefix, folder = f"run_{uuid.uuid4().hex[:12]}_", shared_folder(spark, "schemas")
    parts = []
    for _ in range(2):
        names = tables.create_schemas(spark, prefix, folder)
    for name in names:
        b.table(spark, sf, "customer").select("c_custkey").write.saveAsTable(f"{name}.probe")
        parts.append(spark.table(f"{name}.probe").select(
            F.lit(name.removeprefix(prefix)).alias("schema"), "c_custkey"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("create_tables", _SILVER_WEATHER_SQL.replace("FROM readings", ", true AS stamped FROM readings"))
def create_tables(spark, sf):
    """Silver rows inserted without a stamp: the column default fills it."""
    prefix = _fresh_catalog(spark)
    name = f"{prefix}silver.weather_api_data"
    rows = silver.silver_weather(b.weather_bronze(b.readings(spark, sf)), ("id",))
    rows.createOrReplaceTempView("silver_rows")
    listed = ", ".join(rows.columns)
    spark.sql(f"INSERT INTO {name} ({listed}) SELECT {listed} FROM silver_rows")
    spark.catalog.dropTempView("silver_rows")
    return spark.table(name).withColumn("stamped", F.col("created_at").isNotNull()).drop("created_at")


@query("surrogate_id", """
SELECT row_number() OVER (ORDER BY event_id) + 1000 AS id, event_id, event_type FROM events""")
def surrogate_id(spark, sf):
    rows = b.table(spark, sf, "events").select("event_id", "event_type")
    return numbering.surrogate_id(rows, ("event_id",), start=1000)


@query("default_created_at", f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts ELSE TIMESTAMP '{b.NOW}' END AS created_at
FROM events""")
def default_created_at(spark, sf):
    rows = b.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.col("ts")).alias("created_at")
    )
    return tables.default_created_at(rows, b.now())


def _user_table(spark, sf):
    name = f"{_fresh_catalog(spark)}dev.users"
    tables.bulk_insert_users(b.users(spark, sf), name)
    return name


@query("truncate_users", "SELECT count(*) AS deleted, 0::BIGINT AS again, 0::BIGINT AS remaining FROM customer")
def truncate_users(spark, sf):
    name = _user_table(spark, sf)
    deleted, again = tables.truncate_users(spark, name), tables.truncate_users(spark, name)
    return spark.table(name).agg(
        F.lit(deleted).cast("bigint").alias("deleted"), F.lit(again).cast("bigint").alias("again"),
        F.count("*").alias("remaining"),
    )


@query("bulk_insert_users", f"WITH {b.USERS_SQL} SELECT * FROM users")
def bulk_insert_users(spark, sf):
    return spark.table(_user_table(spark, sf))


@query("seed_guard", f"""
WITH {b.USERS_SQL}
SELECT id, email, upper(name) AS name, 'seeded,kept,replaced' AS steps FROM users""")
def seed_guard(spark, sf):
    name = f"{_fresh_catalog(spark)}dev.users"
    first = b.users(spark, sf)
    second = first.withColumn("name", F.upper("name"))
    steps = [
        tables.seed_guard(spark, name, first),
        tables.seed_guard(spark, name, second),
        tables.seed_guard(spark, name, second, clear_existing=True),
    ]
    return spark.table(name).select("id", "email", "name", F.lit(",".join(steps)).alias("steps"))
