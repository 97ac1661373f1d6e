"""Schemas, tables, appends and the guarded seeding of users."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import numbering
from aerolake.operators.numbering import surrogate_id
from aerolake.plans.commits import Folder, Output, commit, finish, reserve_ids
from aerolake.session import shared_folder

SCHEMAS = ("bronze", "silver", "gold", "dev")

# Columns with a table default for the insert time.
_STAMP = "created_at TIMESTAMP_NTZ"
_STAMP_DEFAULT = "created_at TIMESTAMP_NTZ DEFAULT current_timestamp()"

TABLES = {
    "bronze.google_api_data": model.BRONZE_DDL,
    "bronze.weather_api_data": model.BRONZE_DDL,
    "silver.google_api_data": model.silver_ddl(model.air_columns()),
    "silver.weather_api_data": model.silver_ddl(model.WEATHER_LEAVES),
    "dev.users": model.USERS_DDL,
}


def create_schemas(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    names = []
    for schema in SCHEMAS:
        where = f" LOCATION '{location}/{schema}.db'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{schema}{where}")
        names.append(f"{prefix}{schema}")
    return names


def create_tables(spark: SparkSession, location: str, prefix: str = "") -> list[str]:
    """The five tables, each if absent, below ``location``. ``VARCHAR(n)``
    columns are checked by Spark on INSERT."""
    names = []
    for name, columns in TABLES.items():
        columns = columns.replace(_STAMP, _STAMP_DEFAULT)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({columns}) USING parquet "
            f"LOCATION '{location}/{name.replace('.', '/')}'"
        )
        names.append(f"{prefix}{name}")
    return names


def default_created_at(df: DataFrame, now: Column | None = None,
                       column: str = "created_at") -> DataFrame:
    """Stamp rows that have none. One time per query, or the given one."""
    stamp = (F.current_timestamp() if now is None else now).cast("timestamp_ntz")
    given = F.col(column).cast("timestamp_ntz") if column in df.columns else F.lit(None)
    return df.withColumn(column, F.coalesce(given, stamp))


def bronze_rows(spark: SparkSession, documents: DataFrame, table: str,
                order_by: tuple[str, ...] = ()) -> DataFrame:
    """``data`` rows with a block of the table's next free ids, which no other writer gets.
    They are computed and stored by this call; what cannot become a document fails here."""
    rows = surrogate_id(documents, order_by)
    before = reserve_ids(spark, table, location_of(spark, table), rows.count())
    return rows.select((F.col("id") + before).alias("id"), "data")


def bronze_append(spark: SparkSession, documents: DataFrame, table: str,
                  order_by: tuple[str, ...] = ()) -> None:
    """Append ``data`` rows with fresh ids, as one distributed write."""
    rows = None if order_by else _append_counted(spark, documents, table)
    if order_by or rows is not None:
        bronze_rows(spark, documents if rows is None else rows, table, order_by).write.insertInto(table)


def _append_counted(spark: SparkSession, documents: DataFrame, table: str) -> DataFrame | None:
    """Append ``data`` rows, stored only once: rows per task are counted first, without the documents.

    The files get a place below the table that no reader sees and are moved from there when their
    ids are seen to follow each other. Input that came in other tasks than it was counted in stays
    there and is returned, to be numbered as it is stored."""
    task, row = numbering.position(F.monotonically_increasing_id())
    offsets = numbering.task_offsets(documents.groupBy(F.spark_partition_id().cast("bigint").alias("_task")).agg(F.count("*").alias("_rows")))
    offsets = spark.createDataFrame(offsets.collect(), "_task bigint, _before bigint, _rows bigint")
    count = offsets.agg(F.sum("_rows")).first()[0] or 0
    home = location_of(spark, table)
    before = reserve_ids(spark, table, home, count)
    staged = Folder(spark, f"{home}/_staged/{uuid.uuid4().hex}")
    placed = documents.select(F.col("data").cast("string"), task.alias("_task"), row.alias("_row"))
    numbered = placed.join(F.broadcast(offsets.drop("_rows")), "_task", "left")
    numbered.select((F.lit(before + 1) + F.col("_before") + F.col("_row")).alias("id"), "data").write.parquet(staged.path.toString())
    stored = spark.read.schema(model.BRONZE_DDL).parquet(staged.path.toString())
    if not numbering.are_gapless(stored, "id", before + 1, before + count):
        return stored.select("data")
    for name in staged.names():
        if name.startswith("part-"):
            staged.move(name, Folder(spark, home))
    staged.delete()
    spark.catalog.refreshTable(table)
    return None


AIR_BRONZE = "bronze.google_api_data"
WEATHER_BRONZE = "bronze.weather_api_data"
AIR_SILVER = "silver.google_api_data"
WEATHER_SILVER = "silver.weather_api_data"


def bronze_append_air_quality(spark, documents, prefix: str = "", order_by=()) -> None:
    bronze_append(spark, documents, prefix + AIR_BRONZE, order_by)


def bronze_append_weather(spark, documents, prefix: str = "", order_by=()) -> None:
    bronze_append(spark, documents, prefix + WEATHER_BRONZE, order_by)


def silver_append(rows: DataFrame, path: str, day_of: str | None = None) -> None:
    """Append silver rows to files, by day of a timestamp when named. The
    rebalance lets adaptive execution split a day that is too large for one
    task and join small ones, so files come out even."""
    if day_of is None:
        rows.write.mode("append").parquet(path)
        return
    dated = rows.withColumn("dia", F.to_date(day_of))
    dated.hint("rebalance", "dia").write.mode("append").partitionBy("dia").parquet(path)


def location_of(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return described["data_type"].rstrip("/")


def quarantine_of(spark: SparkSession, bronze: str) -> str:
    """Where refused documents of a bronze table are kept, beside the table."""
    return location_of(spark, bronze) + "_quarantine"


def pair_outputs(spark: SparkSession, rows: DataFrame, build: Callable[..., DataFrame], bronze: str,
                 silver: str) -> list[Output]:
    """Accept or refuse each ``id, data`` row for both tables.

    Every document is flattened first, and the result stored once. Good ones are for
    the bronze and the silver table, refused ones with their problems for a place beside bronze.
    """
    folder = shared_folder(spark, "checked")
    build(rows, keep=("id",), mode="checked").write.parquet(folder)
    checked = spark.read.parquet(folder)
    good, bad = checked.filter("problems = ''"), checked.filter("problems != ''")
    stamped = default_created_at(good.drop("data", "problems"))
    return [
        Output(bad.select("id", "data", "problems"), quarantine_of(spark, bronze)),
        Output(good.select("id", "data"), location_of(spark, bronze), bronze),
        Output(stamped, location_of(spark, silver), silver),
    ]


def land(spark: SparkSession, outputs: list[Output], home: str, run: str | None = None) -> bool:
    """All outputs or none, see ``commits.commit``. ``home`` is the bronze table whose folder
    holds the commits. A run without a name is a new one each time."""
    return commit(spark, location_of(spark, home), run or uuid.uuid4().hex, outputs)


def landed_before(spark: SparkSession, home: str, run: str) -> bool:
    """Whether a run was committed; what it left unfinished is moved now."""
    folder = location_of(spark, home)
    finish(spark, folder)
    return f"{run}.done" in Folder(spark, f"{folder}/_commits").names()


def replace_rows(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Give the table new content. The rows are inserted into a table of the same columns
    at a new folder below the table's own, so widths are checked; the table is then
    pointed there. A failed write leaves the old content, and the rows may be computed
    from the table itself. Older folders stay for readers that still use them."""
    home = re.sub(r"/v-[0-9a-f]{32}$", "", location_of(spark, table))
    version = uuid.uuid4().hex
    folder, fresh = f"{home}/v-{version}", f"{table}_v_{version}"
    spark.sql(f"CREATE TABLE {fresh} LIKE {table} USING parquet LOCATION '{folder}'")
    try:
        rows.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(table).schema]).write.insertInto(fresh)
    finally:
        spark.sql(f"DROP TABLE {fresh}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def truncate_users(spark: SparkSession, table: str) -> int:
    """Delete all rows; the number deleted. An empty table is left alone."""
    count = spark.table(table).count()
    if count:
        replace_rows(spark, table, spark.table(table).limit(0))
    return count


def bulk_insert_users(rows: DataFrame, table: str) -> None:
    rows.select(*model.USER_COLUMNS).write.insertInto(table)


def seed_guard(spark: SparkSession, table: str, rows: DataFrame,
               clear_existing: bool = False) -> str:
    """Seed an empty table. Existing rows stop the seeding, or are replaced by
    the new ones in one switch when ``clear_existing`` is set."""
    if spark.table(table).isEmpty():
        bulk_insert_users(rows, table)
        return "seeded"
    if not clear_existing:
        return "kept"
    replace_rows(spark, table, rows)
    return "replaced"
