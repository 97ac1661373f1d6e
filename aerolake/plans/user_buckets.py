"""A user table laid out by e-mail and changed in place.

The table is bucketed by e-mail and partitioned by the bucket's number (``slot``), so
that a bucket is a folder. Joins on e-mail read the users where they lie, without a
shuffle of them, and a batch of changes replaces the folders of the buckets that it
changes and no others. Inserts only add files. The work of a batch grows with the batch
and the buckets it meets, not with the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import changes
from aerolake.plans.tables import location_of
from aerolake.session import shared_folder

_MODE = "spark.sql.sources.partitionOverwriteMode"  # a table takes it from the session only


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(rows["data_type"])


def slot_of(email: Column, buckets: int) -> Column:
    """The number of an e-mail's bucket, by the hash that Spark deals buckets with."""
    return F.pmod(F.hash(email), F.lit(buckets)).cast("int")


def create_user_table(spark: SparkSession, table: str, location: str, buckets: int, users: DataFrame) -> None:
    """Create the table below ``location`` with ``users`` (unique e-mails). One file a bucket;
    ``buckets`` should make them some hundred megabytes."""
    (users.select(*model.USER_COLUMNS, slot_of(F.col("email"), buckets).alias("slot"))
     .repartition(buckets, "email")
     .write.option("path", location).partitionBy("slot").bucketBy(buckets, "email").saveAsTable(table))


def users_of(spark: SparkSession, table: str, slots: list[int] | None = None) -> DataFrame:
    """The users, or those of some buckets; others are not read."""
    rows = spark.table(table)
    if slots is not None:
        rows = rows.filter(F.col("slot").isin(*slots))
    return rows.select(*model.USER_COLUMNS)


def user_by_email(spark: SparkSession, table: str, email: str) -> DataFrame:
    """The user of one address; one bucket is read."""
    slot = slot_of(F.lit(email), bucket_count(spark, table))
    return spark.table(table).filter((F.col("slot") == slot) & (F.col("email") == email)).select(*model.USER_COLUMNS)


def _slots(requests: DataFrame, buckets: int) -> list[int]:
    """The buckets that requests meet: at most as many numbers as the table has buckets."""
    slot = slot_of(F.col("email"), buckets)
    return sorted(r[0] for r in requests.filter("email IS NOT NULL").select(slot.alias("slot")).distinct().collect())


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder before the table they come from changes."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _replace(spark: SparkSession, table: str, slots: list[int], rows: DataFrame, buckets: int) -> None:
    """New content for some buckets. A bucket that keeps no user is dropped."""
    placed = rows.withColumn("slot", slot_of(F.col("email"), buckets))
    columns = spark.table(table).columns
    left = {r[0] for r in placed.select("slot").distinct().collect()}
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        placed.select(*columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(_MODE, before)
    if empty := [s for s in slots if s not in left]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION (slot = {s})" for s in empty) + " PURGE")
        _drop_folders(spark, table, empty)
    spark.catalog.refreshTable(table)


def _drop_folders(spark: SparkSession, table: str, slots: list[int]) -> None:
    """The files of dropped buckets: the table is external, so the catalog leaves them."""
    jvm = spark.sparkContext._jvm
    for slot in slots:
        path = jvm.org.apache.hadoop.fs.Path(f"{location_of(spark, table)}/slot={slot}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def insert_users(spark: SparkSession, table: str, requests: DataFrame, now: Column, salt: str = "user") -> DataFrame:
    """``insert_if_absent`` on the table; the requests with their outcome. No file is replaced."""
    buckets = bucket_count(spark, table)
    there = users_of(spark, table, _slots(requests, buckets))
    judged = stored(changes.insert_if_absent(there, requests, now, salt)[1], "judged")
    added = changes.inserted_rows(judged.filter("outcome = 'ok'"), now, salt)
    placed = added.withColumn("slot", slot_of(F.col("email"), buckets)).repartition(buckets, "email")
    placed.select(*spark.table(table).columns).write.insertInto(table)
    spark.catalog.refreshTable(table)
    return judged


def _changed(spark: SparkSession, table: str, requests: DataFrame,
             run: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Judge the requests, then rewrite the buckets of those that change something."""
    buckets = bucket_count(spark, table)
    judged = stored(run(users_of(spark, table, _slots(requests, buckets)), requests)[1], "judged")
    effective = judged.filter("outcome = 'ok'")
    slots = _slots(effective, buckets)
    if slots:
        after = run(users_of(spark, table, slots), effective.drop("outcome"))[0]
        _replace(spark, table, slots, stored(after, "buckets"), buckets)
    return judged


def update_users(spark: SparkSession, table: str, requests: DataFrame, now: Column) -> DataFrame:
    """``partial_update`` on the table; the requests with their outcome."""
    return _changed(spark, table, requests, lambda users, asked: changes.partial_update(users, asked, now))


def delete_users(spark: SparkSession, table: str, requests: DataFrame) -> DataFrame:
    """``delete_by_email`` on the table; the requests with their outcome."""

    def run(users: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
        remaining, _, judged = changes.delete_by_email(users, asked)
        return remaining, judged

    return _changed(spark, table, requests, run)
