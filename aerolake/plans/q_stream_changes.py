"""Queries: keyed changes as a stream that is stopped and started again half-way."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.plans import bindings as b
from aerolake.plans import q_users  # noqa: F401  the SQL twins
from aerolake.plans.commits import Folder
from aerolake.plans.registry import ORACLES, query
from aerolake.session import shared_folder
from aerolake.streaming import changes as keyed
from aerolake.streaming import stats as kept


# Requests of a file, and files of a micro-batch. A batch reads and writes the stored users once, whatever
# its size, and its requests are spread over all tasks.
MOST_REQUESTS = 1_000_000
FILES_PER_BATCH = 32


def in_files(requests: DataFrame, folder: str) -> None:
    """The requests appended as files of about ``MOST_REQUESTS``, each with later ordinals than the one
    before and an arrival after it, so a stream that takes some files at a time meets them in order.

    All files are written in parallel; arriving is a move."""
    spark = requests.sparkSession
    rows = requests.select("ordinal", F.col("op").cast("string").alias("op"), "email", "changes")
    parts = max(1, -(-rows.count() // MOST_REQUESTS))
    if parts == 1:
        rows.coalesce(1).write.mode("append").parquet(folder)
        return
    staged, target = Folder(spark, f"{folder}/_staged-{uuid.uuid4().hex}"), Folder(spark, folder)
    rows.repartitionByRange(parts, "ordinal").write.parquet(staged.path.toString())
    arrival = int(time.time() * 1000)
    for turn, file in enumerate(n for n in staged.names() if n.startswith("part-")):
        staged.move(file, target, arrival + turn)
    staged.delete()


def in_two_runs(spark: SparkSession, users: DataFrame, requests: DataFrame,
                after_each: Callable[[str], None] | None = None) -> DataFrame:
    """The change feed of the requests: the earlier half first, the later half after a restart."""
    folder = shared_folder(spark, "keyed-changes")
    half = (requests.agg(F.max("ordinal")).first()[0] or 0) // 2
    for part in (F.col("ordinal") <= half, F.col("ordinal") > half):
        in_files(requests.filter(part), f"{folder}/requests")
        keyed.stream_changes(spark, users, f"{folder}/requests", f"{folder}/feed", f"{folder}/checkpoint",
                             folder.rsplit("/", 1)[-1], b.now(), files_per_batch=FILES_PER_BATCH).awaitTermination()
        if after_each:
            after_each(f"{folder}/feed")
    return spark.read.schema(keyed.FEED).parquet(f"{folder}/feed")


@query("stream_partial_update", ORACLES["partial_update"])
def stream_partial_update(spark, sf):
    users = b.users(spark, sf)
    return keyed.users_after(users, in_two_runs(spark, users, b.requests(spark, sf)))


@query("stream_insert_if_absent", ORACLES["insert_if_absent"])
def stream_insert_if_absent(spark, sf):
    users = b.users(spark, sf)
    return keyed.users_after(users, in_two_runs(spark, users, b.insert_requests(spark, sf)))


@query("stats_kept", f"""
WITH users_after AS ({ORACLES["insert_if_absent"]})
SELECT CASE grouping_id(role, signatureStatus, notifications)
         WHEN 3 THEN 'role' WHEN 5 THEN 'status' WHEN 6 THEN 'notifications' ELSE 'total' END AS breakdown,
       CASE grouping_id(role, signatureStatus, notifications)
         WHEN 3 THEN role WHEN 5 THEN signatureStatus WHEN 6 THEN notifications END AS value,
       count(id) AS n
FROM users_after GROUP BY GROUPING SETS ((role), (signatureStatus), (notifications), ())""")
def stats_kept(spark, sf):
    """Statistics after two runs of changes, from the feed alone."""
    users, counts = b.users(spark, sf), shared_folder(spark, "counts")
    kept.start_counts(users, counts)

    def bring_up(feed: str) -> None:
        kept.keep_counts(spark, feed, counts, f"{counts}-checkpoint", counts.rsplit("/", 1)[-1]).awaitTermination()

    in_two_runs(spark, users, b.insert_requests(spark, sf), bring_up)
    return kept.current_stats(spark, counts)
