"""User statistics kept up to date from the change feed, without a look at the users.

Every batch of the feed takes the old values of its users out of the counts and puts the
new ones in. Counts are a folder per batch, made of the one before, so a batch that is
run again gives the same folder, and readers see the last finished one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.operators import stats
from aerolake.plans.commits import Folder
from aerolake.streaming.changes import FEED
from aerolake.streaming.silver import install_once


def start_counts(users: DataFrame, counts: str) -> None:
    """Count the users once, before the first batch of changes."""
    stats.combinations(users).write.parquet(f"{counts}/v=0")


def _version(spark: SparkSession, counts: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{counts}/v={version}").select(*stats.STATED.values(), "c")


def keep_counts(spark: SparkSession, feed: str, counts: str, checkpoint: str, name: str) -> StreamingQuery:
    """Bring the counts up to what the feed holds now and stop."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        changed = batch.filter("kind = 'user'").select("before", F.col("user").alias("after"))
        new = stats.merged_combinations(_version(spark, counts, batch_id), stats.changed_combinations(changed))
        new.coalesce(1).write.mode("overwrite").parquet(f"{counts}/v={batch_id + 1}")

    def start() -> StreamingQuery:
        return (spark.readStream.schema(FEED).parquet(feed).writeStream.queryName(name)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start())

    return install_once(spark, name, start)


def current_stats(spark: SparkSession, counts: str) -> DataFrame:
    """``breakdown, value, n`` as ``user_stats`` gives them, of the last finished batch."""
    versions = sorted(int(n.removeprefix("v=")) for n in Folder(spark, counts).names() if n.startswith("v="))
    done = [v for v in versions if "_SUCCESS" in Folder(spark, f"{counts}/v={v}").names()]
    return stats.stats_of(_version(spark, counts, done[-1]))
