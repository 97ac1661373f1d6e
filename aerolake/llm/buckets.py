"""Texts stored in co-located buckets of a few megabytes, to be visited more than once."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.session import shared_folder


def store_buckets(docs: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """``doc_id, data, place, bucket`` of every row and the number of buckets.

    ``data`` is the text in UTF-8 (null: empty). Rows are dealt by a hash of their place, so
    rows alike spread; the table is bucketed, so grouping by ``bucket`` moves nothing.
    The catalog entry is dropped at once, the files stay with the shared folder.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    total = rows.agg(F.sum(F.length("data"))).first()[0] or 0
    n = max(1, math.ceil(total / bucket_bytes))
    # Spark limits a table's buckets; beyond that a file holds several of ours.
    files = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    name = f"aerolake_buckets_{uuid.uuid4().hex}"
    (rows.withColumn("place", F.monotonically_increasing_id())
     .withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(n)).cast("long"))
     .repartition(files, "bucket")
     .write.option("compression", "zstd").option("path", shared_folder(spark, "buckets"))
     .bucketBy(files, "bucket").sortBy("bucket").saveAsTable(name))
    stored = spark.table(name)
    stored.schema  # noqa: B018  resolves the files before the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored, n


def by_part(keys: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """The places of ``keys`` (hashes) that belong to each part, parts in order."""
    home = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    found, at = np.unique(home[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, at[1:]))) if len(found) else []


def in_place(docs: pd.DataFrame) -> pd.DataFrame:
    """A bucket's rows in stored order."""
    return docs.sort_values("place")
