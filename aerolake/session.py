"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# The silver rows have some fifty converted columns. Whole-stage code puts them in
# one method, and HotSpot never compiles a method above 8000 bytes of bytecode;
# with this limit Spark falls back to its split-up code there (5.5 s to 3.4 s on
# 600,000 documents).
WIDE_ROWS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Documents of one kind repeat their member names; 600,000 air-quality documents take 39 MB instead of
# 92 MB with snappy, written as fast.
COMPACT = {"spark.sql.parquet.compression.codec": "zstd"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **WIDE_ROWS,
    **COMPACT,
}


def build_session(master: str | None = None, app: str = "aerolake", **extra: str) -> SparkSession:
    """A session with the settings the operators expect; the cluster's own
    partition counts and memory settings stay in force unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere the run-time settings that matter."""
    for key, value in (WIDE_ROWS | COMPACT).items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="aerolake-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Every executor must be able to read it, so the session has to name the root. A
    local session of one process that names none gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/aerolake/{purpose}-{uuid.uuid4().hex}"
