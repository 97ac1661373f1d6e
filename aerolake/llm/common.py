"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import shared_folder

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# No table of more rows than this is broadcast; larger ones take a salted join.
SMALL_ROWS = 20_000
SALTS = 64

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: it is computed once, and
    a lost executor costs no more than the tasks that ran on it."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def n_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def join_small(rows: DataFrame, few: DataFrame, keys: Sequence[str], n_few: int,
               salt: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined null-safe with ``few``, which is unique in ``keys`` and has ``n_few`` rows.

    A counted table of at most ``SMALL_ROWS`` rows is broadcast; a larger one is
    copied to ``SALTS`` salts, so that a hot key of ``rows`` spreads over as many tasks.
    The key columns of ``few`` are dropped.
    """
    other = few.select(*[F.col(c).alias(f"_few_{c}") if c in keys else F.col(c) for c in few.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_few_{k}")) for k in keys]
    names = [f"_few_{k}" for k in keys]
    if n_few <= SMALL_ROWS:
        on = same[0]
        for c in same[1:]:
            on = on & c
        return rows.join(F.broadcast(other), on, how).drop(*names)
    salted = other.withColumn("_few_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = F.col("_salt") == F.col("_few_salt")
    for c in same:
        on = on & c
    return (rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
            .join(salted, on, how).drop("_salt", "_few_salt", *names))
