"""Counts on the user table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def count_by(df: DataFrame, column: str, id_column: str = "id") -> DataFrame:
    return df.groupBy(column).agg(F.count(id_column).alias("n"))


STATED = {"role": "role", "status": "signatureStatus", "notifications": "notifications"}


def combinations(df: DataFrame, names: dict[str, str] = STATED, id_column: str = "id") -> DataFrame:
    """Rows per combination of the columns that statistics break down by, a handful: the
    columns and ``c``."""
    return df.groupBy(*names.values()).agg(F.count(id_column).alias("c"))


def stats_of(combos: DataFrame, names: dict[str, str] = STATED) -> DataFrame:
    """Total and breakdowns as ``breakdown, value, n`` from counted combinations."""
    lines = F.array(
        F.struct(F.lit("total").alias("breakdown"), F.lit(None).cast("string").alias("value")),
        *[
            F.struct(F.lit(label).alias("breakdown"), F.col(c).cast("string").alias("value"))
            for label, c in names.items()
        ],
    )
    regrouped = (
        combos.select("c", F.inline(lines))
        .groupBy("breakdown", "value")
        .agg(F.sum("c").alias("n"))
    )
    spark = combos.sparkSession
    zero = spark.range(1).select(
        F.lit("total").alias("breakdown"), F.lit(None).cast("string").alias("value"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return (
        regrouped.unionByName(zero)
        .groupBy("breakdown", "value")
        .agg(F.sum("n").alias("n"))
    )


def user_stats(df: DataFrame, role: str = "role", status: str = "signatureStatus",
               notifications: str = "notifications", id_column: str = "id") -> DataFrame:
    """Total and three breakdowns as ``breakdown, value, n``; an empty table
    gives only its total, 0.

    The table is counted once per combination of the three columns (a handful),
    and only those counts are regrouped. Grouping sets on the table itself would
    first make four copies of every row.
    """
    names = {"role": role, "status": status, "notifications": notifications}
    return stats_of(combinations(df, names, id_column), names)


def changed_combinations(changes: DataFrame) -> DataFrame:
    """What ``before`` and ``after`` (user structs, null where there is none) of changed rows
    take from and add to the combinations."""
    columns = [F.col("_u")[c].alias(c) for c in STATED.values()]
    gone = changes.filter("before IS NOT NULL").select(F.col("before").alias("_u")).select(*columns, F.lit(-1).alias("c"))
    come = changes.filter("after IS NOT NULL").select(F.col("after").alias("_u")).select(*columns, F.lit(1).alias("c"))
    return gone.unionByName(come).groupBy(*STATED.values()).agg(F.sum("c").alias("c")).filter("c != 0")


def merged_combinations(combos: DataFrame, deltas: DataFrame) -> DataFrame:
    """Combinations after changes; the table that was counted is not read."""
    both = combos.unionByName(deltas)
    return both.groupBy(*STATED.values()).agg(F.sum("c").alias("c")).filter("c != 0")
