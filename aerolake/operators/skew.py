"""Lookups in a table with unique keys that stay balanced under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with this many rows is worth a path of its own; below, a task copes.
HOT_ROWS = 1_000_000
# No more keys than this are ever split off, which bounds what is collected and
# broadcast. Any further key holds less than a thousandth of the rows, and
# adaptive execution can still split its partition.
MOST_HOT = 1000
# Rows looked at to find them. This only picks the path of a key, never a result.
LOOK_AT = 0.01


def hot_keys(df: DataFrame, key: str, least: int | None = None,
             fraction: float | None = None) -> list:
    """The keys that seem to have at least ``least`` rows, largest first."""
    least = HOT_ROWS if least is None else least
    fraction = LOOK_AT if fraction is None else fraction
    seen = df.select(key).filter(F.col(key).isNotNull())
    if fraction < 1:
        seen = seen.sample(fraction, seed=17)
    counts = seen.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least * fraction)
    return [r[0] for r in counts.orderBy(F.desc("_n")).limit(MOST_HOT).collect()]


def lookup_join(rows: DataFrame, table: DataFrame, key: str, how: str = "left",
                hot: list | None = None) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``, unique in ``table``.

    Rows with hot keys join a broadcast of the few table rows they can match (at
    most one per hot key) and are not shuffled; the others join as Spark sees
    fit. Same rows as a plain join for ``left``, ``inner``, ``left_semi`` and
    ``left_anti``. ``hot`` names the keys when they are known already.
    """
    if hot is None:
        hot = hot_keys(rows, key)
    if not hot:
        return rows.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold = rows.filter(~is_hot).join(table, key, how)
    few = F.broadcast(table.filter(F.col(key).isin(hot)))
    return cold.unionByName(rows.filter(is_hot).join(few, key, how))
