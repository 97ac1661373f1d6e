"""Lookups, paging and samples on the user table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.operators.numbering import surrogate_id
from aerolake.operators.skew import lookup_join

# Up to here a page is cut by a top-k per task, merged in one small task.
SHALLOW_ROWS = 100_000


def lookup_by_id(users: DataFrame, user_id: str, column: str = "id") -> DataFrame:
    return users.filter(F.col(column) == user_id).limit(1)


def lookup_ids(users: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """The users whose id occurs in ``ids``."""
    return users.join(ids.select(column), column, "left_semi")


def lookup_by_email(users: DataFrame, wanted: DataFrame, column: str = "email") -> DataFrame:
    """Every wanted e-mail with its user, ``outcome`` ``found`` or ``not_found``."""
    found = lookup_join(wanted, users.withColumn("_hit", F.lit(True)), column, "left")
    outcome = F.when(F.col("_hit"), "found").otherwise("not_found")
    return found.withColumn("outcome", outcome).drop("_hit")


def page_args_ok(skip: Column, limit: Column) -> Column:
    """The same check for a batch of page requests."""
    return (skip >= 0) & (limit >= 1)


def check_page(skip: int, limit: int) -> None:
    if skip < 0 or limit < 1:
        raise ValueError("skip must not be negative and limit must be positive")


def page_rows(df: DataFrame, key: str, skip: int = 0, limit: int = 100,
              shallow: int | None = None) -> DataFrame:
    """Rows ``skip .. skip+limit`` in order of key, then of the other columns.

    Null keys come first and rows alike in all columns are still rows of their own, at
    any depth. A page near the front is a top-k. A deep page would make that top-k as
    large as the table, so the rows are numbered in parallel instead and the page is a
    filter on the number.
    """
    check_page(skip, limit)
    order = (key, *[c for c in df.columns if c != key])
    if skip + limit <= (SHALLOW_ROWS if shallow is None else shallow):
        return df.orderBy(*order).offset(skip).limit(limit)
    numbered = surrogate_id(df, order, id_column="_position")
    wanted = numbered.filter(F.col("_position").between(skip + 1, skip + limit))
    return wanted.orderBy("_position").select(*df.columns)


def sample_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(key).limit(n)
