"""Queries: keyed changes in place on a table bucketed by e-mail."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolake.plans import bindings as b
from aerolake.plans import q_users  # noqa: F401  the SQL twins
from aerolake.plans import user_buckets
from aerolake.plans.registry import ORACLES, query
from aerolake.session import shared_folder

BUCKETS = 16


def kept(spark: SparkSession, users: DataFrame, use: Callable[[str], DataFrame | None]) -> DataFrame:
    """What ``use(table)`` gives, or the users after it. The table is there meanwhile only,
    so the rows are stored."""
    table, folder = f"aerolake_users_{uuid.uuid4().hex}", shared_folder(spark, "users")
    user_buckets.create_user_table(spark, table, folder, BUCKETS, users)
    try:
        rows = use(table)
        if rows is None:
            rows = user_buckets.users_of(spark, table)
        return user_buckets.stored(rows, "users-after")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def done(judged: DataFrame) -> None:
    """The users are asked for, not the outcomes."""


@query("bucketed_partial_update", ORACLES["partial_update"])
def bucketed_partial_update(spark, sf):
    requests = b.requests(spark, sf)
    return kept(spark, b.users(spark, sf), lambda t: done(user_buckets.update_users(spark, t, requests, b.now())))


@query("bucketed_insert_if_absent", ORACLES["insert_if_absent"])
def bucketed_insert_if_absent(spark, sf):
    requests = b.insert_requests(spark, sf)
    return kept(spark, b.users(spark, sf), lambda t: done(user_buckets.insert_users(spark, t, requests, b.now())))


@query("bucketed_delete", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL}
SELECT u.* FROM users u WHERE NOT EXISTS (SELECT 1 FROM requests r WHERE r.email = u.email)""")
def bucketed_delete(spark, sf):
    requests = b.requests(spark, sf, "delete")
    return kept(spark, b.users(spark, sf), lambda t: done(user_buckets.delete_users(spark, t, requests)))


@query("bucketed_lookup", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL}
SELECT r.ordinal, r.email, u.id FROM requests r LEFT JOIN users u USING (email)""")
def bucketed_lookup(spark, sf):
    """Users where they lie; only the requests are shuffled."""
    requests = b.requests(spark, sf).select("ordinal", "email")

    def met(table: str) -> DataFrame:
        return requests.join(user_buckets.users_of(spark, table).select("email", "id"), "email", "left").select("ordinal", "email", "id")

    return kept(spark, b.users(spark, sf), met)
