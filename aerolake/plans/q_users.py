"""Queries: lookups, keyed changes, statistics, contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import changes, contracts, lookups, stats
from aerolake.operators.contracts import (
    Field, check_digits, check_email, check_enum, check_length, check_range,
)
from aerolake.plans import bindings as b
from aerolake.plans.registry import query

_USER_LIST = ", ".join(model.USER_COLUMNS)


@query("lookup_by_id", f"WITH {b.USERS_SQL} SELECT * FROM users WHERE id = 'u77'")
def lookup_by_id(spark, sf):
    return lookups.lookup_by_id(b.users(spark, sf), "u77")


@query("lookup_by_email", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL}
SELECT r.ordinal, r.email, u.id, u.name, CASE WHEN u.id IS NULL THEN 'not_found' ELSE 'found' END
  AS outcome
FROM requests r LEFT JOIN users u USING (email)""")
def lookup_by_email(spark, sf):
    wanted = b.requests(spark, sf).select("ordinal", "email")
    return lookups.lookup_by_email(b.users(spark, sf).select("id", "name", "email"), wanted)


@query("page_rows", f"WITH {b.USERS_SQL} SELECT * FROM users ORDER BY email OFFSET 40 LIMIT 100")
def page_rows(spark, sf):
    return lookups.page_rows(b.users(spark, sf), "email", 40, 100)


@query("page_rows_deep", f"""
WITH {b.USERS_SQL} SELECT * FROM users ORDER BY role NULLS FIRST, id OFFSET 25 LIMIT 100""")
def page_rows_deep(spark, sf):
    """The parallel way, over a key with nulls that almost every row repeats."""
    return lookups.page_rows(b.users(spark, sf), "role", 25, 100, shallow=0)


@query("page_args_check", """
SELECT o_orderkey, o_orderkey % 7 - 2 >= 0 AND o_custkey % 3 >= 1 AS ok FROM orders""")
def page_args_check(spark, sf):
    ok = lookups.page_args_ok(F.col("o_orderkey") % 7 - 2, F.col("o_custkey") % 3)
    return b.table(spark, sf, "orders").select("o_orderkey", ok.alias("ok"))


@query("sample_rows", f"WITH {b.USERS_SQL} SELECT * FROM users ORDER BY id LIMIT 5")
def sample_rows(spark, sf):
    return lookups.sample_rows(b.users(spark, sf), "id")


# --- keyed changes ------------------------------------------------------------

_UUID = "md5('user' || chr(31) || email || chr(31) || ordinal)"
_ID_SQL = (f"concat_ws('-', substr({_UUID},1,8), substr({_UUID},9,4), substr({_UUID},13,4), "
           f"substr({_UUID},17,4), substr({_UUID},21,12))")


@query("insert_if_absent", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL},
firsts AS (SELECT email, min(ordinal) AS ordinal FROM requests r
           WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.email = r.email) GROUP BY email)
SELECT {_USER_LIST} FROM users
UNION ALL
SELECT {_ID_SQL}, 'order ' || ordinal, email, md5(CAST(ordinal AS VARCHAR)), NULL, '559100000000',
       'user', 'no', TIMESTAMP '{b.NOW}', NULL FROM firsts""")
def insert_if_absent(spark, sf):
    return changes.insert_if_absent(
        b.users(spark, sf), b.insert_requests(spark, sf), b.now())[0]


@query("default_uuid", f"WITH {b.REQUESTS_SQL} SELECT ordinal, email, {_ID_SQL} AS id FROM requests")
def default_uuid(spark, sf):
    rows = b.requests(spark, sf)
    return rows.select(
        "ordinal", "email", changes.default_uuid(F.lit("user"), F.col("email"), F.col("ordinal")).alias("id")
    )


_FOLDED_SQL = """
folded AS (
  SELECT email,
    arg_max(name, ordinal) FILTER (WHERE sets_name) AS name,
    count(*) FILTER (WHERE sets_name) AS n_name,
    min(name) FILTER (WHERE sets_name) AS low, max(name) FILTER (WHERE sets_name) AS high,
    max(ordinal) FILTER (WHERE sets_status) AS status_at,
    count(*) FILTER (WHERE sets_status) AS n_status,
    count(*) FILTER (WHERE sets_status AND status IS NULL) AS n_null,
    count(*) FILTER (WHERE sets_notifications) AS n_notifications
  FROM requests GROUP BY email),
updated AS (
  SELECT u.*, f.low, f.high, f.name AS new_name,
    coalesce(f.n_name, 0) AS n_name, coalesce(f.n_status, 0) AS n_status,
    coalesce(f.n_null, 0) AS n_null, coalesce(f.n_notifications, 0) AS n_notifications,
    s.status AS new_status
  FROM users u LEFT JOIN folded f USING (email) LEFT JOIN requests s ON s.ordinal = f.status_at),
result AS (
  SELECT id, CASE WHEN n_name > 0 THEN new_name ELSE name END AS name, email, password,
    CASE WHEN n_status > 0 THEN new_status ELSE signatureStatus END AS signatureStatus,
    phone_number, role,
    CASE WHEN n_notifications > 0 THEN 'yes' ELSE notifications END AS notifications, created_at,
    CASE WHEN (n_name > 0 AND (low <> name OR high <> name))
           OR (n_status > 0 AND (
                 (signatureStatus IS NULL AND n_null < n_status)
              OR (signatureStatus = 'active' AND n_null > 0)
              OR signatureStatus = 'inactive'))
           OR (n_notifications > 0 AND notifications IS DISTINCT FROM 'yes')
         THEN TIMESTAMP '{now}' END AS updated_at
  FROM updated)"""


@query("partial_update", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL}, {_FOLDED_SQL.replace('{now}', b.NOW)}
SELECT {_USER_LIST} FROM result""")
def partial_update(spark, sf):
    return changes.partial_update(b.users(spark, sf), b.requests(spark, sf), b.now())[0]


@query("touch_updated_at", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL}, {_FOLDED_SQL.replace('{now}', b.NOW)}
SELECT email, updated_at FROM result""")
def touch_updated_at(spark, sf):
    after, _ = changes.partial_update(b.users(spark, sf), b.requests(spark, sf), b.now())
    return after.select("email", "updated_at")


# Moves: a third wants one taken address, others a free one or their own.
_TARGET = ("CASE WHEN o_orderkey % 3 = 1 THEN 'customer9@example.com' "
           "WHEN o_orderkey % 3 = 2 THEN {free} ELSE 'customer7@example.com' END")


@query("email_change_conflict", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL},
wanted AS (SELECT r.ordinal, r.email,
             {_TARGET.format(free="'free' || o_orderkey || '@example.com'")} AS target
           FROM requests r JOIN orders ON o_orderkey = r.ordinal)
SELECT ordinal, email, CASE WHEN target <> email THEN target END AS new_email,
       target <> email AND EXISTS (SELECT 1 FROM users u WHERE u.email = target) AS taken
FROM wanted""")
def email_change_conflict(spark, sf):
    target = _TARGET.format(free="concat('free', ordinal, '@example.com')").replace(
        "o_orderkey", "ordinal")
    asked = b.requests(spark, sf).withColumn("changes", F.expr(f"map('email', {target})"))
    judged = changes.email_change_conflict(b.users(spark, sf), asked)
    return judged.select("ordinal", "email", "new_email", "taken")


@query("delete_by_email", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL}
SELECT email, id, EXISTS (SELECT 1 FROM requests r WHERE r.email = u.email) AS deleted FROM users u""")
def delete_by_email(spark, sf):
    remaining, deleted, _ = changes.delete_by_email(
        b.users(spark, sf), b.requests(spark, sf, "delete"))
    return remaining.select("email", "id", F.lit(False).alias("deleted")).unionByName(
        deleted.select("email", "id", F.lit(True).alias("deleted")))


@query("request_outcome", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL},
known AS (SELECT r.*, EXISTS (SELECT 1 FROM users u WHERE u.email = r.email) AS found,
                 row_number() OVER (PARTITION BY r.email ORDER BY r.ordinal) = 1 AS is_first
          FROM requests r),
judged AS (
  SELECT ordinal, 'insert' AS op,
         CASE WHEN NOT found AND is_first THEN 'ok' ELSE 'conflict' END AS outcome FROM known
  UNION ALL
  SELECT ordinal, 'delete', CASE WHEN found AND is_first THEN 'ok' ELSE 'not_found' END FROM known
  UNION ALL
  SELECT ordinal, 'update', CASE WHEN NOT found THEN 'not_found'
         WHEN NOT (sets_name OR sets_status OR sets_notifications) THEN 'no_fields' ELSE 'ok' END
  FROM known)
SELECT ordinal, op, outcome, CASE outcome WHEN 'ok' THEN 200 WHEN 'not_found' THEN 404
       WHEN 'conflict' THEN 409 ELSE 422 END AS status FROM judged""")
def request_outcome(spark, sf):
    users = b.users(spark, sf)
    judged = [
        changes.insert_if_absent(users, b.insert_requests(spark, sf), b.now())[1],
        changes.delete_by_email(users, b.requests(spark, sf, "delete"))[2],
        changes.judge_updates(users, b.requests(spark, sf)),
    ]
    shown = [
        j.select("ordinal", "op", "outcome", changes.outcome_status(F.col("outcome")).alias("status"))
        for j in judged
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


def mixed_requests(spark, sf):
    """Inserts, deletes, updates and moves in one batch; a third on one e-mail."""
    base = b.requests(spark, sf)
    kind = F.col("ordinal") % 7
    op = F.when(kind == 0, "insert").when(kind == 1, "delete").otherwise("update")
    full = F.expr(
        "map('name', concat('order ', ordinal), 'phone_number', '559100000000', "
        "'password', md5(CAST(ordinal AS STRING)), 'role', 'user')")
    goal = F.expr("map('email', concat('customer', ordinal * 31 % 500, '@example.com'))")
    wanted = F.when(kind == 0, full).when(kind >= 5, F.map_concat(
        F.map_filter("changes", lambda k, _: k != "email"), goal)).otherwise(F.col("changes"))
    return base.withColumn("op", op).withColumn("changes", wanted)


@query("apply_changes")
def apply_changes(spark, sf):
    """No SQL twin: one-at-a-time order needs a loop. Tested against one."""
    return changes.apply_changes(b.users(spark, sf), mixed_requests(spark, sf), b.now())[0]


@query("mixed_outcomes", f"""
WITH {b.USERS_SQL}, {b.REQUESTS_SQL},
batch AS (
  SELECT *, CASE ordinal % 7 WHEN 0 THEN 'insert' WHEN 1 THEN 'delete' ELSE 'update' END AS op,
         CASE ordinal % 7 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS leaves
  FROM requests),
seen AS (
  SELECT *, coalesce(
      last_value(leaves IGNORE NULLS) OVER (
        PARTITION BY email ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      CASE WHEN email IN (SELECT email FROM users) THEN 1 ELSE 0 END) AS there
  FROM batch)
SELECT ordinal, op, email, CASE
    WHEN op = 'insert' THEN CASE there WHEN 1 THEN 'conflict' ELSE 'ok' END
    WHEN there = 0 THEN 'not_found'
    WHEN op = 'update' AND NOT (sets_name OR sets_status OR sets_notifications) THEN 'no_fields'
    ELSE 'ok' END AS outcome
FROM seen""")
def mixed_outcomes(spark, sf):
    """A mixed batch without moves: there SQL can follow each address by itself."""
    batch = mixed_requests(spark, sf).withColumn(
        "changes", F.when(F.col("op") == "update", F.map_filter("changes", lambda k, _: k != "email"))
        .otherwise(F.col("changes")))
    judged = changes.apply_changes(b.users(spark, sf), batch, b.now())[1]
    return judged.select("ordinal", "op", "email", "outcome")


# --- statistics ---------------------------------------------------------------


@query("count_rows", "SELECT count(*) AS total FROM customer")
def count_rows(spark, sf):
    return stats.count_rows(b.users(spark, sf))


@query("count_by_role", f"WITH {b.USERS_SQL} SELECT role, count(id) AS n FROM users GROUP BY role")
def count_by_role(spark, sf):
    return stats.count_by(b.users(spark, sf), "role")


@query("count_by_status",
       f"WITH {b.USERS_SQL} SELECT signatureStatus, count(id) AS n FROM users GROUP BY signatureStatus")
def count_by_status(spark, sf):
    return stats.count_by(b.users(spark, sf), "signatureStatus")


@query("count_by_notifications",
       f"WITH {b.USERS_SQL} SELECT notifications, count(id) AS n FROM users GROUP BY notifications")
def count_by_notifications(spark, sf):
    return stats.count_by(b.users(spark, sf), "notifications")


@query("user_stats", f"""
WITH {b.USERS_SQL}
SELECT CASE grouping_id(role, signatureStatus, notifications)
         WHEN 3 THEN 'role' WHEN 5 THEN 'status' WHEN 6 THEN 'notifications' ELSE 'total' END
         AS breakdown,
       CASE grouping_id(role, signatureStatus, notifications)
         WHEN 3 THEN role WHEN 5 THEN signatureStatus WHEN 6 THEN notifications END AS value,
       count(id) AS n
FROM users GROUP BY GROUPING SETS ((role), (signatureStatus), (notifications), ())""")
def user_stats(spark, sf):
    return stats.user_stats(b.users(spark, sf))


# --- contracts ----------------------------------------------------------------


def _violations(rows, fields, key):
    return contracts.violations(contracts.check_contract(rows, fields), key)


def _report_sql(source: str, key: str, *lines: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, '{column}' AS \"column\", '{rule}' AS rule FROM {source} WHERE {test}"
        for column, rule, test in lines
    )


@query("check_range", _report_sql(
    "part", "p_partkey",
    ("p_partkey", "range", "p_partkey <= 0"),
    ("p_size", "range", "p_size < 5 OR p_size > 40"),
    ("p_retailprice", "range", "p_retailprice <= 1000")))
def check_range_query(spark, sf):
    return _violations(b.table(spark, sf, "part"), (
        Field("p_partkey", "int", (check_range(gt=0),)),
        Field("p_size", "int", (check_range(ge=5, le=40),)),
        Field("p_retailprice", "decimal", (check_range(gt=1000),)),
    ), "p_partkey")


@query("check_length", _report_sql(
    "documents", "doc_id",
    ("text", "length", "length(text) < 100 OR length(text) > 5000"),
    ("source", "length", "length(source) < 5")))
def check_length_query(spark, sf):
    return _violations(b.table(spark, sf, "documents"), (
        Field("text", "text", (check_length(100, 5000),)),
        Field("source", "text", (check_length(5),)),
    ), "doc_id")


@query("check_digits", _report_sql(
    "customer", "c_custkey",
    ("c_acctbal", "digits",
     "abs(c_acctbal) >= 1000 OR round(c_acctbal * 100) % 10 <> 0")))
def check_digits_query(spark, sf):
    return _violations(
        b.table(spark, sf, "customer"),
        (Field("c_acctbal", "float", (check_digits(4, 1),)),), "c_custkey")


@query("check_enum", _report_sql(
    "orders", "o_orderkey",
    ("o_orderstatus", "enum", "o_orderstatus NOT IN ('F', 'O')"),
    ("o_orderpriority", "enum", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")))
def check_enum_query(spark, sf):
    return _violations(b.table(spark, sf, "orders"), (
        Field("o_orderstatus", "text", (check_enum("F", "O"),)),
        Field("o_orderpriority", "text", (check_enum("1-URGENT", "2-HIGH"),)),
    ), "o_orderkey")


_MAIL = ("CASE c_custkey % 5 WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN 'no at sign' "
         "WHEN 3 THEN 'two@@example.com' ELSE 'a b@example.com' END")


@query("check_email", _report_sql("customer", "c_custkey", ("email", "email", "c_custkey % 5 >= 2")))
def check_email_query(spark, sf):
    mail = _MAIL.format("concat('c', c_custkey, '@example.com')",
                        "concat('c.x+', c_custkey, '@mail.example.org')")
    rows = b.table(spark, sf, "customer").selectExpr("c_custkey", f"{mail} AS email")
    return _violations(rows, (Field("email", "text", (check_email(),)),), "c_custkey")


_FAVORITE = {
    "userId": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END",
    "placeId": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END",
}


@query("check_required", _report_sql(
    "orders", "o_orderkey",
    ("user_id", "required", "o_custkey % 4 = 0"),
    ("place_id", "required", "o_orderkey % 5 = 0"),
    ("name", "required", "true")))
def check_required_query(spark, sf):
    """A column that is absent altogether is missing in every row, even one that
    may be null."""
    rows = b.table(spark, sf, "orders").selectExpr(
        "o_orderkey", *[f"{e} AS {c}" for c, e in _FAVORITE.items()], "o_orderdate AS createdAt")
    named = contracts.contract_rename(rows, "favorite_place", outward=False)
    return _violations(named, "favorite_place", "o_orderkey")


@query("check_type", _report_sql(
    "orders", "o_orderkey",
    ("whole", "type", "o_orderkey % 4 IN (1, 2)"),
    ("number", "type", "o_orderkey % 3 = 2"),
    ("moment", "type", "o_orderkey % 5 = 4")))
def check_type_query(spark, sf):
    rows = b.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 4 WHEN 0 THEN '12' WHEN 1 THEN '1.5' WHEN 2 THEN 'abc' END AS whole",
        "CASE o_orderkey % 3 WHEN 0 THEN '1e3' WHEN 1 THEN '-0.5' ELSE '1,5' END AS number",
        "CASE o_orderkey % 5 WHEN 4 THEN '2025-13-01' ELSE '2025-01-06T12:00:00Z' END AS moment",
    )
    return _violations(rows, (
        Field("whole", "int", nullable=True), Field("number", "float"), Field("moment", "datetime"),
    ), "o_orderkey")


_SHARED = ("CASE WHEN o_orderkey % 3 = 0 THEN -1 WHEN o_orderkey % 5 = 0 THEN o_custkey "
           "ELSE 1000000 + o_orderkey END")


@query("check_unique", f"""
WITH v AS (SELECT o_orderkey, {_SHARED} AS v FROM orders)
SELECT o_orderkey, 'v' AS "column", 'unique' AS rule FROM v
WHERE v IN (SELECT v FROM v GROUP BY v HAVING count(*) > 1)""")
def check_unique_query(spark, sf):
    rows = b.table(spark, sf, "orders").selectExpr("o_orderkey", f"{_SHARED} AS v")
    return contracts.check_unique(rows, "v", "o_orderkey")


@query("check_not_null", f"WITH {b.USERS_SQL} " + _report_sql(
    "users", "id", *[(c, "not_null", f"{c} IS NULL") for c in
                     (*model.USER_NOT_NULL, "role", "notifications")]))
def check_not_null_query(spark, sf):
    return contracts.check_not_null(
        b.users(spark, sf), (*model.USER_NOT_NULL, "role", "notifications"), "id")


_PLACE = {
    "id": "c_custkey",
    "name": "CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN repeat(c_name, 6) ELSE c_name END",
    "latitude": "c_acctbal / 100",
    "longitude": "c_acctbal / 50 - 100",
    "created_at": "CASE WHEN c_custkey % 9 <> 0 THEN '2025-01-06 12:00:00' END",
}


@query("validate_contract", f"""
WITH places AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _PLACE.items())} FROM customer),
found AS ({_report_sql(
    "places", "id",
    ("id", "range", "id <= 0"),
    ("name", "length", "length(name) < 1 OR length(name) > 100"),
    ("latitude", "range", "latitude < -90 OR latitude > 90"),
    ("longitude", "range", "longitude < -180 OR longitude > 180"),
    ("created_at", "required", "created_at IS NULL"),
    ("updated_at", "required", "created_at IS NULL"))})
SELECT id, "column", rule FROM found
UNION ALL
SELECT id, NULL, 'valid' FROM places WHERE id NOT IN (SELECT id FROM found)""")
def validate_contract(spark, sf):
    rows = b.table(spark, sf, "customer").selectExpr(
        *[f"{e} AS {c}" for c, e in _PLACE.items()],
        f"{_PLACE['created_at']} AS updated_at",
    )
    valid, broken = contracts.validate_contract(rows, "place", "id")
    return broken.unionByName(valid.select(
        "id", F.lit(None).cast("string").alias("column"), F.lit("valid").alias("rule")))
