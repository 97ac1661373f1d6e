"""Queries: every declared contract on rows made from a test table.

A binding is the table, its key, the contract's columns in SQL that both dialects
read alike, and the violations that follow from the plain columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolake.operators import contracts
from aerolake.plans import bindings as b
from aerolake.plans.registry import query

_SOON = "CASE WHEN {0} % 6 = 0 THEN 'soon' ELSE '2025-01-06T12:00:00Z' END"

BINDINGS = {
    "data_source": ("supplier", "s_suppkey", {
        "id": "s_suppkey",
        "name": "CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE s_name END",
    }, [
        ("id", "range", "s_suppkey <= 0"),
        ("name", "required", "s_suppkey % 4 = 1"),
    ]),
    "air_quality": ("lineitem", "l_orderkey", {
        "id": "l_orderkey",
        "place_id": "l_suppkey",
        "source_id": "l_linenumber - 1",
        "aqi_universal": "l_quantity - 10",
        "name_display": "CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END",
        "display_value": "l_linestatus",
        "created_at": "l_shipdate",
    }, [
        ("id", "range", "l_orderkey <= 0"),
        ("place_id", "range", "l_suppkey <= 0"),
        ("source_id", "range", "l_linenumber <= 1"),
        ("aqi_universal", "range", "l_quantity < 10"),
        ("name_display", "length", "l_returnflag = 'A'"),
    ]),
    "pollutant": ("lineitem", "l_orderkey", {
        "id": "l_orderkey + 1",
        "place_id": "l_suppkey + 1",
        "data_source_id": "l_partkey",
        "dominant_pollutant":
            "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN repeat('x', 51) ELSE 'pm10' END",
        "concentration": "l_extendedprice",
        "metric_unit": "repeat('u', l_linenumber * 4)",
        "created_at": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END",
    }, [
        ("data_source_id", "range", "l_partkey <= 0"),
        ("dominant_pollutant", "length", "l_linenumber <= 2"),
        ("concentration", "digits", "l_extendedprice >= 1000"),
        ("metric_unit", "length", "l_linenumber > 5"),
        ("created_at", "required", "l_linenumber = 3"),
    ]),
    "sensor": ("part", "p_partkey", {
        "id": "p_partkey",
        "place_id": "p_size",
        "source_id": "p_size - 20",
        "water_level": "p_retailprice",
        "water_level_unit": "p_name || p_type",
        "created_at": _SOON.format("p_partkey"),
    }, [
        ("id", "range", "p_partkey <= 0"),
        ("source_id", "range", "p_size <= 20"),
        ("water_level", "digits", "p_retailprice >= 1000"),
        ("water_level_unit", "length", "length(p_name || p_type) > 20"),
        ("created_at", "type", "p_partkey % 6 = 0"),
    ]),
    "weather": ("events", "event_id", {
        "id": "event_id",
        "place_id": "user_id",
        "source_id": "event_id % 3",
        "temperature": "value",
        "humidity": "CASE WHEN event_id % 10 = 3 THEN NULL ELSE value END",
        "wind_speed": "value",
        "wind_direction": "CASE WHEN event_id % 4 = 0 THEN '1.5' ELSE '90' END",
        "created_at": "ts",
    }, [
        ("place_id", "range", "user_id <= 0"),
        ("source_id", "range", "event_id % 3 = 0"),
        ("temperature", "digits", "value >= 1000"),
        ("humidity", "required", "event_id % 10 = 3"),
        ("wind_speed", "digits", "value >= 100"),
        ("wind_direction", "type", "event_id % 4 = 0"),
    ]),
    "favorite_place": ("orders", "o_orderkey", {
        "user_id": "CASE WHEN o_custkey % 2 = 0 THEN 'u' || o_custkey ELSE '' || o_custkey END",
        "place_id": "o_orderkey",
        "created_at": "o_orderdate",
        "name": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END",
    }, [
        ("user_id", "type", "o_custkey % 2 = 0"),
        ("place_id", "range", "o_orderkey <= 0"),
    ]),
    "subscription": ("orders", "o_orderkey", {
        "id": "o_orderkey",
        "user_id": "CASE WHEN o_custkey % 5 = 0 THEN '' ELSE 'u' || o_custkey END",
        "place_id": "o_custkey",
        "start_date": "o_orderdate",
        "end_date": "o_orderdate",
        "status": "CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'failed' ELSE 'open' END",
        "created_at": "o_orderdate",
        "updated_at": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END",
    }, [
        ("user_id", "length", "o_custkey % 5 = 0"),
        ("place_id", "range", "o_custkey <= 0"),
        ("status", "enum", "o_orderstatus NOT IN ('O', 'F')"),
        ("updated_at", "required", "o_orderkey % 3 = 0"),
    ]),
    "subscription_plan": ("part", "p_partkey", {
        "id": "p_partkey",
        "name": "CASE WHEN p_partkey % 5 = 0 THEN repeat(p_name, 20) ELSE p_name END",
        "description": "CASE WHEN p_size > 25 THEN p_type END",
        "days_time_duration": "p_brand",
        "price": "p_retailprice - 1000",
    }, [
        ("name", "length", "p_partkey % 5 = 0 AND length(p_name) * 20 > 100"),
        ("description", "required", "p_size <= 25"),
        ("price", "range", "p_retailprice <= 1000"),
    ]),
    "message": ("conversations", "conv_id", {
        "to": "CASE turn % 3 WHEN 0 THEN '+559188772828' WHEN 1 THEN '123' "
              "ELSE '+5591887728281234' END",
        "place": "text",
        "floor": "CASE WHEN role = 'user' THEN '' ELSE role END",
    }, [
        ("to", "length", "turn % 3 <> 0"),
        ("place", "length", "length(text) < 1"),
        ("floor", "length", "role = 'user'"),
    ]),
}

_USER = {
    "name": "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END",
    "email": "CASE WHEN c_custkey % 7 = 0 THEN 'no mail' ELSE 'c' || c_custkey || '@example.com' END",
    "signatureStatus": "CASE WHEN c_acctbal > 0 THEN 'active' END",
    "phone_number": "CASE WHEN c_custkey % 3 = 0 THEN '123' ELSE '55919' || (c_custkey + 1000000) END",
    "role": "c_mktsegment",
    "notifications": "CASE WHEN c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END",
    "password": "CASE WHEN c_custkey % 4 = 0 THEN 'short' ELSE md5(c_name) END",
}
_USER_BROKEN = [
    ("email", "email", "c_custkey % 7 = 0"),
    ("phone_number", "length", "c_custkey % 3 = 0"),
    ("role", "enum", "true"),
    ("password", "length", "c_custkey % 4 = 0"),
]
BINDINGS["user_create"] = ("customer", "c_custkey", {"id": "'u' || c_custkey", **_USER}, [
    *_USER_BROKEN, ("name", "length", "c_custkey % 5 = 0"),
])
# An update may leave fields out and has no rule for the length of a name.
BINDINGS["user_update"] = (
    "customer", "c_custkey", {k: v for k, v in _USER.items() if k != "notifications"}, _USER_BROKEN
)


def _oracle(table: str, key: str, broken) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, '{column}' AS \"column\", '{rule}' AS rule FROM {table} WHERE {test}"
        for column, rule, test in broken
    )


def _register(contract: str) -> None:
    table, key, columns, broken = BINDINGS[contract]

    @query(f"contract_{contract}", _oracle(table, key, broken))
    def run(spark, sf):
        rows = b.table(spark, sf, table).select(
            F.col(key), *[F.expr(e).alias(c) for c, e in columns.items()])
        return contracts.validate_contract(rows, contract, key)[1]


for _name in BINDINGS:
    _register(_name)
