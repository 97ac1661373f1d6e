"""Queries: places, requests, responses, scalar functions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from aerolake import model
from aerolake.functions import casts, documents
from aerolake.operators import contracts, reshape
from aerolake.plans import bindings as b
from aerolake.plans.registry import query
from aerolake.sources import api, landed, places, polling, synthetic
from aerolake.session import shared_folder


@query("places_from_map", f"WITH {b.PLACES_SQL} SELECT nome, latitude, longitude FROM places")
def places_from_map(spark, sf):
    packed = b.places(spark, sf).select(
        F.to_json(F.create_map("nome", F.array("latitude", "longitude"))).alias("places")
    )
    return places.places_from_map(packed)


@query("weather_requests", f"""
WITH {b.PLACES_SQL}
SELECT nome, 'GET' AS method, 'https://api.openweathermap.org/data/2.5/weather' AS url,
       CAST(latitude AS VARCHAR) AS lat, CAST(longitude AS VARCHAR) AS lon, 'metric' AS units
FROM places""")
def weather_requests(spark, sf):
    built = places.weather_requests(b.places(spark, sf))
    return built.select("nome", "method", "url", "lat", "lon", "units")


@query("air_quality_requests", f"""
WITH {b.PLACES_SQL}
SELECT nome, 'POST' AS method, true AS universal, latitude, longitude,
       'DOMINANT_POLLUTANT_CONCENTRATION,POLLUTANT_CONCENTRATION,LOCAL_AQI' AS extra,
       'pt-br' AS language
FROM places""")
def air_quality_requests(spark, sf):
    built = places.air_quality_requests(b.places(spark, sf))
    shape = ("universalAqi boolean, location struct<latitude:double,longitude:double>, "
             "extraComputations array<string>, languageCode string")
    return built.select("nome", "method", F.from_json("body", shape).alias("r")).select(
        "nome", "method", F.col("r.universalAqi").alias("universal"),
        "r.location.latitude", "r.location.longitude",
        F.array_join("r.extraComputations", ",").alias("extra"),
        F.col("r.languageCode").alias("language"),
    )


@query("city_requests", """
SELECT s_name AS q, 'https://api.openweathermap.org/data/2.5/weather' AS url,
       'metric' AS units, 'pt_br' AS lang FROM supplier""")
def city_requests(spark, sf):
    return places.city_requests(b.table(spark, sf, "supplier"), "s_name").select(
        "q", "url", "units", "lang"
    )


def echo(method, url, params, payload):
    """Stub fetcher: answers with its own request."""
    return 200, json.dumps({"method": method, "params": params, "payload": payload})


def _echoed(name):
    return F.get_json_object("body", f"$.{name}").alias(name.split(".")[-1])


@query("weather_source", f"""
WITH {b.PLACES_SQL}
SELECT nome, latitude, longitude, 200 AS status, CAST(latitude AS VARCHAR) AS lat,
       CAST(longitude AS VARCHAR) AS lon, 'metric' AS units FROM places""")
def weather_source(spark, sf):
    built = places.weather_requests(b.places(spark, sf))
    return api.weather_source(spark, built, echo).select(
        "nome", "latitude", "longitude", "status",
        _echoed("params.lat"), _echoed("params.lon"), _echoed("params.units"),
    )


@query("air_quality_source", f"""
WITH {b.PLACES_SQL}
SELECT nome, 200 AS status, 'POST' AS method, latitude AS asked_latitude FROM places""")
def air_quality_source(spark, sf):
    built = places.air_quality_requests(b.places(spark, sf))
    asked = F.get_json_object(F.get_json_object("body", "$.payload"), "$.location.latitude")
    return api.air_quality_source(spark, built, echo).select(
        "nome", "status", _echoed("method"), asked.cast("double").alias("asked_latitude")
    )


@query("city_weather_source", """
SELECT s_name AS q, 200 AS status, 'pt_br' AS lang FROM supplier""")
def city_weather_source(spark, sf):
    built = places.city_requests(b.table(spark, sf, "supplier"), "s_name")
    return api.city_weather_source(spark, built, echo).select("q", "status", _echoed("params.lang"))


@query("fan_out", f"""
WITH {b.PLACES_SQL}
SELECT nome, ordinal, 200 AS status, CAST(latitude AS VARCHAR) AS lat FROM places""")
def fan_out(spark, sf):
    built = places.weather_requests(b.places(spark, sf))
    return api.fan_out(built, echo, 16).select("nome", "ordinal", "status", _echoed("params.lat"))


@query("bronze_scan", f"""
WITH {b.READINGS_SQL}, half AS (SELECT max(event_id) // 2 AS h FROM events)
SELECT 'all' AS scan, event_id AS id, place AS root FROM readings
UNION ALL
SELECT 'new', event_id, place FROM readings, half WHERE event_id > h""")
def bronze_scan(spark, sf):
    """Everything, and what came after the first half."""
    folder = shared_folder(spark, "bronze")
    b.weather_bronze(b.readings(spark, sf)).write.parquet(folder)
    half = spark.read.parquet(folder).agg(F.max("id")).head()[0] // 2
    root = documents.root_key(F.col("data")).alias("root")
    scans = {"all": landed.bronze_scan(spark, folder),
             "new": landed.bronze_scan(spark, folder, after_id=half)}
    parts = [rows.select(F.lit(name).alias("scan"), "id", root) for name, rows in scans.items()]
    return parts[0].unionByName(parts[1])


@query("user_scan", f"WITH {b.USERS_SQL} SELECT * FROM users")
def user_scan(spark, sf):
    folder = shared_folder(spark, "users")
    b.users(spark, sf).write.parquet(folder)
    return landed.user_scan(spark, folder)


def _draw_sql(purpose, n):
    digest = f"md5('42|{purpose}|' || c_custkey)"
    return f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % {n}"


def _pick_sql(values, purpose):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw_sql(purpose, len(values))} + 1]"


_H = "md5('42' || chr(31) || c_custkey)"


@query("synthetic_users", f"""
SELECT concat_ws('-', substr({_H},1,8), substr({_H},9,4), substr({_H},13,4), substr({_H},17,4),
                 substr({_H},21,12)) AS id,
       {_pick_sql(synthetic.FIRST_NAMES, 'first')} || ' ' || {_pick_sql(synthetic.LAST_NAMES, 'last')}
         AS name,
       'user' || c_custkey || '@example.com' AS email,
       md5('pw|42|' || c_custkey) AS password,
       {_pick_sql(model.SIGNATURE_STATUSES, 'status')} AS signatureStatus,
       substr('55' || lpad(CAST({_draw_sql('area', 90)} AS VARCHAR), 2, '0')
              || lpad(CAST({_draw_sql('line', 1_000_000_000)} AS VARCHAR), 9, '0')
              || '0000000000', 1, 20) AS phone_number,
       {_pick_sql(model.ROLES, 'role')} AS role,
       {_pick_sql(model.NOTIFICATIONS, 'notifications')} AS notifications,
       TIMESTAMP '{b.NOW}' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM customer""")
def synthetic_users(spark, sf):
    numbers = b.table(spark, sf, "customer")
    return synthetic.users_for(numbers, "c_custkey", 42, b.now())


@query("tag_response", f"""
WITH {b.READINGS_SQL}
SELECT place AS nome, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude,
       200 AS status, event_id AS ordinal, description FROM readings""")
def tag_response(spark, sf):
    tagged = reshape.tag_response(b.weather_responses(b.readings(spark, sf)))
    return tagged.select(
        "nome", "latitude", "longitude", "status", "ordinal",
        F.get_json_object("body", "$.weather[0].description").alias("description"),
    )


@query("air_quality_reshape", f"""
WITH {b.MEASURES_SQL}
SELECT l_orderkey, l_partkey, l_linenumber, place AS nome,
       CASE WHEN l_linenumber = 3 THEN NULL
            ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
                 || CASE WHEN l_linenumber % 2 = 0 THEN 'Z' ELSE '-03:00' END END AS datetime,
       l_linenumber % 2 = 0 AS no_indexes,
       CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE quantity END AS aqi,
       CASE WHEN {b.NO_SECOND_POLLUTANT} THEN 'o3' ELSE 'no2' END AS second,
       false AS region_kept
FROM measures""")
def air_quality_reshape(spark, sf):
    shaped = reshape.air_quality_reshape(b.air_responses(b.measures(spark, sf)))
    shape = ("datetime string, indexes string, pollutants array<struct<code:string>>, "
             "regionCode string")
    blocks = F.from_json("d.indexes", "array<struct<aqi:int>>")
    return shaped.select("*", F.from_json("doc", shape).alias("d")).select(
        *b.MEASURE_KEYS, "nome", "d.datetime",
        (F.col("d.indexes") == "{}").alias("no_indexes"),
        F.get(blocks, F.lit(0))["aqi"].alias("aqi"),
        F.get("d.pollutants", F.lit(1))["code"].alias("second"),
        F.col("d.regionCode").isNotNull().alias("region_kept"),
    )


@query("weather_flatten", f"""
WITH {b.READINGS_SQL}
SELECT place AS nome, event_id AS ordinal,
       CAST(temp AS DECIMAL(12,3)) AS temperatura, CAST(feels AS DECIMAL(12,3)) AS sensacao_termica,
       CAST(humidity AS DECIMAL(12,3)) AS umidade, CAST(pressure AS DECIMAL(12,3)) AS pressao,
       CAST(speed AS DECIMAL(12,3)) AS velocidade_vento, CAST(deg AS VARCHAR) AS direcao_vento,
       description AS descricao, CAST(sunrise AS VARCHAR) AS nascer_sol,
       CAST(sunrise + 60 AS VARCHAR) AS por_sol
FROM readings""")
def weather_flatten(spark, sf):
    flat = reshape.weather_flatten(b.weather_responses(b.readings(spark, sf)))
    numbers = ("temperatura", "sensacao_termica", "umidade", "pressao", "velocidade_vento")
    return flat.select(
        "nome", "ordinal", *[F.col(c).cast("decimal(12,3)").alias(c) for c in numbers],
        "direcao_vento", "descricao", "nascer_sol", "por_sol",
    )


@query("first_array_element", """
SELECT doc_id, split_part(text, ' ', 1) AS first FROM documents""")
def first_array_element(spark, sf):
    docs = b.table(spark, sf, "documents")
    return docs.select(
        "doc_id", reshape.first_element(F.split("text", " ", -1)).alias("first")
    )


# A third of the events is moved to one place.
_HOT_PLACE = "CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END"


@query("latest_per_place", f"""
SELECT {_HOT_PLACE} AS place, max(event_id) AS ordinal, arg_max(event_type, event_id) AS event_type,
       arg_max(props, event_id) AS doc
FROM events GROUP BY 1""")
def latest_per_place(spark, sf):
    rows = b.table(spark, sf, "events").selectExpr(
        f"{_HOT_PLACE} AS place", "event_id AS ordinal", "event_type", "props AS doc"
    )
    return reshape.latest_per_place(rows, "place", "ordinal")


@query("dict_to_rows", """
SELECT event_id, place, v FROM (
  SELECT event_id, 'u' || user_id AS place, CAST(props->>'k' AS INTEGER) AS v FROM events
  UNION ALL
  SELECT event_id, event_type AS place, -1 AS v FROM events)""")
def dict_to_rows(spark, sf):
    packed = b.table(spark, sf, "events").selectExpr(
        "event_id",
        "concat('{\"u', user_id, '\":', props, ',\"', event_type, '\":{\"k\":-1}}') AS data",
    )
    return reshape.dict_to_rows(packed).select(
        "event_id", "place", F.get_json_object("doc", "$.k").cast("int").alias("v")
    )


@query("wrap_document", """
SELECT doc_id, source || ' "' || lang || '"' AS root, md5(text) AS text_md5, true AS null_kept
FROM documents""")
def wrap_document(spark, sf):
    docs = b.table(spark, sf, "documents").select(
        "doc_id",
        F.concat("source", F.lit(' "'), "lang", F.lit('"')).alias("nome"),
        documents.json_object({
            "text": documents.json_string(F.col("text")),
            "empty": documents.json_scalar(F.lit(None).cast("string")),
        }).alias("doc"),
    )
    wrapped = reshape.wrap_documents(docs)
    opened = wrapped.select("doc_id", F.from_json("data", "map<string,map<string,string>>").alias("m"))
    root = F.get(F.map_keys("m"), F.lit(0))
    return opened.select("doc_id", root.alias("root"), F.element_at("m", root).alias("v")).select(
        "doc_id", "root", F.md5(F.element_at("v", "text")).alias("text_md5"),
        (F.map_contains_key("v", "empty") & F.element_at("v", "empty").isNull()).alias("null_kept"),
    )


@query("epoch_to_local_text", """
SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 10800 SECOND, '%Y-%m-%d %H:%M:%S')
  AS dt FROM events""")
def epoch_to_local_text(spark, sf):
    rows = b.readings(spark, sf)
    return rows.select(
        "event_id", documents.epoch_to_local_text(F.col("sunrise"), F.lit(-10800)).alias("dt")
    )


@query("public_user_view", f"""
WITH {b.USERS_SQL}
SELECT name, email, signatureStatus, phone_number AS phoneNumber, role, notifications,
       created_at AS createdAt, updated_at AS updatedAt FROM users""")
def public_user_view(spark, sf):
    return contracts.public_user_view(b.users(spark, sf))


@query("contract_rename", """
SELECT s_suppkey AS id, s_nationkey AS place_id, s_nationkey AS source_id,
       s_acctbal AS aqiUniversal, s_name AS nameDisplay, s_name AS displayValue
FROM supplier""")
def contract_rename(spark, sf):
    rows = b.table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "s_nationkey AS place_id", "s_nationkey AS source_id",
        "s_acctbal AS aqi_universal", "s_name AS name_display", "s_name AS display_value",
    )
    out = contracts.contract_rename(rows, "air_quality")
    return contracts.contract_rename(
        contracts.contract_rename(out, "air_quality", outward=False), "air_quality"
    )


@query("json_root_key", "SELECT c_custkey, 'z' || c_custkey AS root FROM customer")
def json_root_key(spark, sf):
    rows = b.table(spark, sf, "customer").select(
        "c_custkey",
        F.to_json(F.create_map(
            F.col("c_name"), F.lit("long key"),
            F.concat(F.lit("z"), "c_custkey"), F.lit("short key"),
        )).alias("data"),
    )
    return rows.select("c_custkey", documents.root_key(F.col("data")).alias("root"))


@query("json_path_text", """
SELECT event_id, props->>'k' AS k, CAST(user_id AS VARCHAR) AS second, CAST(NULL AS VARCHAR) AS third
FROM events""")
def json_path_text(spark, sf):
    rows = b.table(spark, sf, "events").selectExpr(
        "event_id",
        "concat('{\"it''s \\\\\"x\\\\\"\":{\"p\":', props, ',\"a\":[{\"v\":1},{\"v\":', user_id, '}]}}')"
        " AS data",
    )
    opened = documents.open_documents(
        rows, "struct<p:struct<k:string>,a:array<struct<v:string>>>", ("event_id",)
    )
    body = F.col("body")
    return opened.select(
        "event_id",
        documents.path_text(body, "p.k").alias("k"),
        documents.path_text(body, "a.1.v").alias("second"),
        documents.path_text(body, "a.2.v").alias("third"),
    )


@query("cast_timestamp_ntz", "SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS t FROM orders")
def cast_timestamp_ntz(spark, sf):
    rows = b.table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "concat(replace(CAST(o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) "
        "AS STRING), ' ', 'T'), "
        "CASE o_orderkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '-03:00' ELSE '' END) AS s",
    )
    return rows.select("o_orderkey", casts.convert(F.col("s"), "timestamp").alias("t"))


@query("cast_int_strict", """
SELECT event_id, CAST(props->>'k' AS INTEGER) AS v,
       CASE WHEN event_id % 2 = 0 THEN CAST(props->>'k' AS INTEGER) END AS safe
FROM events""")
def cast_int_strict(spark, sf):
    text = F.get_json_object("props", "$.k")
    mixed = F.when(F.col("event_id") % 2 == 0, text).otherwise(F.concat(text, F.lit(".0")))
    return b.table(spark, sf, "events").select(
        "event_id", casts.convert(text, "int").alias("v"), casts.try_int(mixed).alias("safe")
    )


@query("cast_int_rounded", f"""
WITH {b.READINGS_SQL} SELECT event_id, CAST(round(humidity) AS INTEGER) AS v FROM readings""")
def cast_int_rounded(spark, sf):
    text = F.col("humidity").cast("string")
    return b.readings(spark, sf).select(
        "event_id", casts.convert(text, "rounded int").alias("v")
    )


@query("cast_bigint_rounded", f"""
WITH {b.READINGS_SQL} SELECT event_id, sunrise + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS v
FROM readings""")
def cast_bigint_rounded(spark, sf):
    tail = F.when(F.col("event_id") % 2 == 0, ".5").otherwise(".4999999999999999999999")
    text = F.concat(F.col("sunrise").cast("string"), tail)
    return b.readings(spark, sf).select(
        "event_id", casts.convert(text, "rounded bigint").alias("v")
    )


@query("cast_decimal", f"""
WITH {b.READINGS_SQL}
SELECT event_id, CAST(feels AS DECIMAL(5,2)) AS d52, CAST(lon AS DECIMAL(10,7)) AS d107,
       CAST(feels AS DECIMAL(4,1)) AS d41, CASE WHEN speed < 10 THEN CAST(speed AS DECIMAL(9,8)) END AS safe
FROM readings""")
def cast_decimal(spark, sf):
    def text(c):
        return F.col(c).cast("string")

    return b.readings(spark, sf).select(
        "event_id",
        casts.convert(text("feels"), "decimal(5,2)").alias("d52"),
        casts.convert(text("lon"), "decimal(10,7)").alias("d107"),
        casts.convert(text("feels"), "decimal(4,1)").alias("d41"),
        casts.try_decimal(text("speed"), 9, 8).alias("safe"),
    )


@query("varchar_guard", """
SELECT doc_id, length(rtrim(text, ' ')) <= 1000 AS fits,
       CASE WHEN length(rtrim(text, ' ')) <= 1000 THEN md5(substr(text, 1, 1000)) END AS kept
FROM documents""")
def varchar_guard(spark, sf):
    kept = casts.try_varchar(F.col("text"), 1000)
    return b.table(spark, sf, "documents").select(
        "doc_id", kept.isNotNull().alias("fits"), F.md5(kept).alias("kept")
    )


@query("truncate_text", "SELECT doc_id, substr(text, 1, 20) AS head FROM documents")
def truncate_text(spark, sf):
    return b.table(spark, sf, "documents").select(
        "doc_id", casts.truncate_text(F.col("text"), 20).alias("head")
    )


_STATUS = ("CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 3 = 0 THEN 404 "
           "WHEN event_id % 3 = 1 THEN 400 ELSE 503 END")


@query("ok_responses", f"""
SELECT event_id, status, CASE status WHEN 200 THEN NULL WHEN 404 THEN 'not_found'
  WHEN 400 THEN 'bad_request' ELSE 'unexpected' END AS error_class
FROM (SELECT event_id, {_STATUS} AS status FROM events)""")
def ok_responses(spark, sf):
    rows = b.table(spark, sf, "events").selectExpr("event_id", f"{_STATUS} AS status")
    good, bad = reshape.ok_responses(rows)
    return good.withColumn("error_class", F.lit(None).cast("string")).unionByName(bad)


@query("error_class", f"""
SELECT status, CASE status WHEN 200 THEN NULL WHEN 404 THEN 'not_found'
  WHEN 400 THEN 'bad_request' ELSE 'unexpected' END AS error_class, count(*) AS n
FROM (SELECT {_STATUS} AS status FROM events) GROUP BY 1, 2""")
def error_class(spark, sf):
    rows = b.table(spark, sf, "events").selectExpr(f"{_STATUS} AS status")
    return rows.groupBy("status", reshape.error_class(F.col("status")).alias("error_class")).agg(
        F.count("*").alias("n")
    )


_ODD_MEMBERS = '"flag":true,"quoted":"0","odd":"[x","open":"{y","n":70.0,"none":null,"deep":{"a":["1",2]}'


@query("city_local_time", f"""
SELECT event_id, strftime(TIMESTAMP '1970-01-01' + to_seconds(1700000000 + event_id - 10800), '%Y-%m-%d %H:%M:%S') AS dt,
       '{{"dt":"' || strftime(TIMESTAMP '1970-01-01' + to_seconds(1700000000 + event_id - 10800), '%Y-%m-%d %H:%M:%S')
         || '","timezone":-10800,{_ODD_MEMBERS}}}' AS body
FROM events""")
def city_local_time(spark, sf):
    """Members of every type pass through as they are."""
    rows = b.table(spark, sf, "events").select("event_id", F.concat(
        F.lit('{"dt":'), (F.lit(1700000000) + F.col("event_id")).cast("string"),
        F.lit(',"timezone":-10800,' + _ODD_MEMBERS + "}")).alias("body"))
    return reshape.city_local_time(rows).select("event_id", "dt", "body")


@query("polled_weather_source", f"""
WITH {b.PLACES_SQL}
SELECT nome, latitude, longitude, 200 AS status, CAST(latitude AS VARCHAR) AS lat, hour
FROM places, (VALUES ('2025-06-01 07:00:00'), ('2025-06-01 09:00:00')) AS h(hour)""")
def polled_weather_source(spark, sf):
    """Started at 7:10, 7:50, 9:00 and 9:59: two hours are polled, once each."""
    folder = shared_folder(spark, "polled")
    columns = polling.land_requests(places.weather_requests(b.places(spark, sf)), f"{folder}/requests")
    for minutes in (430, 470, 540, 599):
        polling.poll(spark, folder.rsplit("/", 1)[-1], f"{folder}/requests", columns, echo, f"{folder}/answers",
                     f"{folder}/checkpoint", lambda at=minutes: 1748736000 + 60 * at).awaitTermination()
    hour = F.date_format(F.to_utc_timestamp("polled", F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    return spark.read.schema(columns).parquet(f"{folder}/answers").select(
        "nome", "latitude", "longitude", "status", _echoed("params.lat"), hour.alias("hour"))
