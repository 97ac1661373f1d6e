"""The test tables in the shapes the operators take.

Each packing has a twin in SQL text, used by the oracles: the operator must give
back what SQL computes from the plain columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import model


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- places -------------------------------------------------------------------

PLACES_SQL = """
places AS (
  SELECT c_name AS nome, c_custkey AS ordinal,
         (c_custkey % 181 - 90) * 0.5::DOUBLE AS latitude,
         (c_custkey % 361 - 180) * 0.25::DOUBLE AS longitude
  FROM customer
)"""


def places(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "c_name AS nome",
        "c_custkey AS ordinal",
        "(c_custkey % 181 - 90) * 0.5D AS latitude",
        "(c_custkey % 361 - 180) * 0.25D AS longitude",
    )


# --- weather: one reading per event -------------------------------------------

# Number columns of a reading. The same text is valid in both dialects.
_READING = {
    "lat": "CAST(user_id % 181 - 90 AS DECIMAL(10,0)) * 0.5",
    "lon": "CAST(event_id % 3600 - 1800 AS DECIMAL(10,0)) * 0.0312500",
    "temp": "CAST(CAST(round(value * 100) AS BIGINT) % 60000 AS DECIMAL(10,0)) * 0.01",
    "feels": "CAST(event_id * 7 % 600000 - 300000 AS DECIMAL(10,0)) * 0.001",
    "humidity": "CAST(event_id % 201 - 100 AS DECIMAL(10,0)) * 0.5",
    "pressure": "CAST(CAST(round(value * 100) AS BIGINT) % 2000 AS DECIMAL(10,0)) + 0.5",
    "speed": "CAST(CAST(round(value * 100) AS BIGINT) % 9999 AS DECIMAL(10,0)) * 0.01",
    "deg": "CAST(user_id % 360 AS INT)",
    "description": "event_type",
}

READINGS_SQL = (
    "readings AS (SELECT event_id, user_id, ts, 'Pau d''Arco \"' || user_id || '\" é' AS place, "
    "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS sunrise, "
    + ", ".join(f"{expr} AS {name}" for name, expr in _READING.items())
    + " FROM events)"
)


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "ts",
        "concat('Pau d''Arco \"', user_id, '\" é') AS place",
        "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS sunrise",
        *[f"{expr} AS {name}" for name, expr in _READING.items()],
    )


def weather_bronze(rows: DataFrame, speed: str = "speed") -> DataFrame:
    """Readings as bronze documents; ``id`` is the event id."""
    document = F.to_json(
        F.expr(
            "map(place, named_struct('latitude', lat, 'longitude', lon, 'data', named_struct("
            "'temperatura', temp, 'sensacao_termica', feels, 'umidade', humidity, "
            f"'pressao', pressure, 'velocidade_vento', {speed}, 'direcao_vento', deg, "
            "'descricao', description, 'nascer_sol', sunrise, "
            "'por_sol', CAST(sunrise AS DECIMAL(18,0)) + 0.5)))"
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(F.col("event_id").alias("id"), document.alias("data"))


# The silver columns of a reading, in SQL.
SILVER_WEATHER_COLUMNS_SQL = """
  place AS bairro,
  CAST(lat AS DECIMAL(10,7)) AS latitude, CAST(lon AS DECIMAL(10,7)) AS longitude,
  CAST(temp AS DECIMAL(5,2)) AS temperatura, CAST(feels AS DECIMAL(5,2)) AS sensacao_termica,
  CAST(round(humidity) AS INTEGER) AS umidade, CAST(round(pressure) AS INTEGER) AS pressao,
  CAST(speed AS DECIMAL(4,2)) AS velocidade_vento, deg AS direcao_vento,
  description AS descricao, sunrise AS nascer_sol, sunrise + 1 AS por_sol"""


def weather_responses(rows: DataFrame) -> DataFrame:
    """Readings as API responses, one per event."""
    body = F.to_json(
        F.expr(
            "named_struct('main', named_struct('temp', temp, 'feels_like', feels, "
            "'humidity', humidity, 'pressure', pressure, 'sea_level', 1000), "
            "'wind', named_struct('speed', speed, 'deg', deg), "
            "'weather', array(named_struct('id', 500, 'description', description)), "
            "'sys', named_struct('country', 'BR', 'sunrise', sunrise, 'sunset', sunrise + 60))"
        )
    )
    return rows.select(
        F.col("place").alias("nome"),
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        F.col("event_id").alias("ordinal"),
        F.lit(200).alias("status"),
        body.alias("body"),
    )


# --- air quality: one measurement per line item --------------------------------

_PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_RATE = "CAST(CAST(round({0} * 100) AS BIGINT) AS DECIMAL(10,0)) * 0.01"


def pollutant_number(position: int) -> str:
    """Value of the pollutant that is packed at a position: seven decimals."""
    return f"CAST({_PRICE} * {position + 1} % 9999999999 AS DECIMAL(18,0)) * 0.0000001"


_MEASURE = {
    "quantity": "CAST(l_quantity AS INT)",
    "discount": _RATE.format("l_discount"),
    "tax": _RATE.format("l_tax"),
    "br_green": "CAST(CAST(l_quantity AS INT) AS DECIMAL(10,0)) * 0.05",
    **{f"p{i}": pollutant_number(i) for i in range(len(model.POLLUTANTS))},
}
# Line numbers whose document lacks a part.
NO_BR_BLOCK = "l_linenumber % 4 = 0"
NO_SECOND_POLLUTANT = "l_linenumber % 7 = 3"

MEASURES_SQL = (
    "measures AS (SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_returnflag, l_linestatus, "
    "'S' || l_suppkey AS place, "
    + ", ".join(f"{expr} AS {name}" for name, expr in _MEASURE.items())
    + " FROM lineitem)"
)
MEASURE_KEYS = ("l_orderkey", "l_partkey", "l_linenumber")


def measures(spark: SparkSession, sf: str) -> DataFrame:
    return measured(table(spark, sf, "lineitem"))


def measured(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        *MEASURE_KEYS, "l_shipdate", "l_returnflag", "l_linestatus",
        "concat('S', l_suppkey) AS place", f"{_PRICE} AS price",
        *[f"{expr} AS {name}" for name, expr in _MEASURE.items()],
    )


_BLOCKS = (
    "named_struct('code', 'uaqi', 'displayName', 'Universal AQI', 'aqi', quantity, "
    "'aqiDisplay', CAST(quantity AS STRING), "
    "'color', named_struct('red', discount, 'green', tax, 'blue', 0.12345678), "
    "'category', l_returnflag, 'dominantPollutant', lower(l_linestatus))",
    "named_struct('code', 'bra_saopaulo', 'displayName', 'AQI (BR)', 'aqi', l_linenumber, "
    "'aqiDisplay', CAST(l_linenumber AS STRING), "
    "'color', named_struct('red', 0.5, 'green', br_green, 'blue', 0.5), "
    "'category', l_linestatus, 'dominantPollutant', 'pm25')",
)


def _plain(column: str) -> str:
    """True for a text that JSON holds as it is; not true for null."""
    return f"NOT ({column} RLIKE '[^A-Za-z0-9 ]')"


# The same blocks put together as text, without a JSON writer for each, and when that text is the one of
# to_json: nothing is null (such members are left out) and no text needs an escape.
_BLOCK_TEXTS = (
    (f"quantity IS NOT NULL AND discount IS NOT NULL AND tax IS NOT NULL AND {_plain('l_returnflag')} AND {_plain('l_linestatus')}",
     "concat('{\"code\":\"uaqi\",\"displayName\":\"Universal AQI\",\"aqi\":', quantity, ',\"aqiDisplay\":\"', quantity, "
     "'\",\"color\":{\"red\":', discount, ',\"green\":', tax, ',\"blue\":0.12345678},\"category\":\"', l_returnflag, "
     "'\",\"dominantPollutant\":\"', lower(l_linestatus), '\"}')"),
    (f"l_linenumber IS NOT NULL AND br_green IS NOT NULL AND {_plain('l_linestatus')}",
     "concat('{\"code\":\"bra_saopaulo\",\"displayName\":\"AQI (BR)\",\"aqi\":', l_linenumber, ',\"aqiDisplay\":\"', l_linenumber, "
     "'\",\"color\":{\"red\":0.5,\"green\":', br_green, ',\"blue\":0.5},\"category\":\"', l_linestatus, "
     "'\",\"dominantPollutant\":\"pm25\"}')"),
)


def _block(position: int) -> str:
    simple, text = _BLOCK_TEXTS[position]
    return f"CASE WHEN {simple} THEN {text} ELSE to_json({_BLOCKS[position]}) END"


def _pollutant(position: int, prefix: str) -> str:
    """As text where the number is written without an exponent."""
    number = f"(price * {position + 1} % 9999999999)"
    exact = (
        f"named_struct('code', '{prefix}', 'displayName', upper('{prefix}'), "
        f"'fullName', concat('name of ', '{prefix}'), "
        f"'concentration', named_struct('value', p{position}, 'units', 'PARTS_PER_BILLION'))"
    )
    head = f'{{"code":"{prefix}","displayName":"{prefix.upper()}","fullName":"name of {prefix}","concentration":{{"value":'
    return (
        f"CASE WHEN {number} >= 10 THEN concat('{head}', {number} DIV 10000000, '.', "
        f"lpad(CAST({number} % 10000000 AS STRING), 7, '0'), ',\"units\":\"PARTS_PER_BILLION\"}}}}') "
        f"ELSE to_json({exact}) END"
    )


def _blocks_json() -> str:
    # Each block by itself keeps structs of different types in one array
    return (
        f"concat('[', {_block(0)}, CASE WHEN {NO_BR_BLOCK} THEN '' "
        f"ELSE concat(',', {_block(1)}) END, ']')"
    )


def _pollutants_json() -> str:
    items = [_pollutant(i, p) for i, p in enumerate(model.POLLUTANTS)]
    items[1] = f"CASE WHEN {NO_SECOND_POLLUTANT} THEN NULL ELSE {items[1]} END"
    return f"concat('[', concat_ws(',', {', '.join(items)}), ']')"


_STAMP_TEXT = (
    "concat(replace(CAST(l_shipdate AS STRING), ' ', 'T'), "
    "CASE WHEN l_linenumber % 2 = 0 THEN 'Z' ELSE '-03:00' END)"
)


def air_bronze(rows: DataFrame) -> DataFrame:
    """Measurements as bronze documents with the line item's key columns."""
    document = (
        f"concat('{{\"', place, '\":{{\"datetime\":\"', {_STAMP_TEXT}, '\",\"indexes\":', "
        f"{_blocks_json()}, ',\"pollutants\":', {_pollutants_json()}, '}}}}')"
    )
    return rows.selectExpr(*MEASURE_KEYS, f"{document} AS data")


def air_responses(rows: DataFrame) -> DataFrame:
    """Measurements as API responses. Odd parts: no ``indexes`` on even line
    numbers, a null ``dateTime`` on line number 3."""
    body = (
        "concat('{\"regionCode\":\"br\",\"dateTime\":', "
        f"CASE WHEN l_linenumber = 3 THEN 'null' ELSE concat('\"', {_STAMP_TEXT}, '\"') END, "
        f"CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE concat(',\"indexes\":', {_blocks_json()}) END, "
        f"',\"pollutants\":', {_pollutants_json()}, '}}')"
    )
    return rows.selectExpr(*MEASURE_KEYS, "place AS nome", "200 AS status", f"{body} AS body")


def _pollutant_columns_sql() -> str:
    """By position: a missing second pollutant moves all later ones forward."""
    out = []
    for i, prefix in enumerate(model.POLLUTANTS):
        def shifted(here: str, later: str | None) -> str:
            if i == 0:
                return here
            return f"CASE WHEN {NO_SECOND_POLLUTANT} THEN {later or 'NULL'} ELSE {here} END"

        later = model.POLLUTANTS[i + 1] if i + 1 < len(model.POLLUTANTS) else None
        text = {
            "code": "'{0}'", "nome": "'name of {0}'", "display_nome": "upper('{0}')",
            "concentracao_unidade": "'PARTS_PER_BILLION'",
        }
        for column, form in text.items():
            out.append(
                f"{shifted(form.format(prefix), later and form.format(later))} AS {prefix}_{column}"
            )
        here = f"CAST(p{i} AS DECIMAL(10,6))"
        then = f"CAST(p{i + 1} AS DECIMAL(10,6))" if later else None
        out.append(f"{shifted(here, then)} AS {prefix}_valor")
    return ", ".join(out)


UNIVERSAL_COLUMNS_SQL = """
  quantity AS aqi_universal, 'uaqi' AS codigo_universal,
  CAST(discount AS DECIMAL(9,8)) AS cor_vermelho_universal,
  CAST(0.12345678 AS DECIMAL(9,8)) AS cor_azul_universal,
  CAST(tax AS DECIMAL(9,8)) AS cor_verde_universal,
  l_returnflag AS categoria_universal, quantity AS valor_display_universal,
  'Universal AQI' AS nome_display_universal,
  lower(l_linestatus) AS poluente_dominante_universal"""

BR_COLUMNS_SQL = ", ".join(
    f"CASE WHEN {NO_BR_BLOCK} THEN NULL ELSE {expr} END AS {column}"
    for column, expr in {
        "aqi_br": "l_linenumber",
        "codigo_br": "'bra_saopaulo'",
        "cor_br": "CAST(br_green AS DECIMAL(2,1))",
        "categoria_br": "l_linestatus",
        "valor_display_br": "l_linenumber",
        "nome_display_br": "'AQI (BR)'",
        "poluente_dominante_br": "'pm25'",
    }.items()
)
POLLUTANT_COLUMNS_SQL = _pollutant_columns_sql()

# --- users and change requests --------------------------------------------------

USERS_SQL = """
users AS (
  SELECT 'u' || c_custkey AS id, c_name AS name,
         'customer' || c_custkey || '@example.com' AS email, md5(c_name) AS password,
         CASE WHEN c_acctbal >= 5000 THEN 'active' WHEN c_acctbal >= 0 THEN 'inactive' END
           AS signatureStatus,
         '5591' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone_number,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'admin' WHEN 'MACHINERY' THEN NULL ELSE 'user' END
           AS role,
         CASE WHEN c_nationkey % 5 = 0 THEN NULL WHEN c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END
           AS notifications,
         TIMESTAMP '2025-01-01 00:00:00' + to_seconds(c_custkey) AS created_at,
         CAST(NULL AS TIMESTAMP) AS updated_at
  FROM customer
)"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "concat('u', c_custkey) AS id",
        "c_name AS name",
        "concat('customer', c_custkey, '@example.com') AS email",
        "md5(c_name) AS password",
        "CASE WHEN c_acctbal >= 5000 THEN 'active' WHEN c_acctbal >= 0 THEN 'inactive' END "
        "AS signatureStatus",
        "concat('5591', lpad(c_custkey, 9, '0')) AS phone_number",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'admin' WHEN 'MACHINERY' THEN NULL ELSE 'user' END "
        "AS role",
        "CASE WHEN c_nationkey % 5 = 0 THEN NULL WHEN c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END "
        "AS notifications",
        "TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey) AS created_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at",
    )


# A third of all requests is for one e-mail; some e-mails are unknown.
_CUSTOMER = (
    "CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 11 = 0 THEN o_custkey + 1000000 "
    "ELSE o_custkey END"
)
_NAME = "o_orderstatus = 'O'"
_STATUS = "substr(o_orderpriority, 1, 1) IN ('1', '2')"
_NOTIFY = "substr(o_orderpriority, 1, 1) = '3'"

REQUESTS_SQL = f"""
requests AS (
  SELECT o_orderkey AS ordinal, 'customer' || ({_CUSTOMER}) || '@example.com' AS email,
         {_NAME} AS sets_name, 'renamed ' || o_orderkey % 3 AS name,
         {_STATUS} AS sets_status,
         CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'active' END AS status,
         {_NOTIFY} AS sets_notifications, 'yes' AS notifications
  FROM orders
)"""


def requests(spark: SparkSession, sf: str, op: str = "update") -> DataFrame:
    changes = (
        "map_from_entries(array_compact(array("
        f"CASE WHEN {_NAME} THEN named_struct('k', 'name', 'v', concat('renamed ', o_orderkey % 3)) END, "
        f"CASE WHEN {_STATUS} THEN named_struct('k', 'signatureStatus', 'v', "
        "CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'active' END) END, "
        f"CASE WHEN {_NOTIFY} THEN named_struct('k', 'notifications', 'v', 'yes') END)))"
    )
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS ordinal", f"'{op}' AS op",
        f"concat('customer', {_CUSTOMER}, '@example.com') AS email",
        f"{changes} AS changes",
    )


def insert_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Complete user rows as inserts; many repeat an e-mail of the table."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS ordinal", "'insert' AS op",
        f"concat('customer', {_CUSTOMER}, '@example.com') AS email",
        "map('name', concat('order ', o_orderkey), 'phone_number', '559100000000', "
        "'password', md5(CAST(o_orderkey AS STRING)), 'role', 'user', "
        "'signatureStatus', CAST(NULL AS STRING), 'notifications', 'no') AS changes",
    )


NOW = "2025-06-01 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")
