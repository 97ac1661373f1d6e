"""Places and the request rows built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# End points and constant request members.
WEATHER_URL = "https://api.openweathermap.org/data/2.5/weather"
AIR_QUALITY_URL = "https://airquality.googleapis.com/v1/currentConditions:lookup"
EXTRA_COMPUTATIONS = ("DOMINANT_POLLUTANT_CONCENTRATION", "POLLUTANT_CONCENTRATION", "LOCAL_AQI")
UNITS = "metric"
AIR_LANGUAGE = "pt-br"
CITY_LANGUAGE = "pt_br"


def places_from_map(df: DataFrame, column: str = "places") -> DataFrame:
    """``{place: [lat, lon]}`` text to ``nome, latitude, longitude``.

    A pair with fewer than two numbers is an error; more numbers are ignored.
    """
    entries = F.map_entries(F.from_json(F.col(column), "map<string,array<double>>"))
    rows = df.select(F.inline(entries))
    pair = F.when(F.size("value") >= 2, F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("no coordinate pair for "), F.col("key")))
    )
    return rows.select(F.col("key").alias("nome"), pair.alias("pair")).select(
        "nome",
        F.get("pair", F.lit(0)).alias("latitude"),
        F.get("pair", F.lit(1)).alias("longitude"),
    )


def plain_number(number: Column) -> Column:
    """A coordinate as plain decimal text, never in exponent form.

    The dot is set by hand: how a decimal with a scale turns to text depends on
    the session (``0E-18``), a whole number has one form.
    """
    places = 18
    scaled = (number.cast(f"decimal(28,{places})") * F.lit(10**places).cast("decimal(19,0)")).cast(
        "decimal(38,0)"
    )
    digits = F.abs(scaled).cast("string")
    digits = F.lpad(digits, F.greatest(F.char_length(digits), F.lit(places + 1)), F.lit("0"))
    whole = F.substr(digits, F.lit(1), F.char_length(digits) - places)
    fraction = F.regexp_replace(F.right(digits, F.lit(places)), r"(\d)0+$", "$1")
    return F.concat(F.when(scaled < 0, "-").otherwise(""), whole, F.lit("."), fraction)


def weather_requests(places: DataFrame) -> DataFrame:
    """One query-string request per place. The API key is no column: the
    fetcher adds it where the call is made."""
    return places.select(
        "*",
        F.lit("GET").alias("method"),
        F.lit(WEATHER_URL).alias("url"),
        plain_number(F.col("latitude")).alias("lat"),
        plain_number(F.col("longitude")).alias("lon"),
        F.lit(UNITS).alias("units"),
    )


def air_quality_requests(places: DataFrame) -> DataFrame:
    """One JSON-body request per place."""
    body = F.to_json(
        F.struct(
            F.lit(True).alias("universalAqi"),
            F.struct("latitude", "longitude").alias("location"),
            F.array(*[F.lit(c) for c in EXTRA_COMPUTATIONS]).alias("extraComputations"),
            F.lit(AIR_LANGUAGE).alias("languageCode"),
        )
    )
    return places.select(
        "*",
        F.lit("POST").alias("method"),
        F.lit(AIR_QUALITY_URL).alias("url"),
        body.alias("body"),
    )


def city_requests(cities: DataFrame, column: str = "city") -> DataFrame:
    """One query-string request per city name."""
    return cities.select(
        F.col(column).alias("q"),
        F.lit("GET").alias("method"),
        F.lit(WEATHER_URL).alias("url"),
        F.lit(UNITS).alias("units"),
        F.lit(CITY_LANGUAGE).alias("lang"),
    )


# Request members that travel in the query string.
QUERY_MEMBERS = ("lat", "lon", "q", "units", "lang")


def call_columns(requests: DataFrame) -> DataFrame:
    """Any request rows as ``tag`` (columns to hand through), ``method``, ``url``,
    ``params`` (query members) and ``payload`` (JSON body)."""
    query = [c for c in QUERY_MEMBERS if c in requests.columns]
    tags = [c for c in requests.columns if c not in ("method", "url", "body", *query)]
    params = (
        F.create_map(*[x for c in query for x in (F.lit(c), F.col(c))])
        if query else F.lit(None).cast("map<string,string>")
    )
    payload = F.col("body") if "body" in requests.columns else F.lit(None).cast("string")
    if "q" in query:
        tags = [*tags, "q"]
    return requests.select(
        *tags, "method", "url", params.alias("params"), payload.alias("payload")
    )
