"""The hourly jobs. A scheduler outside calls them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators import reshape
from aerolake.operators.silver import silver_air_quality, silver_weather
from aerolake.plans import tables
from aerolake.session import shared_folder
from aerolake.sources import places as place_source
from aerolake.sources.api import Fetcher, fan_out


def landed(spark: SparkSession, responses: DataFrame, purpose: str) -> DataFrame:
    """Responses written once, so that no later step calls an API again."""
    folder = shared_folder(spark, purpose)
    responses.write.parquet(folder)
    return spark.read.parquet(folder)


def weather_documents(responses: DataFrame) -> DataFrame:
    """Responses (with ``ordinal``) to bronze rows, the last one per place."""
    flat = reshape.weather_flatten(reshape.tag_response(responses).drop("status"))
    documents = reshape.weather_document(flat)
    return reshape.wrap_documents(reshape.latest_per_place(documents, "nome", "ordinal"))


def air_quality_documents(responses: DataFrame) -> DataFrame:
    tagged = reshape.tag_response(responses).drop("latitude", "longitude", "status")
    documents = reshape.air_quality_reshape(tagged)
    return reshape.wrap_documents(reshape.latest_per_place(documents, "nome", "ordinal"))


def air_quality_etl(spark: SparkSession, places: DataFrame, weather_fetcher: Fetcher,
                    air_fetcher: Fetcher, prefix: str = "", parallelism: int | None = None,
                    run: str | None = None) -> bool:
    """Places to bronze and silver, weather first. ``places`` carries ``ordinal``: of two
    places with one name the later counts. A failed air-quality response stops the
    job before anything is written; a document that silver refuses reaches neither
    table and is kept, with its problems, beside bronze. All outputs become visible by one
    commit of the name ``run`` (the scheduler's hour); a run that is started again after its
    commit only finishes it. False when there was nothing left to do."""
    home = prefix + tables.WEATHER_BRONZE
    if run is not None and tables.landed_before(spark, home, run):
        return False
    numbered = places.select("nome", "latitude", "longitude", "ordinal")

    def responses(build, fetcher, purpose):
        return landed(spark, fan_out(build(numbered), fetcher, parallelism), purpose)

    weather = responses(place_source.weather_requests, weather_fetcher, "weather-responses")
    air = responses(place_source.air_quality_requests, air_fetcher, "air-responses")
    air = reshape.ok_responses(air, mode="strict")
    ready = [
        (tables.bronze_rows(spark, documents, prefix + bronze, ("ordinal",)), build, prefix + bronze, prefix + filled)
        for documents, build, bronze, filled in (
            (weather_documents(weather), silver_weather, tables.WEATHER_BRONZE, tables.WEATHER_SILVER),
            (air_quality_documents(air), silver_air_quality, tables.AIR_BRONZE, tables.AIR_SILVER),
        )
    ]
    outputs = [o for rows, build, bronze, filled in ready for o in tables.pair_outputs(spark, rows, build, bronze, filled)]
    return tables.land(spark, outputs, home, run)


def prediction_etl(spark: SparkSession, cities: DataFrame, fetcher: Fetcher) -> DataFrame:
    """City weather with its time as local text; there is no sink."""
    responses = landed(spark, fan_out(place_source.city_requests(cities), fetcher), "city")
    return reshape.city_local_time(reshape.ok_responses(responses, mode="strict")).select(
        "q", F.col("body"), "dt"
    )
