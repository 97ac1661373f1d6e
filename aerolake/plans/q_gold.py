"""Queries: the normalised form of silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import gold, silver
from aerolake.plans import bindings as b
from aerolake.plans.registry import query

_KEYS = ", ".join(b.MEASURE_KEYS)
_PLACES_SQL = """
first_places AS (SELECT name, row_number() OVER (ORDER BY name) AS place_id FROM (
  SELECT DISTINCT place AS name FROM measures WHERE l_orderkey <= (SELECT max(l_orderkey) // 2000 FROM measures))),
places AS (
  SELECT place_id, name FROM first_places
  UNION ALL
  SELECT (SELECT max(place_id) FROM first_places) + row_number() OVER (ORDER BY name), name FROM (
    SELECT DISTINCT place AS name FROM measures WHERE place NOT IN (SELECT name FROM first_places)))"""
_LONG_SQL = " UNION ALL ".join(
    f"SELECT {_KEYS}, regiao, data_medicao, {i} AS position, "
    + ", ".join(f"{p}_{old} AS {new}" for new, old in gold.MEASURED.items())
    + f" FROM silver WHERE {p}_code IS NOT NULL OR {p}_nome IS NOT NULL OR {p}_display_nome IS NOT NULL "
    f"OR {p}_concentracao_unidade IS NOT NULL OR {p}_valor IS NOT NULL"
    for i, p in enumerate(model.POLLUTANTS))


def _silver(spark, sf):
    return silver.silver_air_quality(b.air_bronze(b.measures(spark, sf)), b.MEASURE_KEYS)


def _places(spark, sf):
    """Keys in two runs: the places of the first orders, then all."""
    rows = b.measures(spark, sf).select("l_orderkey", F.col("place").alias("regiao"))
    early = (rows.agg(F.max("l_orderkey")).first()[0] or 0) // 2000
    places = gold.extend_places(spark.createDataFrame([], gold.PLACES), rows.filter(F.col("l_orderkey") <= early), "regiao")
    return gold.extend_places(places, rows, "regiao")


@query("gold_places", f"WITH {b.MEASURES_SQL}, {_PLACES_SQL} SELECT place_id, name FROM places")
def gold_places(spark, sf):
    return _places(spark, sf)


@query("gold_pollutants", f"""
WITH {b.MEASURES_SQL}, {_PLACES_SQL},
silver AS (SELECT {_KEYS}, l_shipdate AS data_medicao, place AS regiao, {b.POLLUTANT_COLUMNS_SQL} FROM measures),
long AS ({_LONG_SQL})
SELECT p.place_id, long.* EXCLUDE (regiao) FROM long LEFT JOIN places p ON p.name = long.regiao""")
def gold_pollutants(spark, sf):
    keyed = gold.with_place_keys(_silver(spark, sf), _places(spark, sf), "regiao")  # once a document, not once a pollutant
    return gold.long_pollutants(keyed, ("place_id", *b.MEASURE_KEYS, "data_medicao"))
