"""The normalised form of silver: a row per measurement and pollutant, places by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators.numbering import surrogate_id
from aerolake.operators.skew import lookup_join

# Columns of the long form and what follows the pollutant's prefix in silver.
MEASURED = {"code": "code", "name": "nome", "display_name": "display_nome", "metric_unit": "concentracao_unidade",
            "concentration": "valor"}
PLACES = "place_id long, name string"
# A broadcast of so many short names stays below 100 MB. This picks a path, never a result.
FEW_PLACES = 500_000


def long_pollutants(silver: DataFrame, keep: tuple[str, ...] = ("regiao", "data_medicao")) -> DataFrame:
    """One row per silver row and pollutant that it has anything of: the ``keep`` columns,
    ``position`` (from 0) and the columns of ``MEASURED``. No shuffle."""
    parts = F.array(*[
        F.struct(F.lit(i).alias("position"), *[F.col(f"{p}_{old}").alias(new) for new, old in MEASURED.items()])
        for i, p in enumerate(model.POLLUTANTS)
    ])
    some = F.filter(parts, lambda p: F.coalesce(*[p[c].cast("string") for c in MEASURED]).isNotNull())
    return silver.select(*keep, F.inline(some))


def extend_places(places: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """``places`` (``place_id``, unique ``name``) and the names that are new, with keys that go on
    behind the largest, in the order of the names.

    A place that has a key keeps it, so a second run over the same names adds nothing. Names are
    reduced to distinct ones before they move; null is no place. One writer at a time.
    """
    fresh = names.select(F.col(name).alias("name")).filter("name IS NOT NULL").distinct().join(places, "name", "left_anti")
    last = places.agg(F.max("place_id")).first()[0] or 0
    numbered = surrogate_id(fresh, ("name",), last, "place_id")
    return places.select("place_id", "name").unionByName(numbered.select("place_id", "name"))


def with_place_keys(rows: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``place_id`` in place of the name (null where the place has none).

    Up to ``FEW_PLACES`` places are broadcast, so no row moves and the rows are computed once; with
    more, a place with very many rows is spread."""
    found = places.select("place_id", F.col("name").alias(name))
    few = places.count() <= FEW_PLACES
    met = rows.join(F.broadcast(found), name, "left") if few else lookup_join(rows, found, name, "left")
    return met.select("place_id", *[c for c in rows.columns if c != name])
