"""The registered queries: a callable each and, where SQL can say it, the same
in DuckDB's SQL on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolake.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf: run(tune(spark), sf)
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register
