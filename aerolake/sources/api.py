"""Calling the APIs from the executors.

``fan_out`` calls for every row of a DataFrame; ``api_source`` is the same as a
Python data source over landed request rows. Both take a *fetcher*: a function
``(method, url, params, payload) -> (status, body text)``; the status is None when
there was no answer. Tests inject a stub.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from aerolake.session import shared_folder
from aerolake.sources.places import call_columns

Fetcher = Callable[[str, str, dict, str], tuple[int, str]]


def _portable(fetcher: Fetcher) -> Fetcher:
    """Send this module's and the fetcher's functions to the workers by value, so
    that executors need no copy of either on their path."""
    for name in (__name__, getattr(fetcher, "__module__", None)):
        if name in sys.modules and name != "__main__":
            cloudpickle.register_pickle_by_value(sys.modules[name])
    return fetcher


def http_fetcher(key_variable: str, key_parameter: str, timeout: float = 30.0) -> Fetcher:
    """Real calls with the standard library. The API key is read from the named
    environment variable of the executor, so it never enters a DataFrame."""

    def fetch(method, url, params, payload):
        from http.client import HTTPException
        from urllib import error, parse, request

        query = {**(params or {}), key_parameter: os.environ[key_variable]}
        call = request.Request(
            f"{url}?{parse.urlencode(query)}",
            data=payload.encode() if payload else None,
            method=method,
            headers={"Content-Type": "application/json"},
        )
        try:
            with request.urlopen(call, timeout=timeout) as answer:
                return answer.status, answer.read().decode("utf-8")
        except error.HTTPError as failure:
            return failure.code, failure.read().decode("utf-8", "replace")
        except (OSError, ValueError, HTTPException) as failure:
            # No answer that could be read: a row without a status, not a lost task.
            return None, f"{type(failure).__name__}: {failure}"

    return fetch


CALL_COLUMNS = ("method", "url", "params", "payload")


def _responses(rows, fetcher: Fetcher):
    for row in rows:
        params = row["params"]
        status, body = fetcher(row["method"], row["url"], dict(params or {}), row["payload"])
        yield status, body


def _answered(batch, tags: list[str], fetcher: Fetcher):
    """A batch of requests with their answers."""
    import pyarrow as pa

    found = list(_responses(batch.select(list(CALL_COLUMNS)).to_pylist(), fetcher))
    return pa.RecordBatch.from_arrays(
        [*[batch.column(t) for t in tags], pa.array([s for s, _ in found], pa.int32()),
         pa.array([b for _, b in found], pa.string())],
        names=[*tags, "status", "body"],
    )


def _response_schema(calls: DataFrame) -> StructType:
    tags = [f for f in calls.schema.fields if f.name not in CALL_COLUMNS]
    return StructType([*tags, StructField("status", IntegerType()), StructField("body", StringType())])


def fan_out(requests: DataFrame, fetcher: Fetcher, parallelism: int | None = None) -> DataFrame:
    """One call per request row, spread over the cluster.

    ``parallelism`` tasks share the calls in equal numbers (round robin, so many
    requests of one place do not gather on one task). A lost task repeats its
    calls; land the result before using it twice.
    """
    _portable(fetcher)
    calls = call_columns(requests)
    if parallelism:
        calls = calls.repartition(parallelism)
    schema = _response_schema(calls)
    tags = [f.name for f in schema.fields[:-2]]

    def call_batches(batches) -> Iterator:
        for batch in batches:
            yield _answered(batch, tags, fetcher)

    return calls.mapInArrow(call_batches, schema)


@dataclass
class RequestFile(InputPartition):
    file: str


def api_source(name: str, fetcher: Fetcher) -> type[DataSource]:
    """A data source class reading API responses, one task per landed request
    file. Options: ``requests`` (the folder as a full URI) and ``columns``
    (schema JSON)."""

    class ApiReader(DataSourceReader):
        def __init__(self, schema, options):
            self.tags = [f.name for f in schema.fields[:-2]]
            self.folder = options["requests"]

        def partitions(self):
            import pyarrow.fs as pafs

            filesystem, base = pafs.FileSystem.from_uri(self.folder)
            found = filesystem.get_file_info(pafs.FileSelector(base))
            files = [f.path for f in found if f.path.endswith(".parquet")]
            return [RequestFile(f) for f in files] or [RequestFile("")]

        def read(self, partition):
            if not partition.file:
                return
            import pyarrow.fs as pafs
            import pyarrow.parquet as pq

            filesystem, _ = pafs.FileSystem.from_uri(self.folder)
            with filesystem.open_input_file(partition.file) as source:
                for batch in pq.ParquetFile(source).iter_batches():
                    yield _answered(batch, self.tags, fetcher)

    class ApiSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return StructType.fromJson(json.loads(self.options["columns"]))

        def reader(self, schema):
            return ApiReader(schema, self.options)

    return ApiSource


def _full_uri(spark: SparkSession, folder: str) -> str:
    """The folder as Spark resolves it: a bare path means the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") else uri


def read_api(spark: SparkSession, name: str, requests: DataFrame, fetcher: Fetcher,
             calls_per_task: int = 500) -> DataFrame:
    """Land request rows in the shared folder and read their responses. A landed
    file holds the calls of one task. (Workers open these files with pyarrow; on
    a file system it does not know, use ``fan_out``.)"""
    calls = call_columns(requests)
    folder = shared_folder(spark, f"requests-{name}")
    calls.write.option("maxRecordsPerFile", calls_per_task).parquet(folder)
    spark.dataSource.register(api_source(name, _portable(fetcher)))
    return (
        spark.read.format(name)
        .option("requests", _full_uri(spark, folder))
        .option("columns", _response_schema(calls).json())
        .load()
    )


def weather_source(spark, requests, fetcher, **options) -> DataFrame:
    """Current weather per place: ``nome, latitude, longitude, status, body``."""
    return read_api(spark, "place_weather", requests, fetcher, **options)


def air_quality_source(spark, requests, fetcher, **options) -> DataFrame:
    """Current air quality per place: ``nome, latitude, longitude, status, body``."""
    return read_api(spark, "place_air_quality", requests, fetcher, **options)


def city_weather_source(spark, requests, fetcher, **options) -> DataFrame:
    """Current weather per city name: ``q, status, body``."""
    return read_api(spark, "city_weather", requests, fetcher, **options)
