"""APIs polled once an hour as a stream.

The offset of the stream is the hour that was polled last. A start in an hour that is
done finds nothing new and calls nothing; a start in a later hour polls that hour, once
per request. Hours in which nothing ran are not caught up: the APIs answer with what is
current. Spark logs the offset before the calls and the batch after they are written, so
a batch that was lost on the way is polled again under its own hour, and its rows are
written once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from aerolake.sources.api import Fetcher, _answered, _full_uri, _portable, _response_schema
from aerolake.sources.places import call_columns
from aerolake.streaming.silver import install_once

HOUR = 3600
Clock = Callable[[], float]


@dataclass
class PolledFile(InputPartition):
    slot: int
    file: str


def polled_source(name: str, fetcher: Fetcher, clock: Clock = time.time, period: int = HOUR) -> type[DataSource]:
    """A streaming data source class: each period every landed request is called once, one
    task per request file. Options: ``requests`` (the folder as a full URI) and ``columns``
    (schema JSON). ``polled`` is the start of the period."""

    class Poller(DataSourceStreamReader):
        def __init__(self, schema, options):
            self.tags = [f.name for f in schema.fields[:-3]]
            self.folder = options["requests"]

        def _now(self) -> int:
            return int(clock() // period)

        def initialOffset(self) -> dict:
            return {"slot": self._now() - 1}

        def latestOffset(self) -> dict:
            return {"slot": self._now()}

        def partitions(self, start: dict, end: dict):
            import pyarrow.fs as pafs

            if end["slot"] <= start["slot"]:  # a clock that went back
                return []
            filesystem, base = pafs.FileSystem.from_uri(self.folder)
            found = filesystem.get_file_info(pafs.FileSelector(base))
            return [PolledFile(end["slot"], f.path) for f in found if f.path.endswith(".parquet")]

        def read(self, partition):
            import pyarrow as pa
            import pyarrow.fs as pafs
            import pyarrow.parquet as pq

            filesystem, _ = pafs.FileSystem.from_uri(self.folder)
            with filesystem.open_input_file(partition.file) as source:
                for batch in pq.ParquetFile(source).iter_batches():
                    answered = _answered(batch, self.tags, fetcher)
                    polled = pa.array([partition.slot * period * 1_000_000] * len(batch), pa.timestamp("us", "UTC"))
                    yield pa.RecordBatch.from_arrays([*answered.columns, polled], names=[*answered.schema.names, "polled"])

    class PolledSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return StructType.fromJson(json.loads(self.options["columns"]))

        def streamReader(self, schema):
            return Poller(schema, self.options)

    return PolledSource


def land_requests(requests: DataFrame, folder: str, calls_per_task: int = 500) -> StructType:
    """Write the requests that are to be polled, ``calls_per_task`` to a file; the columns of
    their answers. Writing them anew changes what the next poll calls."""
    calls = call_columns(requests)
    calls.write.mode("overwrite").option("maxRecordsPerFile", calls_per_task).parquet(folder)
    schema = _response_schema(calls)
    return StructType([*schema.fields, StructField("polled", TimestampType())])


def polled_responses(spark: SparkSession, name: str, folder: str, columns: StructType, fetcher: Fetcher,
                     clock: Clock = time.time, period: int = HOUR) -> DataFrame:
    """The answers as a streaming DataFrame: tags, ``status``, ``body`` and ``polled``."""
    _portable(fetcher)
    spark.dataSource.register(polled_source(name, fetcher, _portable(clock) if clock is not time.time else clock, period))
    return (spark.readStream.format(name).option("requests", _full_uri(spark, folder))
            .option("columns", columns.json()).load())


def poll(spark: SparkSession, name: str, folder: str, columns: StructType, fetcher: Fetcher, target: str,
         checkpoint: str, clock: Clock = time.time, period: int = HOUR, stay: bool = False) -> StreamingQuery:
    """Poll the hour if it was not polled yet, append the answers below ``target`` and stop; with
    ``stay`` go on with every hour to come."""

    def start() -> StreamingQuery:
        rows = polled_responses(spark, name, folder, columns, fetcher, clock, period)
        writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).outputMode("append").format("parquet")
        trigger = {"processingTime": f"{period} seconds"} if stay else {"availableNow": True}
        return writer.trigger(**trigger).start(target)

    return install_once(spark, name, start)
