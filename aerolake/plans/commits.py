"""Several tables filled by one switch, and blocks of ids for several writers.

A job writes all its outputs to folders that no reader sees, then puts down one commit
record that names them; only then are the files moved into place. A job that is killed
before the record leaves nothing behind that counts; one that is killed after it is
finished by whoever calls ``finish`` next, which every later commit does first. A commit has
the name of its run, so a run that is started again neither repeats nor loses anything.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WAIT_SECONDS = 30.0


class Folder:
    """A folder on any file system that Spark reads; names of files in it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = self._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path))

    def create(self, name: str, text: str) -> bool:
        """A new file with that text; False when there is one of that name already."""
        self.fs.mkdirs(self.path)
        uri = self.fs.makeQualified(self._at(name)).toUri()
        if uri.getScheme() == "file":  # Hadoop's local file system looks first and creates then
            try:
                handle = os.open(uri.getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "w") as out:
                out.write(text)
            return True
        try:
            out = self.fs.create(self._at(name), False)
        except Exception as error:
            if self.fs.exists(self._at(name)):
                return False
            raise error
        out.write(text.encode())
        out.close()
        return True

    def text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def move(self, name: str, to: "Folder", at: int | None = None) -> None:
        """Move a file; nothing happens when it was moved before. With ``at``, milliseconds, as one of that time."""
        to.fs.mkdirs(to.path)
        if at is not None:
            self.fs.setTimes(self._at(name), at, -1)
        if not self.fs.rename(self._at(name), to._at(name)) and not to.fs.exists(to._at(name)):
            raise OSError(f"{name} could not be moved from {self.path} to {to.path}")

    def delete(self, name: str = "") -> None:
        self.fs.delete(self._at(name) if name else self.path, True)


@dataclass
class Output:
    """Rows for a table (checked as on INSERT) or, without one, for plain files at ``folder``."""

    rows: DataFrame
    folder: str
    table: str | None = None


def _stage(spark: SparkSession, output: Output, staged: str) -> None:
    if output.table is None:
        output.rows.write.parquet(staged)
        return
    fresh = f"{output.table}_s_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {fresh} LIKE {output.table} USING parquet LOCATION '{staged}'")
    try:
        output.rows.select(*spark.table(output.table).columns).write.insertInto(fresh)
    finally:
        spark.sql(f"DROP TABLE {fresh}")


def commit(spark: SparkSession, home: str, run: str, outputs: list[Output]) -> bool:
    """Add all outputs or none. False when the run was committed before; it is then only
    finished. ``home`` is the folder that the commits of these tables share."""
    record = Folder(spark, f"{home}/_commits")
    finish(spark, home)
    if f"{run}.done" in record.names():
        return False
    attempt = uuid.uuid4().hex
    moves = []
    for i, output in enumerate(outputs):
        staged = f"{output.folder}/_staged/{attempt}-{i}"
        _stage(spark, output, staged)
        moves.append([staged, output.folder])
    first = record.create(f"{run}.commit", json.dumps(moves))
    if not first:  # another attempt of the run was faster
        for staged, _ in moves:
            Folder(spark, staged).delete()
    finish(spark, home)
    for output in outputs:
        if output.table:
            spark.catalog.refreshTable(output.table)
    return first


def finish(spark: SparkSession, home: str) -> list[str]:
    """Move what was committed and not moved yet; the runs that were open."""
    record = Folder(spark, f"{home}/_commits")
    names = record.names()
    open_ = [n.removesuffix(".commit") for n in names if n.endswith(".commit") and n.replace(".commit", ".done") not in names]
    for run in open_:
        for staged, target in json.loads(record.text(f"{run}.commit")):
            source = Folder(spark, staged)
            for name in source.names():
                if not name.startswith(("_", ".")):
                    source.move(name, Folder(spark, target))
            source.delete()
        record.create(f"{run}.done", "")
    return open_


def reserve_ids(spark: SparkSession, table: str, folder: str, count: int, column: str = "id") -> int:
    """The last id before a block of ``count`` ids that no other writer gets.

    Each block is a file that can be created once, named by its turn; it holds the block's
    last id. Ids that came into the table another way are passed too. As with a sequence, a
    job that fails after this leaves a gap.
    """
    blocks = Folder(spark, f"{folder}/_ids")
    while True:
        names = [n for n in blocks.names() if n.isdigit()]
        last, turn = 0, 0
        if names:
            last, turn = int(_written(blocks, names[-1])), int(names[-1]) + 1
        there = spark.table(table).agg(F.max(column)).head()[0] or 0
        start = max(last, there)
        if blocks.create(f"{turn:012d}", str(start + count)):
            return start


def _written(blocks: Folder, name: str) -> str:
    """The text of a file that another writer may be about to fill."""
    until = time.monotonic() + WAIT_SECONDS
    while not (text := blocks.text(name)):
        if time.monotonic() > until:
            raise PySparkException(f"{blocks.path}/{name} was never filled; delete it if its writer is gone")
        time.sleep(0.05)
    return text
