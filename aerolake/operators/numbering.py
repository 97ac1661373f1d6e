"""Growing ids without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from aerolake.session import shared_folder

_TASK_BITS = 33  # monotonically_increasing_id: task number above, row number below


def surrogate_id(df: DataFrame, order_by: tuple[str, ...] = (), start: int = 0,
                 id_column: str = "id") -> DataFrame:
    """Ids ``start+1 .. start+n``, in ``order_by`` order when given.

    The rows are written once to the shared folder with their (task, row)
    position. A position that is stored cannot change between the pass that
    counts rows per task and the pass that numbers them, also when an executor
    is lost in between. Only the per-task counts (one row per task) meet in one
    task; they are broadcast back and added, so the rows need no window and no
    second shuffle.

    Ordering is a range partitioning. Ties are broken by the row's content and
    then by the task it came from, so equal keys and even equal rows spread over
    many partitions. Both stay the same when a task is rerun; a row counter there
    would not, once the rows come from another shuffle in another order.
    """
    spark = df.sparkSession
    placed = df
    if order_by:
        content = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
        keys = [*order_by, "_content", "_from"]
        placed = (
            df.withColumn("_content", F.xxhash64(*content))
            .withColumn("_from", F.spark_partition_id())
            .repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .drop("_content", "_from")
        )
    folder = shared_folder(spark, "numbered")
    placed.withColumn("_slot", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder)

    task, row = position(F.col("_slot"))
    offsets = task_offsets(stored.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows")))
    return (
        stored.withColumn("_task", task)
        .join(F.broadcast(offsets.drop("_rows")), "_task")
        .select((F.lit(start + 1) + F.col("_before") + row).alias(id_column), *df.columns)
    )


def position(slot: Column) -> tuple[Column, Column]:
    """The task, and the row in it, of a ``monotonically_increasing_id``."""
    return F.shiftright(slot, _TASK_BITS), slot.bitwiseAND(F.lit((1 << _TASK_BITS) - 1))


def task_offsets(counts: DataFrame) -> DataFrame:
    """``_task, _before, _rows`` from ``_task, _rows``: the rows of all tasks before."""
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), "_rows")


def are_gapless(stored: DataFrame, id_column: str, first: int, last: int) -> bool:
    """Whether the ids in stored files are ``first .. last``, each once, given that the ids of a file grow
    by one from row to row or are missing. Only one row per file meets in one task."""
    ids = F.col(id_column)
    files = stored.groupBy(F.input_file_name().alias("_file")).agg(
        F.min(ids).alias("low"), F.max(ids).alias("high"), F.count("*").alias("n"), F.count(ids).alias("ids"))
    files = files.withColumn("_ended", F.lag("high", 1, first - 1).over(Window.orderBy("low", "high")))
    fits = (F.col("n") == F.col("ids")) & (F.col("low") == F.col("_ended") + 1) & (F.col("high") - F.col("low") + 1 == F.col("n"))
    seen = files.agg(F.min(F.coalesce(fits, F.lit(False))).alias("fit"), F.max("high").alias("last")).first()
    return bool(seen["fit"]) and seen["last"] == last if seen["last"] is not None else first > last and seen["fit"] is None
