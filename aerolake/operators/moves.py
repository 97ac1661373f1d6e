"""Which moves of users between addresses succeed.

A move takes its user from one address to another if there is one and the other address
is free. Let ``a`` and ``b`` say whether the two addresses are taken before it. After it the
first is taken if ``a and b`` (nothing moved), the second if ``a or b``: so what an address
holds before its next move is a gate over the two inputs of its last one. A gate with one
known input is a constant or a plain copy of the other input, and copies of copies are
followed with doubled distance every round. So moves that wait for each other in a chain
of n links are settled after log2(n) rounds; only a gate whose two inputs are both still
open costs a round of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.session import shared_folder

# What is known of a wire: its value, that it equals the wire x, or the gate over x and y.
VALUE, COPY, BOTH, EITHER = 0, 1, 2, 3
FROM, TO = 0, 1


def wire(ordinal: Column, side: int | Column) -> Column:
    """The number of a move's input at the address it leaves (``FROM``) or wants (``TO``)."""
    return ordinal * 2 + side


def first_wires(inputs: DataFrame) -> DataFrame:
    """``id, kind, x, y`` of inputs ``ordinal, side, taken, last``: ``last`` is the wire number
    of the slot's last event before, NULL at the first, where ``taken`` (boolean) is known."""
    before = F.floor(F.col("last") / 2).cast("long")
    kind = F.when(F.col("last").isNull(), VALUE).when(F.col("last") % 2 == FROM, BOTH).otherwise(EITHER)
    return inputs.select(
        wire(F.col("ordinal"), F.col("side")).cast("long").alias("id"), kind.alias("kind"),
        F.coalesce(wire(before, FROM), F.col("taken").cast("long")).alias("x"), wire(before, TO).alias("y"))


def _simplified(wires: DataFrame) -> DataFrame:
    """One round: every open wire by what is known of its inputs.

    A copy of a known value counts as that value here, so whatever a copy leads to is open
    and is a row of the result: no wire is left that points to one settled earlier.
    """
    values = wires.filter(F.col("kind") == VALUE).select("id", "kind", "x")
    copies = (wires.filter(F.col("kind") == COPY).select("id", "x")
              .join(values.select(F.col("id").alias("x"), F.col("x").alias("is")), "x", "left")
              .select("id", F.when(F.col("is").isNull(), COPY).otherwise(VALUE).alias("kind"), F.coalesce("is", "x").alias("x")))
    known = values.unionByName(copies)
    seen = lambda c: known.select(F.col("id").alias(c), F.col("kind").alias(f"{c}_kind"), F.col("x").alias(f"{c}_is"))
    met = wires.filter(F.col("kind") != VALUE).join(seen("x"), "x", "left").join(seen("y"), "y", "left")
    value = lambda c: F.when(F.col(f"{c}_kind") == VALUE, F.col(f"{c}_is"))
    same = lambda c: F.when(F.col(f"{c}_kind") == COPY, F.col(f"{c}_is")).otherwise(F.col(c))
    # The value that decides a gate alone; the other one leaves the other input as it is.
    decides = F.when(F.col("kind") == BOTH, 0).otherwise(1)
    x, y = value("x"), value("y")
    gate = (
        F.when((x == decides) | (y == decides), F.struct(F.lit(VALUE).alias("kind"), decides.cast("long").alias("x")))
        .when(x.isNotNull() & y.isNotNull(), F.struct(F.lit(VALUE).alias("kind"), x.alias("x")))
        .when(x.isNotNull(), F.struct(F.lit(COPY).alias("kind"), same("y").alias("x")))
        .when(y.isNotNull() | (same("x") == same("y")), F.struct(F.lit(COPY).alias("kind"), same("x").alias("x")))
        .otherwise(F.struct(F.col("kind").alias("kind"), same("x").alias("x"))))
    copy = F.struct(F.coalesce(F.when(x.isNotNull(), VALUE), F.lit(COPY)).alias("kind"), F.coalesce(x, same("x")).alias("x"))
    found = met.select("id", F.when(F.col("kind") == COPY, copy).otherwise(gate).alias("now"), same("y").alias("y"))
    return found.select("id", "now.kind", "now.x", F.when(F.col("now.kind") > COPY, F.col("y")).alias("y"))


def settled(wires: DataFrame) -> tuple[DataFrame, int]:
    """(``id, value`` of every wire, the rounds it took).

    Each round reads only what the last one left open or settled, as a wire that was
    settled earlier has been put in place wherever it was an input.
    """
    spark = wires.sparkSession
    folder = shared_folder(spark, "wires")
    schema = "id long, kind int, x long, y long"
    rounds = 0
    while True:
        wires.write.parquet(f"{folder}/round={rounds}")
        wires = spark.read.schema(schema).parquet(f"{folder}/round={rounds}")
        if wires.filter(F.col("kind") != VALUE).isEmpty():
            break
        wires = _simplified(wires)
        rounds += 1
    values = spark.read.schema(schema).parquet(folder).filter(F.col("kind") == VALUE)
    return values.select("id", F.col("x").alias("value")), rounds


def verdicts(inputs: DataFrame) -> DataFrame:
    """``ordinal, succeeds`` of every move, from both its inputs (see ``first_wires``)."""
    values, _ = settled(first_wires(inputs))
    of = lambda side: F.max(F.when(F.col("id") % 2 == side, F.col("value")))
    return values.groupBy(F.floor(F.col("id") / 2).cast("long").alias("ordinal")).agg(
        ((of(FROM) == 1) & (of(TO) == 0)).alias("succeeds"))
