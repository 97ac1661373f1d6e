"""Moves against a loop, and the rounds that chains of them take."""

import math
import random

import pytest
from pyspark.sql import functions as F

from aerolake.operators import moves

INPUTS = "ordinal long, side int, taken boolean, last long"


def inputs(rows, start):
    """The two inputs of each move ``(ordinal, from, to)``; ``start``: addresses taken at first."""
    last, out = {}, []
    for ordinal, source, target in sorted(rows):
        for side, key in ((moves.FROM, source), (moves.TO, target)):
            before = last.get(key)
            out.append((ordinal, side, key in start if before is None else None, before))
        last[source], last[target] = ordinal * 2 + moves.FROM, ordinal * 2 + moves.TO
    return out


def loop(rows, start):
    taken, out = set(start), {}
    for ordinal, source, target in sorted(rows):
        out[ordinal] = source in taken and target not in taken
        if out[ordinal]:
            taken.remove(source)
            taken.add(target)
    return out


def found(spark, rows, start):
    df = spark.createDataFrame(inputs(rows, start), INPUTS).repartition(4)
    values, rounds = moves.settled(moves.first_wires(df))
    assert values.count() == 2 * len(rows) == values.select("id").distinct().count()
    return {r.ordinal: r.succeeds for r in moves.verdicts(df).collect()}, rounds


@pytest.mark.parametrize("n", [1, 2, 1500])
@pytest.mark.parametrize("first_taken", [False, True])
def test_a_chain_takes_log_rounds(spark, n, first_taken):
    """Everyone wants the address of the next one, who moves (or fails to) just before."""
    rows = [(3 * i, f"s{i + 1}", f"s{i}") for i in range(n)]
    start = {f"s{i}" for i in range(0 if first_taken else 1, n + 1)}
    got, rounds = found(spark, rows, start)
    assert got == loop(rows, start)
    assert set(got.values()) == {not first_taken}
    assert rounds <= math.ceil(math.log2(n + 1)) + 1


@pytest.mark.parametrize("seed,addresses,n,hot", [(1, 6, 30, 0.3), (2, 40, 100, 0.0), (4, 200, 400, 0.33)])
def test_random_moves(spark, seed, addresses, n, hot):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = 0 if rng.random() < hot else rng.randrange(addresses)
        target = rng.choice([a for a in range(addresses) if a != source])
        rows.append((i * 7 + 1, source, target))
    start = {a for a in range(addresses) if rng.random() < 0.6}
    got, rounds = found(spark, rows, start)
    assert got == loop(rows, start)
    assert rounds < n


def test_one_address_moves_back_and_forth(spark):
    """Two addresses only: both inputs of every move come from the move before."""
    rows = [(i, "ab"[i % 2], "ba"[i % 2]) for i in range(9)]
    for start in ({"a"}, {"a", "b"}):
        got, _ = found(spark, rows, start)
        assert got == loop(rows, start)


def test_no_moves(spark):
    assert moves.verdicts(spark.createDataFrame([], INPUTS)).collect() == []


def test_a_round_reads_only_what_is_open(spark):
    df = spark.createDataFrame(inputs([(i, f"s{i + 1}", f"s{i}") for i in range(8)], {"s3"}), INPUTS)
    wires = moves.first_wires(df)
    after = moves._simplified(wires)
    assert after.count() == wires.filter(F.col("kind") != moves.VALUE).count()
