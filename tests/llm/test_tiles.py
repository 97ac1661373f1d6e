import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import tiles

SCHEMA = "vec_id long, embedding array<float>, label int, row string, part string, near string, size string"


def brute(rows, asks, k):
    fine = {(i, tuple(v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in fine:
        if asks(q):
            near = []
            for i, w in fine:
                if i != q and len(w) == len(v):
                    total = 0.0
                    for a, b in zip(v, w):
                        total += (b - a) * (b - a)
                    near.append((math.sqrt(total), i))
            out += [(q, n, i, s) for n, (s, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def rows(seed=0):
    rng = np.random.default_rng(seed)
    out = [(i, np.float32(rng.normal(size=8)).tolist()) for i in range(150)]
    out += [(i, [1.0] * 8) for i in range(200, 260)]  # a vector that many rows share
    out += [(i, [1.0, 0.5]) for i in range(300, 303)] + [(400, np.float32(1e30 * rng.normal(size=8)).tolist())]
    out += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] * 4), (504, [float("nan")] * 8),
            (505, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (0, out[0][1]), (20, out[21][1])]
    return out


@pytest.mark.parametrize("query_block, candidate_block, k", [(512, 8192, 10), (3, 20, 10), (4, 2, 3)])
def test_matches_all_distances(spark, query_block, candidate_block, k):
    data = rows()
    df = spark.createDataFrame([r + (1, "a", "b", "c", "d") for r in data], SCHEMA)
    got = tiles.nearest(df, F.col("vec_id") % 10 == 0, k, query_block, candidate_block)
    assert sorted(map(tuple, got.collect())) == brute(data, lambda q: q % 10 == 0, k)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, c = rng.normal(size=(20, 1500)), rng.normal(size=(30, 1500)) * 10.0 ** rng.integers(-3, 3, (30, 1))
    low, high = tiles.bounds(q, c)
    true = ((q[:, None] - c[None]) ** 2).sum(2)
    assert (low <= true).all() and (true <= high).all() and ((high - low) < 0.2 * true + 1).all()
    a, b = tiles.quantise(q)[0], tiles.quantise(c)[0]
    assert (tiles.int8_product(a, b) == a.astype(int) @ b.astype(int).T).all()


def test_few_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tiles.nearest(none, F.col("vec_id") % 10 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0], 1, "a", "b", "c", "d")], SCHEMA)
    assert tiles.nearest(one, F.col("vec_id") % 10 == 0).collect() == []
    two = one.unionByName(spark.createDataFrame([(7, [1.0, 4.0], 1, "a", "b", "c", "d")], SCHEMA))
    assert [tuple(r) for r in tiles.nearest(two, F.col("vec_id") % 10 == 0).collect()] == [(0, 1, 7, 2.0)]
