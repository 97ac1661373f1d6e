import math
from collections import Counter

import numpy as np
import pytest

from aerolake.llm import whitening
from aerolake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(rows):
    """The contract in plain numpy; signs are the sign of a component's largest entry."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in xs}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = ((fit * n - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    out = {}
    for i, x in xs:
        u = np.array(x, object) * n - sums
        w = (u / n).astype(float) @ vectors / np.sqrt(values)
        for c in range(len(values)):
            out.setdefault((i, c + 1), []).append((n, int((u * u).sum()), w[c], values[c] / np.trace(cov)))
    return out


def check(df, rows):
    assert df.columns == COLUMNS
    got = df.collect()
    want = brute(rows)
    assert Counter((r.vec_id, r.component) for r in got) == Counter({k: len(v) for k, v in want.items()})
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, deviation, w, explained = next(x for x in want[r.vec_id, r.component] if x[1] == r.deviation)
        sign = signs.setdefault(r.component, 1 if r.whitened * w >= 0 else -1)
        assert r.n == n and abs(sign * r.whitened - w) < 1e-7 * max(1, abs(w)), r
        assert abs(r.explained - explained) <= 1e-14 + 1e-10 * explained
        assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(QUERIES["op12_whiten_embeddings"](spark, SF), [tuple(r) for r in rows])


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(c) for c in rng.standard_normal(5) * [3, 1, 0.5, 2, 7]]) for i in range(40)]
    rows = good + [good[3], good[3], (3, good[4][1]), (None, good[5][1]), (50, [0.0] * 5), (51, [20.0] * 5), (2**60 + 1, [0.25] * 5)]
    bad = [(60, None), (61, []), (62, [1.0, None, 1.0, 1.0, 1.0]), (63, [math.nan] * 5), (64, [math.inf] + [0.0] * 4), (65, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows + bad], "vec_id long, embedding array<float>, n string, whitened double")
    rows = [(i, None if v is None else [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    check(whitening.whiten(df), rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert got.columns == COLUMNS and got.collect() == []


def test_directions_without_spread(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_very_large_entries(spark):
    rows = [(i, [1e15 + i * 1e12, -float(i * i) * 1e12]) for i in range(20)] + [(99, [1e300, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    collected = got.collect()
    assert 99 not in {r.vec_id for r in collected} and {r.deviation for r in collected} == {None}
    want = brute(rows[:-1])
    assert all(abs(abs(r.whitened) - abs(want[r.vec_id, r.component][0][2])) < 1e-6 for r in collected)


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [1e6, 1, 1e-3, 1e-6], [2, 2, 2, 1, 1], [3, 3, 3, 3], [1, 0, 0, 0], [0, 0], [1 + 1e-9, 1, 1 - 1e-9, 0.5],
    list(np.geomspace(1, 1e-12, 24)), list(np.linspace(1, 2, 64)), [4, 2, 0],
])
def test_spectrum(values):
    m = len(values)
    q = np.linalg.qr(np.random.default_rng(m).standard_normal((m, m)))[0]
    a = (q * np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    got, vectors = whitening.leading(a, 16)
    want = np.linalg.eigh(a)[0][::-1]
    want = want[want > m * whitening.EPS * np.linalg.norm(a)][:16]
    assert len(got) == len(want) and np.abs(got - want).max(initial=0) <= 1e-13 * m * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max(initial=0) < 1e-13 * m
    assert np.abs(a @ vectors - vectors * got).max(initial=0) <= 1e-13 * m * max(values)


def test_polar_factor_is_the_matrix_sign():
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((30, 30)))[0]
    values = np.concatenate([np.geomspace(1e-13, 1e3, 15), -np.geomspace(1e-13, 1e3, 15)])
    sign = whitening.polar_factor((q * values) @ q.T)
    assert np.abs(sign @ sign - np.eye(30)).max() < 1e-12
    assert np.abs(np.linalg.eigvalsh(sign) - np.sort(np.sign(values))).max() < 1e-12
