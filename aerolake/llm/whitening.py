"""Embedding whitening by QDWH spectral divide and conquer.

Spark finds the distinct vectors and sums them up: counts and sums exactly, then the
covariance of the centred vectors, a partial matrix per task and added up as rows. What
the driver gets is one d x d matrix, whatever the number of vectors. There the polar
factor of the shifted matrix, found by dynamically weighted Halley steps, gives the
projectors onto the eigenvectors above and below the shift; the two invariant subspaces
are split again until each holds one eigenvalue. The components go to every task, which
whitens its rows with them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import query, staged, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
EPS = np.finfo(float).eps
LARGEST = 2.0 ** 62  # 64 * c beyond this is no whole number of 64 bits


class Model(NamedTuple):
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column each
    trace: float


# --- the matrix ---------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix: its eigenvalues become their signs.

    QR-based dynamically weighted Halley iteration; ``low`` bounds the least singular value
    of the scaled matrix from below, and six or seven steps take it to one.
    """
    m = len(a)
    x = a / np.linalg.norm(a)
    low, eye = EPS, np.eye(m)
    for _ in range(30):
        d = (4 * (1 - low ** 2) / low ** 4) ** (1 / 3)
        root = math.sqrt(1 + d)
        u = root + math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * root))) / 2
        v = (u - 1) ** 2 / 4
        w = u + v - 1
        q = np.linalg.qr(np.vstack([math.sqrt(w) * x, eye]))[0]
        new = v / w * x + (u - v / w) / math.sqrt(w) * q[:m] @ q[m:].T
        new = (new + new.T) / 2
        low = min(1.0, low * (u + v * low ** 2) / (1 + w * low ** 2))
        moved = np.linalg.norm(new - x)
        x = new
        if moved <= 1e-7 * math.sqrt(m) and 1 - low < 1e-12:  # cubic convergence: the next step changes nothing
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces of the eigenvalues above and below a shift; None
    where all eigenvalues are one to double precision."""
    m = len(a)
    middle = np.trace(a) / m
    spread = np.linalg.norm(a - middle * np.eye(m))
    if spread <= 4 * m * EPS * np.linalg.norm(a):
        return None
    # The mean always has eigenvalues on both sides. Should one lie on the shift itself, the
    # projector comes out between two ranks, and the shift is moved.
    for move in (0.0, 0.03, -0.03, 0.11, -0.11, 0.23, -0.23, 0.002, -0.002):
        projector = (polar_factor(a - (middle + move * spread / math.sqrt(m)) * np.eye(m)) + np.eye(m)) / 2
        k = round(np.trace(projector))
        if 0 < k < m and np.linalg.norm(projector @ projector - projector) <= 1e-10 * m:
            break
    else:
        return None
    some = projector @ np.random.default_rng(m).standard_normal((m, k))
    some = projector @ np.linalg.qr(some)[0]
    basis = np.linalg.qr(np.hstack([np.linalg.qr(some)[0], np.eye(m)]), mode="complete")[0][:, :m]
    return basis[:, :k], basis[:, k:]


def leading(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit eigenvectors; values
    that are zero to double precision are left out. Lower subspaces are not opened."""
    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    scale = np.linalg.norm(v)
    open_, vectors = [np.eye(len(v))], []
    while open_ and sum(b.shape[1] for b in vectors) < wanted and scale:
        basis = open_.pop()
        inner = basis.T @ v @ basis
        parts = split((inner + inner.T) / 2) if basis.shape[1] > 1 else None
        if parts is None:
            vectors.append(basis)
        else:
            upper, lower = parts
            open_ += [basis @ lower, basis @ upper]
    found = np.hstack(vectors) if vectors else np.zeros((len(v), 0))
    values = np.einsum("ij,ij->j", found, v @ found)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > len(v) * EPS * scale][:wanted]
    return values[order], found[:, order]


# --- the rows -----------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null, not empty, all entries finite and small enough for whole numbers of 64 bits."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: the usable vectors as whole numbers."""
    rows = vectors.filter(usable(F.col("embedding")))
    return rows.select("vec_id", F.transform(
        "embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET)).alias("x"))


def _small(x: np.ndarray, factor: int) -> bool:
    """Whether ``factor`` such numbers, or one times ``factor``, stay whole numbers of 64 bits."""
    return max(int(x.max()), -int(x.min())) * max(1, factor) < 1 << 62


def _stack(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exactly; Python's whole numbers where 64 bits might not do."""
    if _small(x, n) and max(map(abs, sums)) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def exact_sums(fit: DataFrame) -> list[int]:
    """The sum of each dimension. Tasks send a row per dimension."""

    def add(batches: Iterator[pa.RecordBatch]):
        totals = None
        for batch in batches:
            if batch.num_rows:
                x = _stack(batch)
                some = x.sum(0).tolist() if _small(x, len(x)) else x.astype(object).sum(0).tolist()
                totals = some if totals is None else [a + b for a, b in zip(totals, some)]
        if totals is not None:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(totals)), pa.int32()), "total": list(map(str, totals))})

    rows = fit.mapInArrow(add, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return [int(r["total"]) for r in rows.sort("at").collect()]


def products(fit: DataFrame, size: int, centred) -> np.ndarray:
    """The sum of the products of the entries of ``centred(x)`` over all rows of ``fit``.

    A task adds its rows up and sends the upper half of one matrix; halves are added as rows.
    """
    i, j = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = centred(_stack(batch))
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "part": total[i, j]})

    rows = fit.mapInArrow(add, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("part")).toPandas()
    out = np.zeros((size, size))
    out[rows["i"], rows["j"]] = out[rows["j"], rows["i"]] = rows["part"]
    return out


def fit_model(fit: DataFrame, wanted: int = COMPONENTS) -> Model | None:
    """The components of the distinct vectors ``x``; None where there are none."""
    n = fit.count()
    if not n:
        return None
    sums = exact_sums(fit)
    cov = products(fit, len(sums), lambda x: (from_mean(x, n, sums) / n).astype(float)) / n
    values, vectors = leading(cov, wanted)
    return Model(n, sums, values, vectors, float(np.trace(cov)))


def whitened(x: np.ndarray, model: Model) -> np.ndarray:
    return (from_mean(x, model.n, model.sums) / model.n).astype(float) @ model.vectors / np.sqrt(model.values)


def deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """The squared length of ``n * x - S``; None where it is no whole number of 64 bits."""
    u = from_mean(x, model.n, model.sums)
    if u.dtype != object and int(np.abs(u).max()) ** 2 * u.shape[1] < 1 << 63:
        return (u * u).sum(1).tolist()
    exact = [sum(v * v for v in map(int, row)) for row in u]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    Reads ``vec_id`` and ``embedding``; other columns are not read. Null vectors, empty ones
    and ones with a null or non-finite entry take no part (nor entries above 2**62 / 64,
    whose whole numbers would not fit); zero vectors do. Of vectors of several lengths those
    of the most frequent length take part, of the longer one at a tie. Rows that repeat a
    vector count once for the fit and give rows of their own; ids may be null or repeated.
    Directions without any spread cannot be whitened and are no components, so equal
    vectors only, one vector, or an empty table give no rows. ``deviation`` is null where
    it exceeds 64 bits.
    """
    spark = vectors.sparkSession
    rows = staged(whole_numbers(vectors), "whole-numbers")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation long, whitened array<double>"
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).sort(F.desc("n"), F.desc("size")).first()
    rows = rows.filter(F.size("x") == (sizes["size"] if sizes else 0))
    fit = staged(rows.select("x").distinct(), "fit")
    model = fit_model(fit, wanted)
    k = 0 if model is None else len(model.values)
    error = 0.0
    if k:
        cov = products(fit, k, lambda x: whitened(x, model)) / model.n
        error = float(np.abs(cov - np.eye(k)).max())
    shared = spark.sparkContext.broadcast(model)  # d x 16 numbers

    def run(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        for batch in batches:
            if batch.num_rows and own is not None and len(own.values):
                x = _stack(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(deviations(x, own), pa.int64()),
                     pa.array(whitened(x, own).tolist(), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if k else F.array().cast("array<double>")
    return (rows.mapInArrow(run, schema)
            .select("vec_id", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


@query("op12_whiten_embeddings")
def op12_whiten_embeddings(spark, sf):
    return whiten(table(spark, sf, "embeddings"))
