"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are dealt into blocks; every pair of a query block and a
candidate block is one tile. In a tile the vectors are rounded to int8, whose products
are exact; the lost parts' norms bound the error of each distance. Only candidates
whose lower bound does not exceed the k-th smallest upper bound are computed again from
the original vectors in double precision, so the result is exact. The tiles' short
sorted lists are merged by heaps, a bounded number of lists at a time.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import query, staged, table

QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
MERGE_WIDTH = 64  # lists of a query that one heap merges
EXACT_DIMENSIONS = 1024  # 127 * 127 * 1024 < 2 ** 24: a float32 product of int8 parts is exact


def usable(vector: Column) -> Column:
    """Not null, not empty, finite in every component and not all zero."""
    double = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(double, lambda x: x != 0), F.lit(False))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of what the rounding lost."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1  # only a subnormal row
    parts = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    return parts, scale, np.linalg.norm(x - parts * scale[:, None], axis=1)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact products of the rows of two int8 matrices."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        part = slice(at, at + EXACT_DIMENSIONS)
        out += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return out


def bounds(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of the rows of ``q`` and ``c``."""
    q8, qs, q_lost = quantise(q)
    c8, cs, c_lost = quantise(c)
    q_norm, c_norm = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    about = (q_norm ** 2)[:, None] + (c_norm ** 2)[None] - 2 * int8_product(q8, c8) * qs[:, None] * cs[None]
    # q.c - q'.c' = q'.(c - c') + (q - q').c, each at most a product of norms.
    error = 2 * ((q_norm + q_lost)[:, None] * c_lost[None] + q_lost[:, None] * c_norm[None])
    error += 1e-12 * ((q_norm ** 2)[:, None] + (c_norm ** 2)[None])  # of double arithmetic itself
    return about - error, about + error


def exact_distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Euclidean distances of ``q`` to the rows of ``c``, components added in order."""
    d = c - q
    return np.sqrt(np.add.accumulate(d * d, axis=1)[:, -1])


def nearest_in_tile(q_ids, q, c_ids, c, k: int):
    """Per query row its ``k`` nearest candidates of the tile as sorted ``(distance, id)``;
    candidates with the query's id are left out."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], np.ascontiguousarray(c[order])
    # Of equal vectors only the k+1 smallest ids can matter: k, and perhaps the query's own.
    if len(c) > k + 1:
        rows = c.view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel()
        group = np.unique(rows, return_inverse=True)[1].ravel()
        by = np.argsort(group, kind="stable")
        first = np.concatenate([[True], group[by][1:] != group[by][:-1]])
        nth = np.empty(len(c), np.int64)
        nth[by] = np.arange(len(c)) - np.maximum.accumulate(np.where(first, np.arange(len(c)), 0))
        c_ids, c = c_ids[nth <= k], c[nth <= k]
    low, high = bounds(q, c)
    out = []
    for i, own in enumerate(q_ids):
        other = c_ids != own
        lows, highs = low[i][other], high[i][other]
        n = min(k, len(highs))
        if not n:
            out.append([])
            continue
        alive = np.flatnonzero(lows <= np.partition(highs, n - 1)[n - 1])
        ids = c_ids[other][alive]
        scores = exact_distances(q[i], c[other][alive])
        best = np.lexsort((ids, scores))[:n]
        out.append(list(zip(scores[best].tolist(), ids[best].tolist())))
    return out


_LISTS = "query_row long, query_id long, block int, part int, score array<double>, vec_id array<long>"


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, query_block: int = QUERY_BLOCK,
            candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest rows of every query row, exactly.

    Reads ``vec_id`` (whole numbers) and ``embedding``; other columns are not read.
    ``score`` is the Euclidean distance; ties go to the smaller id. Rows with a null id
    and vectors that are not ``usable`` take no part; rows that repeat an id and vector
    count once; rows with the query's id are no candidates of it; vectors of another
    length neither. With fewer candidates than ``k`` all are returned, with none no row.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"),
                          is_query.alias("asks"))
    rows = staged(
        rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .dropDuplicates(["vec_id", "embedding"])
        .select("*", F.monotonically_increasing_id().alias("row")), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if("asks")).first()
    parts, blocks = max(1, math.ceil(n / candidate_block)), max(1, math.ceil(n_queries / query_block))
    deal = lambda name, seed, m: F.pmod(F.xxhash64(F.lit(seed), name), F.lit(m)).cast("int")
    spread = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    size = F.size("embedding").alias("size")
    asked = rows.filter("asks").select("row", "vec_id", "embedding", size, deal("row", 1, blocks).alias("block"),
                                       spread(parts).alias("part"))
    offered = rows.select(F.col("vec_id").alias("near_id"), F.col("embedding").alias("near"), size, deal("row", 2, parts).alias("part"),
                          spread(blocks).alias("block"))

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c.split()[0]: [] for c in _LISTS.split(", ")}, dtype=object)
        found = nearest_in_tile(left["vec_id"].to_numpy(), np.stack(left["embedding"]),
                                right["near_id"].to_numpy(), np.stack(right["near"]), k)
        return pd.DataFrame({
            "query_row": left["row"], "query_id": left["vec_id"], "block": left["block"], "part": left["part"],
            "score": [[s for s, _ in f] for f in found], "vec_id": [[v for _, v in f] for f in found]})

    keys = ["block", "part", "size"]
    lists = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(tile, _LISTS)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (row, query_id), some in group.groupby(["query_row", "query_id"]):
            merged = heapq.merge(*[list(zip(s, v)) for s, v in zip(some["score"], some["vec_id"])])
            best = [pair for pair, _ in zip(merged, range(k))]
            out.append((row, query_id, some["block"].iloc[0], some["part"].iloc[0] // MERGE_WIDTH,
                        [float(s) for s, _ in best], [int(v) for _, v in best]))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _LISTS.split(", ")])

    while parts > 1:
        parts = math.ceil(parts / MERGE_WIDTH)
        lists = lists.groupBy("block", F.floor(F.col("part") / MERGE_WIDTH)).applyInPandas(merge, _LISTS)
    return lists.select("query_id", F.posexplode(F.arrays_zip("vec_id", "score")).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


ORACLE = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce(list_transform(list_zip(q.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
                          lambda s, t: s + t)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
WHERE rank <= 10
"""


@query("op3_int8_tile_knn", ORACLE)
def op3_int8_tile_knn(spark, sf):
    return nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)
