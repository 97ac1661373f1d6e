"""Mixing sources to target weights by hash-threshold histograms, with built-in functions only.

A document is taken whole, zero times or more. Every source takes each of its
documents ``copies`` times and those below a threshold of their hash once more. The
threshold is found without sorting documents: word counts are summed by source and
leading hash bits, a running sum over these at most 4096 buckets finds the bucket in
which the budget ends, and only the documents of that bucket are looked at again, by
their next bits, until a single hash is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import join_small, n_words, query, staged, table
from aerolake.operators.numbering import surrogate_id

HASH_BITS = 60
LEVEL_BITS = 12
WEIGHTS = (5, 2, 1)


def mix_hash(seed: str, doc_id: Column, text: Column) -> Column:
    """60 bits that depend on the row's content alone, so reruns agree."""
    key = F.concat_ws(" ", F.lit(seed), doc_id.cast("string"), text)
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row a source).

    Sources in code point order, null last, get the weights in turn. ``share`` times
    all words are dealt by weight; a target stops at ``most`` times its source's
    words and the excess is dealt again among the others, until none is above.
    Ranks come from a range partitioning; each round sums two numbers.
    """
    spark = sizes.sparkSession
    ranked = surrogate_id(sizes.withColumn("_none", F.col("source").isNull()),
                          ("_none", "source"), id_column="_rank")
    deal = F.array(*[F.lit(int(w)) for w in weights])
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    weighed = staged(ranked.select("source", "source_size", F.get(deal, turn).alias("weight"),
                                   (F.lit(float(most)) * F.col("source_size")).alias("cap")), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full_before = share * total, 0.0, -1
    while total:
        is_full = F.lit(level) * F.col("weight") > F.col("cap") if full_before >= 0 else F.lit(False)
        full, taken, left = weighed.agg(
            F.count_if(is_full), F.coalesce(F.sum(F.when(is_full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0))).first()
        if full == full_before or not left:
            break
        full_before, level = full, (budget - taken) / left
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def mix_rules(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
              most: float = 2.0, seed: str = "mix") -> tuple[DataFrame, int]:
    """One row per source (``source, source_size, target, copies, edge, edge_in``) and their number.

    A row of ``docs`` is taken ``copies`` times, and once more if its hash is below
    ``edge``, or equal to it and ``edge_in``. The document at the edge goes in if that
    brings the source nearer to its target.
    """
    narrow = staged(docs.select(
        "source", n_words(F.col("text")).alias("size"),
        mix_hash(seed, F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    size, goal = F.col("source_size"), F.col("target")
    copies = F.when(size > 0, F.floor(goal / size)).otherwise(F.lit(0)).cast("long")
    state = staged(
        targets.withColumn("copies", copies)
        .withColumn("rest", goal - F.col("copies") * size)
        .withColumn("prefix", F.lit(0).cast("long"))
        .withColumn("edge", F.when(F.col("rest") <= 0, F.lit(0).cast("long")))
        .withColumn("edge_in", F.lit(False)), "mix-state")
    n_sources = state.count()
    for low in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        if not state.filter("edge IS NULL").limit(1).count():
            break
        state = staged(_refine(narrow, state, n_sources, low), "mix-state")
    return state.select("source", "source_size", "target", "copies",
                        F.coalesce("edge", F.lit(0)).alias("edge"), "edge_in"), n_sources


def _refine(narrow: DataFrame, state: DataFrame, n_sources: int, low: int) -> DataFrame:
    """Narrow the open edges to a bucket of ``LEVEL_BITS`` more bits, or to one hash."""
    open_ = state.filter("edge IS NULL").select("source", "prefix", "rest")
    inside = join_small(narrow, open_, ("source",), n_sources, F.col("h")).filter(
        F.shiftright("h", low + LEVEL_BITS) == F.col("prefix"))
    sums = inside.groupBy("source", F.shiftright("h", low).alias("bucket"), "rest").agg(
        F.sum("size").alias("n"), F.min("h").alias("first"), F.max("h").alias("last"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        sums.withColumn("upto", F.sum("n").over(upto))
        .filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest")))
        .select("source", "bucket", (F.col("rest") - F.col("upto") + F.col("n")).alias("rest_in"),
                "n", "first", "last"))
    joined = state.join(
        found.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    hit, single = F.col("bucket").isNotNull(), F.col("first") == F.col("last")
    return joined.select(
        "source", "source_size", "target", "copies",
        F.when(hit, F.col("rest_in")).otherwise(F.col("rest")).alias("rest"),
        F.when(hit, F.col("bucket")).otherwise(F.col("prefix")).alias("prefix"),
        F.when(hit & single, F.col("first")).otherwise(F.col("edge")).alias("edge"),
        F.when(hit & single, F.col("n") < 2 * F.col("rest_in")).otherwise(F.col("edge_in")).alias("edge_in"))


def _with_rules(rows: DataFrame, rules: DataFrame, n_sources: int) -> DataFrame:
    """Adds the rules and ``times``, how often the row is taken, to rows with ``source`` and ``h``."""
    extra = (F.col("h") < F.col("edge")) | ((F.col("h") == F.col("edge")) & F.col("edge_in"))
    return join_small(rows, rules, ("source",), n_sources, F.col("h")).withColumn(
        "times", F.col("copies") + F.when(extra, 1).otherwise(0))


def mix_report(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
               most: float = 2.0, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    ``docs`` has ``doc_id, text, source``; further columns are not read. A null text
    has size 0, a null source is a source of its own, an empty table gives an empty
    result. Rows equal in id and text share a hash and are taken alike; a document's
    ``taken`` is a multiple of its size, at most ``most`` times it rounded up.
    """
    rules, n_sources = mix_rules(docs, weights, share, most, seed)
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       mix_hash(seed, F.col("doc_id"), F.col("text")).alias("h"))
    return _with_rules(rows, rules, n_sources).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        seed: str = "mix") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, all columns kept."""
    rules, n_sources = mix_rules(docs, weights, share, most, seed)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), "source",
                       mix_hash(seed, F.col("doc_id"), F.col("text")).alias("h"))
    taken = _with_rules(rows, rules, n_sources).filter("times > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_n")).select("doc.*")


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         ('0x' || substr(md5(concat_ws(' ', 'mix', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS h
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM docs GROUP BY source),
dealt AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS lvl
  FROM sizes
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT lvl FROM dealt WHERE lvl * weight <= cap
                                                     ORDER BY cap / weight, source NULLS LAST LIMIT 1)) AS target
  FROM dealt),
rules AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM targets),
tied AS (SELECT source, h, sum(size) AS n FROM docs GROUP BY source, h),
summed AS (
  SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM tied),
extra AS (
  SELECT s.source, s.h FROM summed s JOIN rules r ON s.source IS NOT DISTINCT FROM r.source
  WHERE 2 * upto - n < 2 * (target - copies * source_size))
SELECT d.doc_id, d.size::BIGINT AS size, r.source_size, r.target,
       (d.size * (r.copies + CASE WHEN e.h IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM docs d JOIN rules r ON d.source IS NOT DISTINCT FROM r.source
LEFT JOIN extra e ON d.source IS NOT DISTINCT FROM e.source AND d.h = e.h
"""


@query("op10_mix_sources", ORACLE)
def op10_mix_sources(spark, sf):
    return mix_report(table(spark, sf, "documents"))
