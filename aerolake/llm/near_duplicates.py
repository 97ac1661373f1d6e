"""Near-duplicate documents by DartMinHash signatures, banded joining and an exact check.

Equal texts are one node. Nodes that share a band are candidates; first every node of
a bucket is compared with the bucket's best connected node only, then nodes of one
bucket that are still in different classes are compared with each other. A candidate is
dropped when its signature is far below the threshold, and counted as a link only when
the exact Jaccard similarity of the shingle sets reaches it. So a group of any number
of near copies costs about one comparison per copy and band, and no bucket is cut short.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import darts
from aerolake.llm.common import query, staged, table
from aerolake.llm.graphs import components
from aerolake.llm.packing import _slices
from aerolake.session import shared_folder

THRESHOLD = 0.8
PAIR_BUCKET = 32  # buckets up to this size compare all pairs by a self-join, larger ones tile by tile
TILE = 512
FINE = 1000  # coordinates of the finer signatures that tiles compare


def _least(k: int, threshold: float) -> int:
    """Agreeing coordinates of ``k`` that lie four standard deviations below the threshold."""
    return int(k * (threshold - 4 * (threshold * (1 - threshold) / k) ** 0.5))




def text_key(text: Column) -> Column:
    """128 bits of the whole text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def signed(docs: DataFrame, weights: str = "set") -> DataFrame:
    """``doc_id, key, bands, code`` of every row. ``weights``: every shingle counts once
    (``set``) or as often as it occurs (``count``). Texts without a word have no bands."""

    def sign(batches):
        for whole in batches:
            for batch in _slices(whole, "text"):
                sets = [darts.shingles(t) for t in batch.column("text").to_pylist()]
                if weights == "set":
                    sets = [(e, np.ones(len(e))) for e, _ in sets]
                signature = darts.signatures(sets)
                bands, code = darts.band_hashes(signature), darts.short_code(signature)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("key"),
                    pa.array([b if len(e) else [] for b, (e, _) in zip(bands, sets)], pa.list_(pa.int64())),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                ], names=["doc_id", "key", "bands", "code"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("key"), "text").mapInArrow(
        sign, f"doc_id {kind}, key binary, bands array<long>, code binary")


def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    """How many coordinates of each pair of codes agree."""
    if not len(a):
        return pd.Series([], dtype="int64")
    left = np.frombuffer(b"".join(a), "<u2").reshape(len(a), -1)
    right = np.frombuffer(b"".join(b), "<u2").reshape(len(b), -1)
    return pd.Series((left == right).sum(1))


def text_table(hits: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``key, text`` of all nodes that share a band with another, in buckets by key.

    The texts are dealt out once, by key and id, so that copies of one text spread; only one
    of each key is kept. Whoever needs texts of some keys later meets them where they
    lie. It is done alike at every size: the keys are never broadcast.
    """
    spark = docs.sparkSession
    wanted = hits.select("key").distinct().join(nodes.select("key", "doc_id"), "key").select("key", F.col("doc_id").alias("_doc_id"))
    found = docs.select("doc_id", "text", text_key(F.col("text")).alias("_key"))
    met = (found.hint("merge").join(wanted, (F.col("_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")))
           .select("key", "text"))
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    name = f"aerolake_texts_{uuid.uuid4().hex}"
    (met.repartition(buckets, "key").dropDuplicates(["key"])
     .write.option("compression", "zstd").option("path", shared_folder(spark, "texts"))
     .bucketBy(buckets, "key").sortBy("key").saveAsTable(name))
    stored = spark.table(name)
    stored.schema  # noqa: B018  resolves the files before the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored


def links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity reaches ``threshold``, with ``similarity``.
    ``texts``: see ``text_table``."""
    agreeing = F.pandas_udf(_agreeing, "long")
    code = lambda c: nodes.select(F.col("key").alias(c), F.col("code").alias(f"{c}_code"))
    near = staged(pairs.distinct().join(code("a"), "a").join(code("b"), "b")
                  .filter(agreeing("a_code", "b_code") >= _least(darts.COORDINATES, threshold)).select("a", "b"), "pairs")

    def compare(batches):
        for whole in batches:
            for batch in _slices(whole, "a_text"):
                found = [darts.jaccard(darts.shingles(x.as_py())[0], darts.shingles(y.as_py())[0])
                         for x, y in zip(batch.column("a_text"), batch.column("b_text"))]
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())],
                                                 names=["a", "b", "similarity"])

    text = lambda c: texts.select(F.col("key").alias(c), F.col("text").alias(f"{c}_text"))
    both = near.join(text("a"), "a").join(text("b"), "b").select("a", "b", "a_text", "b_text")
    return staged(both.mapInArrow(compare, "a binary, b binary, similarity double")
                  .filter(F.col("similarity") >= threshold), "links")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _star_pairs(hits: DataFrame) -> DataFrame:
    """Every node of a bucket with the bucket's best connected one."""
    degree = hits.groupBy("key").agg(F.sum("n").alias("degree"))
    best = hits.join(degree, "key").groupBy("band").agg(F.max(F.struct("degree", "key")).alias("best"))
    return (hits.join(best.select("band", F.col("best.key").alias("center")), "band")
            .filter("key != center").select(*_ordered("key", "center")).distinct())


def _cross_pairs(hits: DataFrame, texts: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one bucket whose nodes are in different classes.

    Large buckets mostly hold copies of one text, over and over in many bands. Those with
    the same main class are put together, which only adds pairs, and their nodes get finer
    signatures, so that pairs somewhat below the threshold do not pile up.
    """
    classed = (hits.join(roots.withColumnRenamed("node", "key"), "key", "left")
               .select("band", "key", F.coalesce("root", "key").alias("root")))
    open_ = (classed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
             .filter("low != high").select("band", "n"))
    rows = staged(classed.join(open_, "band"), "open-buckets")
    small = rows.filter(F.col("n") <= PAIR_BUCKET)
    other = small.select("band", F.col("key").alias("key2"), F.col("root").alias("root2"))
    pairs = small.join(other, "band").filter("key < key2 AND root != root2").select(
        F.col("key").alias("a"), F.col("key2").alias("b")).distinct()
    large = rows.filter(F.col("n") > PAIR_BUCKET)
    main = (large.groupBy("band", "root").agg(F.count("*").alias("k"))
            .groupBy("band").agg(F.max(F.struct("k", "root")).alias("main"))
            .select("band", F.col("main.root").alias("family")))
    members = staged(large.join(main, "band").select("family", "key", "root").distinct(), "families")
    if not members.limit(1).count():
        return pairs

    def sign(batches):
        for whole in batches:
            for batch in _slices(whole, "text"):
                sets = [darts.shingles(t)[0] for t in batch.column("text").to_pylist()]
                code = darts.short_code(darts.signatures([(e, np.ones(len(e))) for e in sets], FINE))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array([c.tobytes() for c in code], pa.binary())], names=["key", "code"])

    fine = staged(members.select("key").distinct().join(texts, "key").mapInArrow(sign, "key binary, code binary"), "fine")
    # A large family is cut into parts, and each pair of parts is a tile of its own.
    sizes = members.groupBy("family").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / TILE).cast("int")
    tiles = (members.join(sizes, "family").join(fine, "key")
             .withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("family", F.least("part", "with").alias("row"), F.greatest("part", "with").alias("col"),
                     "part", "key", "root", "code"))

    def tile(group: pd.DataFrame) -> pd.DataFrame:
        code = np.frombuffer(b"".join(group["code"]), "<u2").reshape(len(group), -1)
        root = pd.factorize(group["root"])[0]
        part, key = group["part"].to_numpy(), group["key"].to_numpy()
        whole = group["row"].iloc[0] == group["col"].iloc[0]
        out = []
        for i in np.flatnonzero(part == group["row"].iloc[0]):
            rest = np.flatnonzero((root != root[i]) & ((np.arange(len(key)) > i) if whole else (part != part[i])))
            near = rest[(code[rest] == code[i]).sum(1) >= _least(FINE, threshold)]
            out += [(min(key[i], key[j]), max(key[i], key[j])) for j in near]
        return pd.DataFrame(out, columns=["a", "b"], dtype=object)

    tiled = tiles.groupBy("family", "row", "col").applyInPandas(tile, "a binary, b binary")
    return pairs.unionByName(tiled.distinct())


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, weights: str = "set") -> DataFrame:
    """``doc_id, class_id, text_id, class_size`` for every row of ``docs``.

    Reads ``doc_id, text``; other columns are not read. Rows are in one class if a chain
    of links joins their texts: equal texts, or Jaccard similarity of ``threshold`` or
    more between the sets of five-word shingles. ``class_id`` is the smallest id of the
    class, ``text_id`` the smallest with that very text, ``class_size`` the rows of the
    class. Null texts count as empty, and texts without a word are linked only if they
    are equal; ids may be null or repeated (a null id is the smallest only if there is
    no other); an empty table gives an empty result.
    """
    rows = staged(signed(docs, weights), "signed")
    members = rows.select("doc_id", "key")
    nodes = staged(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
                                           F.first("bands").alias("bands"), F.first("code").alias("code")), "nodes")
    banded = nodes.select("key", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    hits = staged(banded.join(shared, "band"), "hits")
    texts = text_table(hits, nodes, docs)
    first = links(_star_pairs(hits), nodes, texts, threshold)
    roots = components(first.select("a", "b"))
    second = links(_cross_pairs(hits, texts, roots, threshold), nodes, texts, threshold)
    if second.limit(1).count():
        roots = components(first.unionByName(second).select("a", "b"))
    placed = (nodes.select("key", "doc_id", "copies").join(roots.withColumnRenamed("node", "key"), "key", "left")
              .withColumn("root", F.coalesce("root", "key")))
    classes = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    texts = staged(placed.join(classes, "root").select("key", "class_id", F.col("doc_id").alias("text_id"), "class_size"),
                   "classes")
    return members.join(texts, "key").select("doc_id", "class_id", "text_id", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: of the smallest id, then the smallest by content."""
    content = F.xxhash64(*[F.col(c).cast("string") for c in docs.columns])
    row = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), content)
    found = near_duplicates(docs.select(row.alias("doc_id"), "text"), threshold)
    chosen = staged(found.filter("doc_id = class_id").groupBy(F.col("doc_id").alias("_row"))
                    .agg(F.count("*").alias("n")), "kept")
    kept = docs.withColumn("_row", row).join(chosen.select("_row"), "_row", "left_semi")
    if chosen.filter("n > 1").limit(1).count():  # rows alike in all columns
        kept = kept.dropDuplicates(["_row"])
    return kept.select(*docs.columns)


@query("op4_dart_minhash")
def op4_dart_minhash(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))
