"""A Merkle manifest of a dataset with a proof for every row, by pointer jumping.

The rows of a source are the leaves of a tree of 16 children a node; the trees' roots
are the leaves of one more tree. Every node then holds a pointer to an ancestor and the
segment of siblings on the way there. Joining the table with itself doubles the distance
and concatenates the segments, so all leaves reach the root after log2(depth) joins. The
root's value is all that the driver sees; everything else is rows, built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import join_small, query, staged, table
from aerolake.operators.numbering import surrogate_id

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
TOP = -1  # the tree of the trees' roots
BLOCK = 256  # neighbours that meet a copy of a far ancestor
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_NODE = ("tree", "level", "idx")
_UP = ("up_tree", "up_level", "up_idx")


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(docs: DataFrame, text: Column) -> Column:
    parts = {c: F.col(c) if c in docs.columns else F.lit(None) for c in FIELDS} | {"text": text}
    return digest(F.concat(*[encoded(parts[c]) for c in FIELDS]))


def tampered(doc_id: Column) -> Column:
    """Rows whose text is lower-cased to see that the proof notices."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def _parents(n: Column) -> Column:
    return F.floor((n + (ARITY - 1)) / ARITY).cast("long")


def _height(n: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def build(leaves: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(the runs of each level, the roots) of trees ``tree, idx, hash, n, row`` (``n`` leaves each).

    A run ``tree, level, idx, nodes, n`` holds hash and ``row`` of at most 16 neighbours of
    the level; ``idx`` is their parent's place. Roots are ``tree, level, hash, row``. ``row``
    is what a leaf takes along; nodes above have null there.
    """
    nodes, runs, roots = leaves, [], []
    kind = leaves.schema["row"].dataType
    root = lambda df, level: df.filter("n = 1").select("tree", F.lit(level).alias("level"), "hash", "row")
    for level in range(height):
        roots.append(root(nodes, level))
        run = (nodes.filter("n > 1").withColumn("up", F.floor(F.col("idx") / ARITY).cast("long")).groupBy("tree", "up")
               .agg(F.collect_list(F.struct("idx", "hash", "row")).alias("run"), F.max("n").alias("n")))
        in_order = F.array_sort("run", lambda a, b: (a["idx"] - b["idx"]).cast("int"))
        runs.append(staged(run.select("tree", F.lit(level).alias("level"), F.col("up").alias("idx"),
                                      F.transform(in_order, lambda x: F.struct(x["hash"], x["row"])).alias("nodes"), "n"), "runs"))
        nodes = runs[-1].select("tree", "idx", digest(F.array_join("nodes.hash", "")).alias("hash"), _parents(F.col("n")).alias("n"),
                                F.lit(None).cast(kind).alias("row"))
    roots.append(root(nodes, height))
    return runs, reduce(DataFrame.unionByName, roots)


def _hops(run: DataFrame) -> DataFrame:
    """Each node's pointer to its parent; the segment is the run and the place in it."""
    return run.select(
        "tree", "level", F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.col("idx").alias("up_idx"),
        F.array_join("nodes.hash", "").alias("run"), F.posexplode("nodes").alias("pos", "node"),
    ).select("tree", "level", (F.col("up_idx") * ARITY + F.col("pos")).alias("idx"), *_UP,
             F.array(F.struct("run", "pos")).alias("segment"), "node.row")


def jump(pointers: DataFrame, depth: int, top: tuple[int, int, int]) -> DataFrame:
    """The pointers of all leaves, doubled until they reach the node ``top``.

    Far ancestors are few and have very many descendants, so each ancestor is copied once
    per ``BLOCK`` neighbouring descendants that point to it; a hot source spreads so.
    """
    distance = 1
    root = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(_UP, top)])
    leaf = (F.col("tree") != TOP) & (F.col("level") == 0)
    while distance < depth:
        salts = max(1, ARITY ** min(distance, 8) // BLOCK)
        last = distance * 2 >= depth
        salt = F.pmod(F.xxhash64("tree", "level", F.floor(F.col("idx") / BLOCK)), F.lit(salts))
        ours = pointers.filter(leaf) if last else pointers
        open_ = ours.filter(~root).withColumn("salt", salt)
        wanted = open_.select(*_UP, "salt").distinct()
        near = pointers.filter(~leaf).select(*[F.col(a).alias(b) for a, b in zip(_NODE, _UP)], *[F.col(c).alias(f"far_{c}") for c in _UP],
                               F.col("segment").alias("far_segment"))
        near = near.join(wanted, list(_UP))
        jumped = open_.join(near, [*_UP, "salt"]).select(
            *_NODE, *[F.col(f"far_{c}").alias(c) for c in _UP], F.concat("segment", "far_segment").alias("segment"), "row")
        pointers = staged(jumped.unionByName(ours.filter(root)), "pointers")
        distance *= 2
    return pointers.filter(leaf)


def proof(segment: Column) -> Column:
    """The siblings of a segment, level by level, left to right."""
    others = F.transform(segment, lambda s: F.concat(F.substring(s["run"], F.lit(1), s["pos"] * 64),
                                                     F.substring(s["run"], s["pos"] * 64 + 65, F.length(s["run"]))))
    return digest(F.array_join(others, ""))


def folded(segment: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(segment, leaf, lambda own, s: digest(F.concat(
        F.substring(s["run"], F.lit(1), s["pos"] * 64), own, F.substring(s["run"], s["pos"] * 64 + 65, F.length(s["run"])))))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    Reads the columns ``FIELDS`` (one that is not there counts as null); others are not read.
    A source's rows are leaves in order of ``doc_id`` (null first), rows of one id in order
    of their hashes; rows alike in all fields stay rows of their own. A null source is a
    source. A source of one row is that leaf; one source alone is the root. Null and empty
    texts have different leaves. An empty table gives an empty result. ``folded_root`` starts
    from the leaf with lower-cased text where ``tampered`` says so; an id that is null is
    never tampered with.
    """
    text = F.col("text") if "text" in docs.columns else F.lit(None).cast("string")
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    changed = F.when(tampered(F.col("doc_id")), leaf_hash(docs, F.translate(text, UPPER, LOWER)))
    leaves = staged(docs.select("doc_id", source.alias("source"), leaf_hash(docs, text).alias("leaf"), changed.alias("changed")),
                    "leaves")
    numbered = staged(surrogate_id(leaves, ("source", "doc_id", "leaf"), -1, "at"), "numbered")
    trees = staged(surrogate_id(numbered.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n")),
                                ("source",), -1, "tree"), "trees")
    n_trees, most = trees.agg(F.count("*"), F.max("n")).first()
    row = F.struct("doc_id", "leaf", "changed").alias("row")
    placed = staged(join_small(numbered, trees, ["source"], n_trees, F.col("at"))
                    .select("tree", (F.col("at") - F.col("first")).alias("idx"), F.col("leaf").alias("hash"), "n", row), "placed")
    height, top_height = _height(most or 0), _height(n_trees)
    runs, subroots = build(placed, height)
    subroots = staged(subroots, "subroots")
    none = F.lit(None).cast(placed.schema["row"].dataType).alias("row")
    top_runs, roots = build(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash",
                                            F.lit(n_trees).cast("long").alias("n"), none), top_height)
    found = roots.first()
    root = F.lit(found["hash"] if found else None).cast("string")
    # A tree's root is a leaf of the top tree: a hop that passes no sibling.
    across = subroots.select(
        "tree", "level", F.lit(0).cast("long").alias("idx"), F.lit(TOP).cast("long").alias("up_tree"), F.lit(0).alias("up_level"),
        F.col("tree").alias("up_idx"), F.array().cast("array<struct<run:string,pos:int>>").alias("segment"), "row")
    pointers = staged(reduce(DataFrame.unionByName, [_hops(r) for r in [*runs, *top_runs]], across), "pointers")
    done = jump(pointers, height + 1 + top_height, (TOP, top_height, 0)).select("tree", "idx", "segment", "row.*")
    named = join_small(done, subroots.select("tree", F.col("hash").alias("subroot")), ["tree"], n_trees, F.col("idx"))
    back = folded(F.col("segment"), F.coalesce("changed", "leaf"))
    return named.select("doc_id", "leaf", "subroot", root.alias("root"), proof(F.col("segment")).alias("proof_sha256"),
                        back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE
hashed AS (
  SELECT doc_id, source, text, head || coalesce(strlen(text) || ':' || text, '-') AS plain,
         CASE WHEN crc % 5 = 0 THEN head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '-') END AS lower
  FROM (SELECT *,
          coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
          xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
            lambda sum, byte: list_reduce([xor(sum, byte), 0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295::BIGINT),
            4294967295::BIGINT) AS crc
        FROM documents)),
leaves AS (
  SELECT doc_id, source, sha256(plain) AS leaf, sha256(coalesce(lower, plain)) AS told,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256(plain)) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
nodes(source, level, idx, h, n) AS (
  SELECT source, 0, idx, leaf, n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY source, level, idx // 16, n),
subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, idx, h, n) AS (
  SELECT 0, idx, h, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, idx // 16, n),
steps AS (
  SELECT source, 0 AS part, level, idx, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT s.source, 1, t.level, t.idx, t.h FROM tops t, (SELECT DISTINCT source FROM leaves) s WHERE t.n > 1),
ways AS (
  SELECT l.doc_id, l.source, l.idx AS leaf_idx, s.part, s.level, s.idx, s.h,
         (CASE WHEN s.part = 0 THEN l.idx ELSE r.idx END) // (16 ** s.level)::BIGINT AS own
  FROM leaves l JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source
  JOIN steps s ON s.source IS NOT DISTINCT FROM l.source
   AND s.idx // 16 = (CASE WHEN s.part = 0 THEN l.idx ELSE r.idx END) // (16 ** (s.level + 1))::BIGINT),
levels AS (
  SELECT source, leaf_idx, string_agg(CASE WHEN idx < own THEN h END, '' ORDER BY idx) AS lft,
         string_agg(CASE WHEN idx > own THEN h END, '' ORDER BY idx) AS rgt,
         row_number() OVER (PARTITION BY source, leaf_idx ORDER BY part, level) AS nth
  FROM ways GROUP BY source, leaf_idx, part, level),
fold(source, idx, nth, h) AS (
  SELECT source, idx, 1, told FROM leaves
  UNION ALL
  SELECT f.source, f.idx, f.nth + 1, sha256(coalesce(lft, '') || f.h || coalesce(rgt, ''))
  FROM fold f JOIN levels v ON f.source IS NOT DISTINCT FROM v.source AND f.idx = v.leaf_idx AND f.nth = v.nth),
proofs AS (
  SELECT source, leaf_idx, sha256(string_agg(coalesce(lft, '') || coalesce(rgt, ''), '' ORDER BY nth)) AS proof
  FROM levels GROUP BY source, leaf_idx),
ends AS (SELECT source, idx, arg_max(h, nth) AS h FROM fold GROUP BY source, idx)
SELECT l.doc_id, l.leaf, r.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
       e.h AS folded_root, e.h = t.h AS verified
FROM leaves l JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source
JOIN tops t ON t.n = 1
JOIN ends e ON e.source IS NOT DISTINCT FROM l.source AND e.idx = l.idx
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.leaf_idx = l.idx
"""


@query("op11_merkle_proofs", ORACLE)
def op11_merkle_proofs(spark, sf):
    return manifest(table(spark, sf, "documents"))
