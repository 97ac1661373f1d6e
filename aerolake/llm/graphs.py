"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import staged

# Nodes of a graph, a few dozen bytes each, whose roots are broadcast; counted first. A
# larger graph takes shuffled joins.
FEW_NODES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``); the root is the smallest node.

    Every round each node takes the smallest root among itself and its neighbours, and
    each root's own root is followed; long chains so shrink by a factor per round. A
    node with very many edges is one row per task in the shuffle.
    """
    both = staged(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "edges")
    roots = staged(both.groupBy("node").agg(F.min("other").alias("other"))
                   .select("node", F.least("node", "other").alias("root")), "roots")
    few = roots.count() <= FEW_NODES
    meet = F.broadcast if few else (lambda df: df)
    while True:
        near = (both.join(meet(roots.select(F.col("node").alias("other"), F.col("root").alias("seen"))), "other")
                .groupBy("node").agg(F.min("seen").alias("seen")))
        low = near.join(meet(roots), "node").select("node", "root", F.least("root", "seen").alias("low"))
        low = staged(low, "roots")
        # What a node learns also holds for the root it had.
        hook = low.filter("low < root").groupBy("root").agg(F.min("low").alias("hook"))
        hooked = (low.join(meet(hook.withColumnRenamed("root", "_root")), F.col("node") == F.col("_root"), "left")
                  .select("node", "root", F.least("low", F.coalesce("hook", "low")).alias("low")))
        hooked = staged(hooked, "roots")
        up = hooked.select(F.col("node").alias("low"), F.col("low").alias("top"))
        new = staged(hooked.join(meet(up), "low").select("node", F.col("root").alias("was"), F.col("top").alias("root")), "roots")
        if not new.filter("root != was").limit(1).count():
            return new.select("node", "root")
        roots = new.select("node", "root")
