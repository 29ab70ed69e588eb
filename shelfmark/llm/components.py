"""Connected components of an edge table, by rounds of joins.

Large-star and small-star steps (Kiverts and others, "Connected Components in MapReduce and Beyond"):
each round hangs nodes on smaller neighbours, until every node hangs on the smallest one of its
component. Rounds grow with the logarithm of the longest path. Minima combine map-side; the joins back
are between written tables, so that AQE can split those of a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stage


def _star(pairs: DataFrame, label: str) -> DataFrame:
    """(v, m): the neighbours ``v`` of every ``u``, hung on the smallest of ``u`` and its neighbours."""
    least = stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{label}-least")
    return pairs.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; ``edges`` has bigint columns ``a`` and ``b``."""
    current = stage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "large").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u <> v").distinct(), "large-star")
        small = _star(large, "small")
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        current = stage(hung.filter("u <> v").distinct(), "small-star")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    # Every edge now leads to a root, which itself has none.
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
