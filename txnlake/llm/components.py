"""Connected components by alternating large and small stars (plain joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import parts_for, store


def _least(edges: DataFrame) -> DataFrame:
    """u, m: the least neighbour, or u itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the least node.

    A node's neighbours are never gathered: their least is a partial
    aggregate, joined back to the edges.  Every step has as many partitions as
    the number of edges asks for.
    """
    edges = store(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .where("u <> v"), f"{name}-edges")
    parts = parts_for(edges.count())
    mark = None
    while True:
        both = edges.union(edges.select("v", "u")).coalesce(parts)
        large = both.join(_least(both).coalesce(parts), "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
        small = large.join(_least(large).coalesce(parts), "u")
        edges = store(small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
            .where("u <> v").distinct().coalesce(parts), f"{name}-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
