"""Connected components of an edge table by alternating large-star and small-star steps.

Every step points nodes at the smallest neighbour; after O(log^2 n) rounds each component is a star around its
smallest node. Minima are aggregated in the map tasks and joined back from a written table, so that Spark can
split the rows of a node with very many neighbours. Nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridcast.llm.tables import passing, stage


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Each (u, v) becomes (v, smallest neighbour of u or u itself)."""
    low = stage(edges.groupBy("u").agg(F.min("v").alias("low"))
                .select("u", F.least("u", "low").alias("low")), name)
    return edges.join(low.hint("merge"), "u")


def components(links: DataFrame) -> DataFrame:
    """links: columns a, b of one type (either order, repeats allowed). Columns node, label (smallest node)."""
    with passing(links.sparkSession) as used:
        edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                      "edges")
        seen = None
        while True:
            mark = edges.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if mark == seen:
                break
            seen = mark
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = stage(_star(both, "low").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(),
                          "edges")
            small = _star(large, "low").select(F.explode(F.array(
                F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
            edges = stage(small.select("e.*").where("u <> v").distinct(), "edges")
        used.keep(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
