"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricegrid.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the ``(u, v)`` edges; the root is the component's smallest node.

    Large-star and small-star steps by turns: neighbours above a node, then
    below it, are hung on its smallest neighbour. Nothing grows beyond the edges;
    minima are aggregated before shuffles, and joins are those that Spark can
    split where a node has very many neighbours. Each round is written to the
    shared folder, which cuts the lineage.
    """
    edges = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(moved.union(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    # every node hangs on its root now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
