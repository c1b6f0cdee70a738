"""Connected components of an edge table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a, b, both long): the least node of its component.

    Each round is staged, so neither plans nor losses pile up. Nodes' neighbours are never gathered into
    one row: minima are pre-aggregated, and joins on a node of high degree can be split.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _min_neighbour(both).select("a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node are linked to the least of its neighbours and itself.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # Small star: a node and its neighbours below are linked to the least of them.
        least = _min_neighbour(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = stage(small, "edges")
        # Done when each node hangs on one root, which hangs on nothing.
        roles = new.select("a", F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(new.select(F.col("b").alias("a"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        if roles.groupBy("a").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below > 1 OR below = 1 AND above = 1").isEmpty():
            break
        edges = new
    roots = new.select(F.col("b").alias("node")).distinct()
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
