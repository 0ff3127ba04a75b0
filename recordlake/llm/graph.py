"""Connected components of an edge table, by hooking and pointer jumping over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _jumped(parents: DataFrame) -> DataFrame:
    """parents (v, p) with p < v, made to point at the last of each chain."""
    while True:
        up = parents.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
        nxt = stored(parents.join(up, parents["p"] == up["_v"], "left").select("v", F.coalesce("_p", "p").alias("p"), F.col("_p").isNotNull().alias("moved")), "cc-jump")
        discard(parents)
        parents = nxt.select("v", "p")
        if nxt.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of the edges (a, b): root is the least vertex of its component.

    Each round hooks every root to the least neighbouring root, shortens the chains, and contracts the edges, so that
    the number of roots with edges at least halves. A vertex of many edges is aggregated before any shuffle.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "cc-edges")
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("root", F.col("v")), "cc-labels")
    while not edges.isEmpty():
        parents = _jumped(stored(edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "cc-hook"))
        of = lambda c, parents=parents: parents.select(F.col("v").alias(f"{c}_v"), F.col("p").alias(f"{c}_p"))
        x = edges.join(of("a"), F.col("a") == F.col("a_v"), "left").join(of("b"), F.col("b") == F.col("b_v"), "left")
        x = x.select(F.coalesce("a_p", "a").alias("x"), F.coalesce("b_p", "b").alias("y"))
        shrunk = stored(x.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b").distinct(), "cc-edges")
        moved = stored(labels.join(of("r"), F.col("root") == F.col("r_v"), "left").select("v", F.coalesce("r_p", "root").alias("root")), "cc-labels")
        for old in (edges, labels, parents):
            discard(old)
        edges, labels = shrunk, moved
    discard(edges)
    return labels
