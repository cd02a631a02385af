"""Connected components of a graph given as pairs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import written


def _least_neighbour(both: DataFrame) -> DataFrame:
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").withColumn("m", F.least("u", "m"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or larger ones only: then nothing is left to contract."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(edges.select("v", F.lit(0), F.lit(1)))
    counted = ends.groupBy("node").agg(F.sum("below").alias("below"), F.sum("above").alias("above"))
    return counted.filter("below > 1 OR (below = 1 AND above > 0)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge (a, b).

    Every round ties each node's larger neighbours to its smallest one and then its smaller ones, which
    halves distances; a round's edges are no more than those before. Groupings
    combine before they shuffle, and the join back to a hub's edges can be split.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        large = _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = _least_neighbour(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m")).filter("u <> v").distinct()
        edges = written(small, "edges")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        edges.select("v", "v").distinct().toDF("node", "component")
    )
