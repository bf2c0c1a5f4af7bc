"""Connected components of an edge table, as Spark joins (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node has two smaller neighbours, or both a smaller and a larger one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(None).cast("bigint").alias("low")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("low"))
    )
    least, most = F.min("low"), F.max("low")
    both = (F.count("low") > 0) & (F.count("*") > F.count("low"))
    return not ends.groupBy("node").agg(((least < most) | both).alias("open")).filter(F.coalesce("open", F.lit(False))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges(a, b)`` and the smallest node it reaches.

    Each round moves edges towards local minima, until all edges are stars;
    rounds needed grow with the logarithm of the longest path. The edges of a
    round are written to the shared folder, so a lost executor re-reads them. A
    hub's edges are joined to one row per node, with the edges on the side that
    AQE splits. Edges with a NULL end and edges from a node to itself are left out.
    """
    now = stage(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    while _unsettled(now):
        # large star: the larger neighbours of a node move to its smallest one.
        both = now.union(now.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(smallest, "a").filter("b <> m").select(F.col("m").alias("a"), "b")
        # small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        now = stage(small.filter("a <> b").distinct(), "edges")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
