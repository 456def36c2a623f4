"""Connected components of links held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.session import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every end of the links (a, b); the component is its smallest node.

    Alternates two steps that keep the components: each node passes its smallest neighbour to its larger
    neighbours, then to its smaller ones.  Minima are combined before the shuffle, so hubs do no harm, and every
    round is written to the shared folder.  Loops, repeated links and an empty table are fine; a link with a null
    end is left out.
    """
    whole = links.where("a <> b")  # leaves out nulls as well
    edges = written(whole.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = written(edges, name)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        edges = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))
        ).distinct()
        edges = written(edges, name)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("component")))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node that has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()
