"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepwise.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour to the smallest one. Edges come with u > v, here and below."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = edges.unionByName(turned).groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select("m", F.explode(F.array("u", "v")).alias("u"))
    return moved.where("u <> m").select("u", F.col("m").alias("v"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link to a smaller one, or links to larger ones only."""
    either = (F.struct(F.col(c).alias("node"), F.lit(up).alias("up")) for c, up in (("u", 1), ("v", 0)))
    ends = edges.select(F.explode(F.array(*either)).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.up").alias("up"), F.count("*").alias("links"))
    return nodes.where("up > 1 OR up = 1 AND links > 1").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes but each component's smallest, which is its name.

    ``edges`` has long columns u and v; the result is a stored table. Every round is written to the shared
    folder, so lineage stays short. Nodes with many links only meet reduced rows: minima, then a splittable join.
    Links that are stars already stay as they are, so no round is run to see that nothing changes.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(_large_star(now).distinct(), "links")
    while not _stars(now):
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
