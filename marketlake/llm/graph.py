"""Connected components by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs neighbours under the smallest one they see: the larger ones under it (``large``), or
    the smaller ones and the node itself. Large stars may repeat an edge, small ones repeat none."""
    if large:
        seen = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    joined = seen.join(least, seen["u"] == least["n"])
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where(F.col("u") != F.col("v"))
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select(F.col("n").alias("u"), F.col("m").alias("v"))
    )
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest member) of every node of ``links`` (u, v).

    Large and small stars in turn until every node hangs under a root: the steps grow with the
    logarithm of the nodes. Every step is written, so no step is computed twice and a lost
    executor costs one step. The least neighbour of a node is found before rows meet, and the
    join back lets Spark split the node with most neighbours.
    """
    edges = durable(links.select("u", "v").where(F.col("u") != F.col("v")))
    while True:
        edges = durable(_stars(_stars(edges, True), False))
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("v", F.lit(0), F.lit(1))
        )
        roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if roles.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty():
            break  # every node hangs under one other, and nothing hangs under it
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
