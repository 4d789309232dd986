"""Connected components as DataFrame joins (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.materialize import materialize


def _star(pairs: DataFrame) -> DataFrame:
    """Rows (u, v) with the smallest of u and all its v. The minimum combines before the shuffle,
    and the join back is one that adaptive execution may split, so hubs are harmless."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.withColumn("m", F.least("u", "m")), "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _star(both).where("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    star = _star(edges)
    moved = star.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = star.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Every round is written to the shared folder and reread, so that a lost executor costs one
    round at most. Rounds grow with the logarithm of the longest path. Loops, repeated edges and
    edges with a null end are ignored; no edges give no rows.
    """
    a, b = F.col(left), F.col(right)
    edges = materialize(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_small(materialize(_large(edges))))
        mark, before = _mark(edges), mark
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
