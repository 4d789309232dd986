"""Centroid clustering in exact integers, with JVM expressions only.

A component x becomes floor(scale * x). The vectors whose ids have the smallest hashes are the first centroids. A
round compares every vector with the centroids, which are array literals of the plan: zip_with and
aggregate give the squared distance to each, and array_min of (distance, number) chooses the cluster, the
smaller number of equals. One aggregate of column sums, combined before its shuffle, then gives a row for
each cluster, and their floored quotients are the next centroids. The driver sees these few rows only.

Integers do not depend on the order of additions, so reruns, retries and other partitionings agree. Inertias are
decimals and pass 64 bits.

Defined cases: a vector that is null, of another length, or that holds a null or non-finite component is left out;
integers are held within +-LARGEST, so that squared distances fit in a bigint; a null id hashes as
the text `null`; rows with equal ids are vectors of their own, and as first centroids they follow each other in the
order of their integers; with fewer vectors than clusters there are as many clusters as vectors; without any, no rows;
an inertia beyond a bigint is null; columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.materialize import Scratch, materialize

LARGEST = 1 << 27  # 64 squared differences of twice this are below 2^63


def integer_vectors(vectors: DataFrame, components: int, scale: int) -> DataFrame:
    """(vec_id, v): integer components of the vectors that are whole and finite."""
    x = F.col("embedding")
    # Comparing with a null gives null, which `forall` does not take for true.
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    whole = vectors.select("vec_id", "embedding").where((F.size(x) == components) & finite)

    def integer(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * scale)
        return F.greatest(F.least(scaled, F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")

    return whole.select("vec_id", F.transform(x, integer).alias("v"))


def _literal(values: list[int]) -> Column:
    """An array of bigints in one expression (a call for each number would take longer than a round)."""
    return F.expr("array(" + ", ".join(f"{c}L" for c in values) + ")")


def _distance(vector: Column, centroid: list[int]) -> Column:
    squares = F.zip_with(vector, _literal(centroid), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, square: total + square)


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Add `nearest`, a struct of the least squared distance and the number of the centroid that has it."""
    each = [F.struct(_distance(F.col("v"), c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]
    return vectors.withColumn("nearest", F.array_min(F.array(*each)))


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    return [list(r["v"]) for r in vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(clusters).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floored means of the clusters; a cluster without vectors keeps its centroid."""
    width = len(centroids[0])
    # Ints below LARGEST add up in a bigint for 2^35 vectors; Spark raises beyond.
    sums = [F.expr(f"sum(v[{j}]) s{j}") for j in range(width)]
    rows = assigned(vectors, centroids).groupBy("nearest.cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    out = list(centroids)
    for r in rows:
        out[r["cluster"]] = [int(r[f"s{j}"]) // r["n"] for j in range(width)]
    return out


def fit_centroids(vectors: DataFrame, clusters: int, rounds: int, seed: int) -> list[list[int]]:
    """Centroids after all rounds; `vectors` as from `integer_vectors`."""
    start = first_centroids(vectors, clusters, seed)
    return reduce(lambda now, _: moved(vectors, now), range(rounds), start) if start else []


def cluster_vectors(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, components: int = 64, scale: int = 1024
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid) of every whole vector."""
    with Scratch(vectors.sparkSession) as scratch:
        stored = scratch.keep(integer_vectors(vectors, components, scale))
        centroids = fit_centroids(stored, clusters, rounds, seed)
        if not centroids:
            empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>"
            return vectors.sparkSession.createDataFrame([], empty)
        final = materialize(assigned(stored, centroids).select("vec_id", "nearest.cluster", "nearest.distance"))
    inertia = {r[0]: int(r[1]) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)"))).collect()}
    facts = [(inertia.get(i, 0), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), c) for i, c in enumerate(centroids)]
    number = F.col("cluster") + 1

    def of_cluster(values: list[Column]) -> Column:
        return F.element_at(F.array(*values), number)

    def fitting(total: int) -> Column:
        return F.lit(total if total < 1 << 63 else None).cast("bigint")

    return final.withColumns(
        {
            "cluster_inertia": of_cluster([fitting(f[0]) for f in facts]),
            "inertia": fitting(sum(f[0] for f in facts)),
            "centroid_sha256": of_cluster([F.lit(f[1]) for f in facts]),
            "centroid": of_cluster([_literal(f[2]) for f in facts]),
        }
    )
