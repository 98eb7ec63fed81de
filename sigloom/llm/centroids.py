"""Clusters of vectors around centroids, in integers and in the JVM's own expressions.

Components become integers once and are stored. In a round ``zip_with`` and ``aggregate`` add up the squared distances of
a vector to literal centroid arrays, ``array_min`` of (distance, number) picks the nearest, and one aggregate of a count
and a sum per component gives the next centroids. It combines in the tasks before it shuffles, so a cluster of all
vectors costs no more than others, and only CENTROIDS rows reach the driver. Integers add up alike in any order: reruns
and retried tasks agree to the last digit.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written

COMPONENTS, SCALE = 64, 1024
CENTROIDS, ROUNDS = 8, 10
#: What stands before an id where starting vectors are drawn by hash.
SALT = "3:"

Centroid = list[int]


def integer_vector(embedding: Column, components: int = COMPONENTS) -> Column:
    """floor(SCALE * x) of each component. Null for a vector of another length, with a null, an infinity or a NaN."""
    doubles = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = embedding.isNotNull() & (F.size(embedding) == components) & finite
    return F.when(fit, F.transform(doubles, lambda x: F.floor(x * F.lit(float(SCALE)))))


def squared_distance(vector: Column, centroid: Centroid) -> Column:
    there = F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")
    return F.aggregate(F.zip_with(vector, there, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)


def nearest(vector: Column, centroids: list[Centroid]) -> Column:
    """``distance, cluster`` of the nearest centroid; ties: the smaller number."""
    return F.array_min(
        F.array(*[F.struct(squared_distance(vector, c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)])
    )


def starting_centroids(vectors: DataFrame, count: int = CENTROIDS) -> list[Centroid]:
    """The ``count`` vectors with the smallest sha256 of SALT and their id (null: empty); equal ids: the smaller vector."""
    drawn = F.sha2(F.concat(F.lit(SALT), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r.v) for r in vectors.select(drawn.alias("h"), "v").orderBy("h", "v").limit(count).collect()]


def moved(vectors: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """One round: every centroid that has vectors goes to the floor of their mean."""
    sums = [F.sum(F.element_at("v", k + 1)).alias(f"s{k}") for k in range(len(centroids[0]))]
    placed = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    out = list(centroids)
    for row in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # a row per centroid at most
        out[row.cluster] = [row[f"s{k}"] // row.n for k in range(len(sums))]
    return out


def clusters(embeddings: DataFrame, rounds: int = ROUNDS, count: int = CENTROIDS, components: int = COMPONENTS) -> tuple[DataFrame, list[Centroid]]:
    """``vec_id, v, cluster, distance`` of every vector that is kept, and the centroids after ``rounds`` rounds.

    ``embeddings`` needs ``vec_id, embedding``; other columns are ignored. Vectors of another length, null vectors and
    those with a null, infinite or NaN component are left out. A repeated vec_id gives a row each time, a null one keeps
    its row. Fewer vectors than ``count`` give as many centroids; equal ones leave the larger number empty. No vectors:
    no rows, no centroids. Distances are longs: components beyond some 2^28 after scaling end the query with Spark's
    overflow error instead of a wrong result.
    """
    kept = embeddings.select("vec_id", integer_vector(F.col("embedding"), components).alias("v"))
    vectors = written(kept.filter("v IS NOT NULL"), "vectors")
    centroids = starting_centroids(vectors, count)
    if not centroids:
        return vectors.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    at = vectors.select("vec_id", "v", nearest(F.col("v"), centroids).alias("at"))
    return written(at.select("vec_id", "v", "at.cluster", "at.distance"), "clusters"), centroids


def digest(centroid: Centroid) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def assignments(embeddings: DataFrame) -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    placed, centroids = clusters(embeddings)
    totals = {r.cluster: r.total for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values or [None]]), F.col("cluster") + 1)

    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([totals.get(k) for k in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("long").alias("inertia"),
        by_cluster([digest(c) for c in centroids], "string").alias("centroid_sha256"),
    )
