"""Clusters against plain Python and against SQL."""

import hashlib
import math
import random

import pytest

from compare import connect
from sigloom.llm import centroids, check_sql, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, cluster string, distance string"


def brute(rows):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in first[:8]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centers))
    for _ in range(10):
        at = [near(v)[1] for _, v in kept]
        for k in range(len(centers)):
            if own := [v for (_, v), c in zip(kept, at) if c == k]:
                centers[k] = [sum(x) // len(own) for x in zip(*own)]
    placed = [(i, *near(v)) for i, v in kept]
    by = {k: sum(d for _, d, c in placed if c == k) for k in range(8)}
    return sorted((str(i), c, d, by[c], sum(by.values()), centroids.digest(centers[c])) for i, d, c in placed)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, "x", "y", "z") for i, e in rows], SCHEMA)


def got(df):
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((str(r.vec_id), *(r[n] for n in names)) for r in df.collect())


def vectors(n, seed=1):
    rng = random.Random(seed)
    return [(k, [rng.choice((-1.5, 0.25, 2.0)) + rng.randint(-9, 9) / 64 for _ in range(64)]) for k in range(n)]


@pytest.mark.parametrize("rows", [vectors(120), vectors(5), vectors(40, 2) + [(k, [0.5] * 64) for k in range(40, 90)], [(1, [0.0] * 64)] * 9])
def test_against_python(spark, rows):
    assert got(centroids.assignments(frame(spark, rows))) == brute(rows)


def test_awkward(spark):
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [1.0] * 63 + [None])]
    odd += [(905, [float("nan")] * 64), (906, [float("inf")] + [0.0] * 63), (None, [0.125] * 64), (7, [0.5] * 64), (7, [0.25] * 64)]
    rows = vectors(30) + odd
    assert got(centroids.assignments(frame(spark, rows))) == brute(rows)
    for empty in ([], odd[:7]):
        assert centroids.assignments(frame(spark, empty)).collect() == []


def test_no_python_in_tasks(spark, sf_dir):
    plan = queries.QUERIES["op13_centroid_clusters"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_against_sql(spark, sf_dir):
    con = connect(sf_dir)
    result = con.execute(check_sql.CHECKS["op13_centroid_clusters"])
    names = [d[0] for d in result.description]
    df = queries.QUERIES["op13_centroid_clusters"](spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(result.fetchall()) == sorted(tuple(r[n] for n in names) for r in df.collect())
    con.close()
