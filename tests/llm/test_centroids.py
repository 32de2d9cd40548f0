"""Centroid clustering against plain integer k-means, and its bounds."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import centroids


def plain(rows, size, scale, k, rounds, seed):
    """Brute force in Python integers: rows of (id, vector) to (id, cluster, distance), and centroids."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    c = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(c)):
            own = [v for (_, v), (_, f) in zip(kept, found) if f == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, assign())], c


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def vectors(size=6, n=400):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(i % 5, 0.6, size)]) for i in range(n)]
    rows += [(1000 + i, [0.0] * size) for i in range(50)]                     # one common vector
    rows += [rows[3], rows[3], (None, rows[4][1])]                            # repeated rows, a null id
    rows += [(2000, None), (2001, [1.0]), (2002, [float("nan")] + [0.0] * (size - 1)), (2003, [float("inf")] * size),
             (2004, [None] + [0.0] * (size - 1)), (2005, [])]
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("scale", [1024, 2])                                  # a coarse scale makes ties
def test_equals_brute_force(spark, scale):
    rows = vectors()
    df = table(spark, rows).repartition(5).withColumn("v", F.lit("x")).withColumn("p", F.lit(1)).withColumn("cluster", F.lit(9))
    out = centroids.cluster(df, size=6, scale=scale, k=8, rounds=10, seed=3)
    found = out.collect()
    wanted, c = plain(rows, 6, scale, 8, 10, 3)
    def key(r):
        return tuple((x is not None, x or 0) for x in r)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in found], key=key) == sorted(wanted, key=key)
    by = {}
    for _, j, d in wanted:
        by[j] = by.get(j, 0) + d
    for r in found:
        assert (r.cluster_inertia, r.inertia) == (by[r.cluster], sum(by.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    one = centroids.cluster(table(spark, [(7, [1.0, -0.5])]), size=2).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(7, 0, 0, 0)]
    for rows in ([], [(1, None), (2, [1.0])]):
        none = centroids.cluster(table(spark, rows), size=2)
        assert none.count() == 0 and none.columns == centroids.RESULT.fieldNames()


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="past"):
        centroids.cluster(table(spark, [(1, [1e30, 0.0])]), size=2).collect()


@pytest.mark.parametrize("far", [1, centroids.LARGEST // 1024])
def test_bounds_never_lose_the_nearest(far):
    """Random and far vectors: the same answer as all distances, with fewer computed where axes matter."""
    rng = np.random.default_rng(2)
    v = np.floor(rng.normal(0, 300, (3000, 64)) * np.linspace(3, 0.05, 64) + rng.integers(0, 8, (3000, 1)) * 200).astype(np.int64) * far
    v = np.clip(v, -centroids.LARGEST, centroids.LARGEST)
    c = np.concatenate([v[:6], v[:2]])                                        # equal centroids: the smaller number
    _, axes = np.linalg.eigh(np.cov(v.T.astype(float)))
    by = centroids.Rotation(v.mean(0), axes[:, ::-1][:, :16].copy())
    cluster, distance, computed = centroids.Centroids(c, by).nearest(v, *by.project(v.astype(float)))
    every = ((v[:, None] - c[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < 0.6 * every.size


def test_layout_does_not_matter(spark):
    rows = vectors()
    a = centroids.cluster(table(spark, rows).coalesce(1), size=6).collect()
    b = centroids.cluster(table(spark, rows).repartition(13), size=6).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))
