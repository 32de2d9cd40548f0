"""Block distances against all differences, and the two searches that are made of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.clustering import silhouette
from kerbside.functions import distances
from kerbside.ml import smote


def every(x, y):
    with np.errstate(invalid="ignore"):
        return np.sqrt(((y[None] - x[:, None]) ** 2).sum(2))


def clouds():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(400, 16)), rng.normal(size=(700, 16))
    return {"plain": (x, y), "far away": (x * 1e-3 + 1e6, y * 1e-3 + 1e6), "tiny": (x * 1e-30, y * 1e-30),
            "two lumps": (np.concatenate([x, x + 1e4]), np.concatenate([y, y + 1e4])),
            "copies": (np.repeat(x[:40], 10, 0), np.concatenate([np.repeat(x[:40], 12, 0), y[:50]])),
            "lattice": (np.round(x[:, :2], 1), np.round(y[:, :2], 1)), "one point": (x[:1].repeat(9, 0), x[:1].repeat(7, 0))}


@pytest.mark.parametrize("name", sorted(clouds()))
def test_sums_and_nearest_of_blocks(name):
    x, y = clouds()[name]
    rng = np.random.default_rng(4)
    ids, theirs = rng.integers(0, 300, len(x)), rng.integers(0, 300, len(y))
    d = every(x, y)
    assert distances.distance_sums(x, y) == pytest.approx(d.sum(1), rel=1e-10, abs=0)
    d[ids[:, None] == theirs[None]] = np.inf
    bound = np.sort(d, 1)[:, 4]                       # ties at the bound stay in
    for limit in (None, bound):
        row, column, far = distances.nearest(x, ids, y, theirs, 3, limit)
        for i in range(len(x)):
            best = np.lexsort((theirs, d[i]))[:3]
            best = best[np.isfinite(d[i][best])]
            assert list(far[row == i]) == list(d[i][best]) and list(theirs[column[row == i]]) == list(theirs[best])


def test_sums_with_what_is_no_number():
    x, y = (z.copy() for z in clouds()["plain"])
    x[3, 1], x[5, 2], y[7, 0] = np.nan, np.inf, -np.inf
    assert distances.distance_sums(x, y) == pytest.approx(every(x, y).sum(1), nan_ok=True)


def test_blocks_grow_with_the_rows():
    """Rows times blocks is what is shuffled: not the square of the rows until blocks are as large as they may be."""
    assert distances.block_rows(100, 4096) == 4096
    shuffled = [n * (n // distances.block_rows(n * n, 4096)) for n in (100_000, 200_000, 400_000)]
    assert shuffled[2] < 4.5 * shuffled[0]
    assert distances.block_rows(10 ** 14, 4096) == distances.MOST_ROWS


def test_silhouette_chooses_its_blocks(spark, monkeypatch):
    monkeypatch.setattr(silhouette, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x, labels = np.repeat(rng.normal(size=(100, 4)), 3, 0).astype(np.float32), rng.integers(0, 3, 300)
    d, scores = every(x.astype(float), x.astype(float)), []
    for i, own in enumerate(labels):
        mean = {c: d[i, labels == c].sum() / ((labels == c).sum() - (c == own)) for c in range(3)}
        a = mean.pop(own)
        scores.append((min(mean.values()) - a) / max(a, min(mean.values())))
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, labels)], "v array<float>, l int")
    assert abs(silhouette.euclidean_silhouette(df, "v", "l").first()["silhouette"] - np.mean(scores)) < 1e-9


def test_small_cells_share_blocks():
    blocks = smote._blocks({0: 3, 1: 4, 2: 25, 3: 2, 4: 5, 5: 4}, 10)
    assert blocks == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 4: (4, 1), 5: (5, 1)}


def test_neighbours_leave_out_what_is_no_vector(spark, monkeypatch):
    monkeypatch.setattr(smote, "CHUNK_ROWS", 32)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.4, (80, 8)) for c in (0, 4)]).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(500, [float("nan")] * 8, 1), (501, [float("inf")] + [0.0] * 7, 1), (502, [None] + [0.0] * 7, 1), (503, None, 1), (None, [0.0] * 8, 1)]
    df = spark.createDataFrame(rows + odd, "id long, v array<float>, copies long")
    got = {}
    for r in smote.neighbours(df, 3).orderBy("id", "place").collect():
        got.setdefault(r["id"], []).append((r["near"], r["distance"]))
    d = every(x.astype(float), x.astype(float))
    np.fill_diagonal(d, np.inf)
    assert got == {i: [(j, d[i, j]) for j in np.argsort(d[i])[:3]] for i in range(len(x))}
    none = smote.neighbours(df.filter(F.col("id") > 500), 3)
    assert none.count() == 0
