"""Centroid clustering: exact integer k-means with PCA-rotated filtering.

Vectors become integers, floor(scale * x). Their mean and covariance, over all vectors, give a
rotation; every vector is stored with its leading rotated coordinates p and the norm r of what
they leave out. For a centroid treated alike, |p_x - p_c|^2 + (r_x - r_c)^2 never exceeds the
squared distance, whatever the rotation (orthogonal projection; the triangle inequality for the
rest). A vector is compared in integers with the centroid of least bound, then with every centroid
whose bound, less a margin for rounding, is not above that distance. So no nearest centroid and no
tie is lost, and results do not depend on the rotation or on the layout of the table.

A round is one pass: each task adds up its vectors by cluster, and only those sums (clusters times
components a task) are shuffled; the driver holds the centroids. A common vector is a row like any
other, and no group of rows meets in one task. The stored vectors are in the shared folder.

Vectors with another number of components, a null vector or component, NaN or an infinity are left
out. Null ids are kept (their text is empty when starts are drawn). Repeated rows count each time;
equal hashes are ordered by components. Fewer vectors than centroids give fewer centroids; none, no
rows. Extra columns are not read. A component past ``LARGEST`` after scaling is an error: its
distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import stored

LARGEST = 1 << 27        # 64 components that differ by twice this have a squared distance under 2^62
LEADING = 16             # rotated coordinates kept
RESULT = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()),
                       *[T.StructField(c, T.LongType()) for c in ("distance", "cluster_inertia", "inertia")],
                       T.StructField("centroid_sha256", T.StringType())])


def integers(df: DataFrame, id_column: str, vector: str, size: int, scale: int) -> DataFrame:
    """(vec_id, v): the vectors of ``size`` finite components, as integers."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    big = F.exists("v", lambda c: (c > LARGEST) | (c < -LARGEST))
    checked = F.when(big, F.raise_error(F.lit(f"a component is past {LARGEST} after scaling"))).otherwise(F.col("v"))
    return (df.where((F.size(x) == size) & finite).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
            .withColumn("v", checked.cast("array<int>")))


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


@dataclass(frozen=True)
class Rotation:
    mean: np.ndarray
    axes: np.ndarray         # components x leading, orthonormal

    def project(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and residual norm of each row."""
        centred = v - self.mean
        p = centred @ self.axes
        return p, np.linalg.norm(centred - p @ self.axes.T, axis=1)


def totals(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of (keys, n, sums: array) added up elementwise: (keys, n, at, total)."""
    parts = df.select(*keys, "n", F.posexplode("sums").alias("at", "part"))
    return parts.groupBy(*keys, "at").agg(F.sum("n").alias("n"), F.sum("part").alias("total"))


def rotation(vectors: DataFrame, size: int, leading: int = LEADING) -> Rotation:
    """Axes of largest variance, from sums and products over all vectors."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m = 0, np.zeros((size + 1, size))
        for b in batches:
            v = matrix(b.column(0), float)
            if len(v):
                n, m[0], m[1:] = n + len(v), m[0] + v.sum(0), m[1:] + v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([m.ravel().tolist()])], names=["n", "sums"])

    parts = vectors.select("v").mapInArrow(moments, "n long, sums array<double>")
    rows = totals(parts, []).collect()
    n, m = max(1, rows[0]["n"]), np.zeros((size + 1) * size)
    for r in rows:
        m[r["at"]] = r["total"]
    mean, products = m[:size] / n, m[size:].reshape(size, size) / n
    _, axes = np.linalg.eigh(products - np.outer(mean, mean))
    return Rotation(mean, axes[:, ::-1][:, :leading].copy())


def rotated(vectors: DataFrame, by: Rotation) -> DataFrame:
    """``vectors`` with ``p``, their leading rotated coordinates, and ``r``, the residual norm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p, r = by.project(matrix(b.column(1), float))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*b.columns, flat, pa.array(r)], names=["vec_id", "v", "p", "r"])

    return vectors.mapInArrow(run, "vec_id long, v array<int>, p array<double>, r double")


@dataclass(frozen=True)
class Centroids:
    v: np.ndarray            # int64, centroids x components
    by: Rotation

    def nearest(self, v: np.ndarray, p: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance) of each row, and how many distances were computed."""
        cp, cr = self.by.project(self.v.astype(float))
        bound = ((p[:, None, :] - cp[None]) ** 2).sum(2) + (r[:, None] - cr[None]) ** 2
        size = (p * p).sum(1) + r * r
        # a thousand times what rounding of these sums of squares can amount to
        bound -= 1e-6 + 1e-11 * (size[:, None] + ((cp * cp).sum(1) + cr * cr)[None] + (self.by.mean ** 2).sum())
        first = bound.argmin(1)
        best = ((v - self.v[first]) ** 2).sum(1)
        cluster, computed = first.copy(), len(v)
        for c in range(len(self.v)):
            rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
            computed += len(rows)
            d = ((v[rows] - self.v[c]) ** 2).sum(1)
            better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
            best[rows[better]], cluster[rows[better]] = d[better], c
        return cluster, best, computed

    def of(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        v = matrix(b.column("v"), np.int64)
        return v, *self.nearest(v, matrix(b.column("p"), float), b.column("r").to_numpy())

    def hashes(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.v.tolist()]


def cluster_sums(vectors: DataFrame, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, list[int], int]:
    """Per cluster: rows, sums of components, sum of distances; and the distances computed."""
    k, size = centroids.v.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, size + 2), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            v, cluster, distance, computed = centroids.of(b)
            sums[0, -1] += computed
            for c in np.unique(cluster):
                rows = cluster == c
                n[c] += rows.sum()
                sums[c, :size] += v[rows].sum(0)
                sums[c, size] += distance[rows].sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(sums.tolist())],
                                         names=["cluster", "n", "sums"])

    n, sums = [0] * k, [[0] * (size + 2) for _ in range(k)]
    for r in totals(vectors.mapInArrow(run, "cluster int, n long, sums array<long>"), ["cluster"]).collect():
        n[r["cluster"]], sums[r["cluster"]][r["at"]] = r["n"], r["total"]
    return (np.array(n), np.array([s[:size] for s in sums], np.int64), [s[size] for s in sums], sums[0][-1])


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose id has the smallest hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(text, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def fit(vectors: DataFrame, by: Rotation, k: int, rounds: int, seed: int) -> Centroids | None:
    """Centroids after ``rounds`` rounds, or earlier once a round changes none; None without vectors."""
    v = starts(vectors, k, seed)
    if not len(v):
        return None
    for _ in range(rounds):
        n, sums, _, _ = cluster_sums(vectors, Centroids(v, by))
        moved = np.where(n[:, None] > 0, sums // np.maximum(n, 1)[:, None], v)
        if (moved == v).all():
            break
        v = moved
    return Centroids(v, by)


def cluster(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 1024,
            k: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector kept."""
    vectors = stored(integers(df, id_column, vector, size, scale), "vectors")
    by = rotation(vectors, size) if vectors.limit(1).count() else None
    if by is None:
        return df.sparkSession.createDataFrame([], RESULT)
    vectors = stored(rotated(vectors, by), "rotated")
    centroids = fit(vectors, by, k, rounds, seed)
    _, _, inertia, _ = cluster_sums(vectors, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, found, distance, _ = centroids.of(b)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(found.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster") + 1)

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long").withColumns({
        "cluster_inertia": by_cluster(inertia, "long"), "inertia": F.lit(sum(inertia)).cast("long"),
        "centroid_sha256": by_cluster(centroids.hashes(), "string")})
