"""Silhouette of a clustering.

Squared distances to a whole cluster follow from the cluster's count, sum and sum of
squares, so that measure reads every row once.  Plain Euclidean distances have no such
form, but bounds: the mean distance of a row to a cluster is at least its distance to the
centroid and at most the root of its mean squared distance.  Only the clusters whose lower
bound does not exceed the least upper bound can be the nearest other one; exact sums are
made for those and the own cluster alone.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import distances
from kerbside.session import durable, pin_small

CLUSTER_CELLS = 1_000_000      # clusters x dimensions in one part of the cluster table, held by a task
BLOCK = 4096                   # rows on each side of a block of distances, at least


def _result(df: DataFrame, value: float | None, clusters: int) -> DataFrame:
    message = None if value is not None else f"no score: {clusters} cluster(s)"
    return df.sparkSession.createDataFrame([(value, clusters, message)],
                                           "silhouette double, clusters int, message string")


# ---- clusters by their sums -----------------------------------------------------------
def cluster_sums(rows: DataFrame, vector: str, label: str, dims: int) -> DataFrame:
    """(_l, n, s, q): rows, sum of the vectors and sum of their squared norms per cluster."""
    return rows.groupBy(F.col(label).alias("_l")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col(vector)[i].cast("double")) for i in range(dims)]).alias("s"),
        F.sum(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("q"))


def _parts(sums: DataFrame, dims: int, cells: int) -> list[list]:
    """The cluster table in parts that a task can hold, however many clusters there are."""
    per = max(1, cells // max(dims, 1))
    numbered = sums.withColumn("_part", F.pmod(F.xxhash64("_l"), F.lit(max(1, -(-sums.count() // per)))))
    numbered = durable(numbered)
    parts = [r["_part"] for r in numbered.select("_part").distinct().orderBy("_part").collect()]
    return [numbered.filter(F.col("_part") == p).orderBy("_l").collect() for p in parts]


def _mean_squares(part: list):
    """A function of vectors and labels: mean squared distance to the own cluster (if it is here) and to the nearest other one."""
    at = {r["_l"]: i for i, r in enumerate(part)}
    n, s, q = np.array([r["n"] for r in part], float), np.array([r["s"] for r in part]), np.array([r["q"] for r in part])

    @F.arrow_udf("struct<own double, size double, other double>")
    def one(v: pa.Array, label: pa.Array) -> pa.Array:
        x = distances.matrix(v)
        own = np.array([at.get(a, -1) for a in label.to_pylist()], int)
        total = n * (x * x).sum(1)[:, None] - 2 * x @ s.T + q if len(x) else np.zeros((0, len(n)))
        row, here = np.arange(len(x)), own >= 0
        a = np.where(here, total[row, own] / np.maximum(n[own] - 1, 1), 0.0)
        mean = total / n
        mean[row[here], own[here]] = np.inf
        return pa.StructArray.from_arrays(
            [pa.array(a, mask=~here), pa.array(n[own], mask=~here), pa.array(mean.min(1) if len(n) else np.full(len(x), np.inf))], ["own", "size", "other"])
    return one


def squared_per_row(df: DataFrame, vector: str, label: str, into: str = "silhouette",
                    cells: int = CLUSTER_CELLS) -> DataFrame:
    """Silhouette of each row with squared Euclidean distances, over all rows; NULL with one cluster."""
    rows = df.filter(F.col(label).isNotNull())
    first = rows.select(F.size(vector).alias("d")).first()
    dims = first["d"] if first else 0
    parts = _parts(cluster_sums(rows, vector, label, dims), dims, cells)
    found = [_mean_squares(p)(F.col(vector), F.col(label)) for p in parts]
    held = rows.withColumns({f"_part{i}": f for i, f in enumerate(found)})
    names = [f"_part{i}" for i in range(len(found))]
    if not names:
        return rows.withColumn(into, F.lit(None).cast("double"))
    a, size = (F.coalesce(*[F.col(f"{p}.{k}") for p in names]) for k in ("own", "size"))
    b = reduce(lambda x, y: F.least(x, y), [F.col(f"{p}.other") for p in names])
    score = F.when(size > 1, (b - a) / F.greatest(a, b, F.lit(1e-300))).otherwise(0.0)
    return held.withColumn(into, F.when(b < float("inf"), score)).drop(*names)


def squared_silhouette(df: DataFrame, vector: str, label: str) -> DataFrame:
    scored = squared_per_row(df, vector, label, "_s")
    row = scored.agg(F.avg("_s").alias("s"), F.count_distinct(label).alias("k")).first()
    return _result(df, row["s"] if row["k"] > 1 else None, row["k"])


# ---- Euclidean distances ----------------------------------------------------------------
def _bounds(part: list):
    """A function of vectors and labels: per other cluster of the part, its bounds of the mean distance, as (least upper, candidates)."""
    labels = [r["_l"] for r in part]
    at = {a: i for i, a in enumerate(labels)}
    n = np.array([r["n"] for r in part], float)
    centre = np.array([r["s"] for r in part]) / n[:, None]
    spread = np.maximum(np.array([r["q"] for r in part]) / n - (centre * centre).sum(1), 0)

    def of(x: np.ndarray, label: list) -> tuple[np.ndarray, np.ndarray]:
        square = np.maximum((x * x).sum(1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(1), 0)
        # room for rounding, so that no cluster is left out by it
        slack = 1e-9 * ((x * x).sum(1)[:, None] + (centre * centre).sum(1) + spread)
        low, high = np.sqrt(np.maximum(square - slack, 0)), np.sqrt(square + spread + slack)
        own = np.array([at.get(a, -1) for a in label], int)
        rows = np.flatnonzero(own >= 0)
        low[rows, own[rows]] = high[rows, own[rows]] = np.inf
        return low, high
    return of, labels


def _least_upper(part: list):
    @F.arrow_udf("double")
    def least(v: pa.Array, label: pa.Array) -> pa.Array:
        of, _ = _bounds(part)
        return pa.array(of(distances.matrix(v), label.to_pylist())[1].min(1) if len(v) else [], pa.float64())
    return least


def _candidates(part: list):
    @F.arrow_udf("array<bigint>")
    def candidates(v: pa.Array, label: pa.Array, most: pa.Array) -> pa.Array:
        of, labels = _bounds(part)
        low = of(distances.matrix(v), label.to_pylist())[0] if len(v) else np.zeros((0, 0))
        keep = low <= most.to_numpy(zero_copy_only=False)[:, None]
        return pa.array([[labels[j] for j in np.flatnonzero(k)] for k in keep], pa.list_(pa.int64()))
    return candidates


def asked_clusters(rows: DataFrame, sums: DataFrame, dims: int, kind: str, cells: int = CLUSTER_CELLS) -> DataFrame:
    """(_id, _l, _v, other): every row with each cluster whose exact mean distance it needs.

    That is its own cluster, and the others that may be the nearest by their bounds.
    """
    parts = _parts(sums, dims, cells)
    limit = reduce(lambda a, b: F.least(a, b), [_least_upper(p)("_v", "_l") for p in parts])
    tagged = rows.select("_id", "_l", "_v", limit.alias("_limit"))
    picked = [_candidates(p)("_v", "_l", "_limit") for p in parts]
    own = F.array(F.col("_l").cast("bigint"))
    return tagged.select("_id", "_l", "_v", F.explode(F.concat(own, *picked)).alias("other")).withColumn(
        "other", F.col("other").cast(kind))


def euclidean_silhouette(df: DataFrame, vector: str, label: str, noise: int | None = -1,
                         block: int | None = None) -> DataFrame:
    """Mean silhouette with Euclidean distances over every row given; labels are whole numbers.

    Exact sums cost rows asked times rows of a cluster. They are made in blocks, so a task holds two:
    a row is shuffled once per block of each cluster it asks for, and once per block of the rows that
    ask for its own, all by groups of (cluster, block, block). Blocks grow with the rows from ``BLOCK``
    to ``distances.MOST_ROWS``, unless ``block`` is given. ``noise`` rows take no part (None keeps them
    as a cluster of their own).
    """
    rows = df.filter(F.col(label).isNotNull())
    rows = rows if noise is None else rows.filter(F.col(label) != noise)
    kind = dict(rows.dtypes)[label]
    rows = durable(rows.select(F.monotonically_increasing_id().alias("_id"), F.col(label).alias("_l"),
                               distances.plain(vector, dict(rows.dtypes)[vector]).alias("_v")))
    first = rows.select(F.size("_v").alias("d")).first()
    dims = first["d"] if first else 0
    sums = durable(cluster_sums(rows, "_v", "_l", dims))
    clusters = sums.count()
    if clusters < 2:
        return _result(df, None, clusters)
    asked = durable(asked_clusters(rows, sums, dims, kind))
    # blocks of a cluster's rows, and of the rows that ask for it
    size = (sums.select(F.col("_l").alias("other"), F.col("n").alias("_n"))
            .join(asked.groupBy("other").agg(F.count(F.lit(1)).alias("_m")), "other"))
    if block is None:
        pairs = size.agg(F.sum(F.col("_n").cast("double") * F.col("_m"))).first()[0]
        block = distances.block_rows(pairs, BLOCK)
    size = pin_small(size.select("other", "_n", F.ceil(F.col("_n") / block).cast("int").alias("_targets"),
                                 F.ceil(F.col("_m") / block).cast("int").alias("_askers")))

    def dealt(count: str):
        return F.pmod(F.xxhash64("_id"), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = asked.join(size, "other").select("other", "_id", "_l", "_v", dealt("_askers").alias("_a"), every("_targets").alias("_b"))
    right = rows.withColumnRenamed("_l", "other").join(size, "other").select(
        "other", F.col("_id").alias("_t"), F.col("_v").alias("_w"), dealt("_targets").alias("_b"), every("_askers").alias("_a"))

    def add_up(asking: pa.Table, held: pa.Table) -> pa.Table:
        x, y = distances.matrix(asking.column("_v")), distances.matrix(held.column("_w"))
        if not len(x) or not len(y):
            return pa.table({"id": [], "own": [], "other": [], "s": []}, schema=schema)
        s = distances.distance_sums(x, y)
        return pa.table([asking.column("_id"), asking.column("_l"), asking.column("other"), pa.array(s)], schema=schema)

    arrow = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}[kind]
    schema = pa.schema([("id", pa.int64()), ("own", arrow), ("other", arrow), ("s", pa.float64())])
    keys = ["other", "_a", "_b"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(add_up, f"id long, own {kind}, other {kind}, s double")
    per = met.groupBy("id", "own", "other").agg(F.sum("s").alias("s")).join(size, "other")
    same = F.col("own") == F.col("other")
    each = per.groupBy("id").agg(
        F.max(F.when(same, F.col("s") / F.greatest(F.col("_n") - 1, F.lit(1)))).alias("a"),
        F.max(F.when(same, F.col("_n"))).alias("n"), F.min(F.when(~same, F.col("s") / F.col("_n"))).alias("b"))
    score = F.when(F.col("n") > 1, (F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-300))).otherwise(0.0)
    return _result(df, each.agg(F.avg(score).alias("s")).first()["s"], clusters)
