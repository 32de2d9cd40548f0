"""Isolation forest (Liu, Ting, Zhou 2008) that comes out the same everywhere.

A tree sees a fixed number of rows, drawn by digest. All trees grow together, a level at a
time: one aggregation gives every open node its rows and the range of each feature, and the
feature and cut of a node come from the digest of seed, tree and node number. So a forest is
a table (tree, node, feature, threshold, path) that any layout, or SQL, gives again. Its size
depends on the trees only; it goes to every task, and rows are scored in Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kerbside.functions import columns as fc
from kerbside.session import durable

SPARE = 1.5       # rows drawn for a tree, per row it needs


def mean_path(n: float) -> float:
    """Average path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


@dataclass
class IsolationForestModel:
    trees: list[tuple]      # arrays per tree
    features: list[str]
    sample: int
    table: DataFrame | None = None      # (tree, node, feature, threshold, path)

    def transform(self, df: DataFrame, score: str = "anomaly_score") -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(self.trees)
        norm = mean_path(self.sample) or 1.0

        @F.pandas_udf(DoubleType())
        def one(cells: pd.DataFrame) -> pd.Series:
            x = cells.to_numpy(dtype=float)
            at = np.arange(len(x))
            total = np.zeros(len(x))
            for feature, threshold, left, right, path in held.value:
                node = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = feature[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    below = x[at, np.maximum(f, 0)] < threshold[node]
                    node = np.where(inner, np.where(below, left[node], right[node]), node)
                total += path[node]
            return pd.Series(np.power(2.0, -(total / max(len(held.value), 1)) / norm))
        cells = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in self.features])
        return df.withColumn(score, one(cells))

    def inliers(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return self.transform(df, "_score").filter(F.col("_score") <= threshold).drop("_score")


def fit(df: DataFrame, features: list[str], keys: list[str], trees: int = 1000, sample: int = 256,
        seed: int = 42) -> IsolationForestModel:
    rows = df.select(fc.shuffle_key(keys, seed).alias("_h"),
                     *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(f"c{i}") for i, c in enumerate(features)])
    n = rows.count()
    size = min(sample, n)
    wanted = SPARE * size + 64
    if n <= wanted:
        # fewer rows than one tree may want: all of them, for every tree
        drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    else:
        # Any row may be drawn for any tree. Each round sends a row to one tree or to none, by digest.
        rounds = math.ceil(trees * wanted / n)
        drawn = rows.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
        drawn = drawn.filter(fc.hash_unit(F.md5(F.concat("_h", F.col("_r").cast("string")))) < trees * wanted / n / rounds)
        to_tree = fc.hash_unit(F.md5(F.concat_ws("|", "_h", F.col("_r").cast("string"))))
        drawn = (drawn.withColumn("tree", F.floor(to_tree * trees).cast("int")).drop("_r").dropDuplicates(["tree", "_h"]))
    drawn = drawn.withColumn("_o", F.md5(F.concat_ws("|", "_h", "tree")))
    w = W.partitionBy("tree").orderBy("_o", "_h")
    drawn = drawn.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= size).drop("_rn", "_o", "_h")
    table = grow(drawn, [f"c{i}" for i in range(len(features))], math.ceil(math.log2(max(size, 2))), seed)
    return IsolationForestModel(arrays(table), features, size, table)


def grow(drawn: DataFrame, columns: list[str], limit: int, seed: int) -> DataFrame:
    """(tree, node, feature, threshold, path) from rows (tree, columns...); node 1 is the root, the
    children of n are 2n and 2n + 1; feature -1 marks a leaf, whose ``path`` is its path length."""
    rows = durable(drawn.withColumn("node", F.lit(1).cast("bigint")))
    levels = []
    for depth in range(limit + 1):
        span = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.array(*[
            F.struct(F.lit(i).alias("feature"), F.min(c).alias("low"), F.max(c).alias("high")) for i, c in enumerate(columns)]).alias("spans"))
        nodes = durable(_cuts(span, depth, limit, seed))
        levels.append(nodes)
        if depth == limit:
            break
        value = F.get(F.array(*columns), F.col("feature"))
        down = rows.join(nodes.filter("feature >= 0").select("tree", "node", "feature", "threshold"), ["tree", "node"])
        rows = durable(down.withColumn("node", F.col("node") * 2 + F.when(value < F.col("threshold"), 0).otherwise(1)).select(
            "tree", *columns, "node"))
        if not rows.limit(1).count():
            break
    return reduce(lambda a, b: a.unionByName(b), levels)


def _cuts(span: DataFrame, depth: int, limit: int, seed: int) -> DataFrame:
    """Feature and cut of each node, by its digest; a leaf if there is nothing to cut."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("tree").cast("string"), F.col("node").cast("string")))
    first = F.conv(F.substring("_d", 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
    tagged = span.withColumn("_d", digest).withColumn("_open", F.filter("spans", lambda s: s["high"] > s["low"]))
    pick = F.get("_open", F.floor(fc.hash_unit(F.col("_d")) * F.size("_open")).cast("int"))
    # above the low end, at most the high end: both sides get a row
    cut = F.least(F.col("_s.high"), F.col("_s.low") + (1 - first) * (F.col("_s.high") - F.col("_s.low")))
    inner = (F.size("_open") > 0) & (F.col("n") > 1) & F.lit(depth < limit)
    n = F.col("n").cast("double")
    spare = F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(2 * (F.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n)
    return tagged.withColumn("_s", pick).select(
        "tree", "node", F.when(inner, F.col("_s.feature")).otherwise(-1).alias("feature"),
        F.when(inner, F.when(cut <= F.col("_s.low"), F.col("_s.high")).otherwise(cut)).otherwise(0.0).alias("threshold"),
        F.when(inner, 0.0).otherwise(depth + spare).alias("path"))


def arrays(table: DataFrame) -> list[tuple]:
    """Per tree (feature, threshold, left, right, path), children by place, for scoring."""
    held: dict[int, list] = {}
    for r in table.orderBy("tree", "node").toArrow().to_pylist():
        held.setdefault(r["tree"], []).append(r)
    out = []
    for _, nodes in sorted(held.items()):
        at = {r["node"]: i for i, r in enumerate(nodes)}
        child = [np.array([at.get(2 * r["node"] + side, -1) for r in nodes], np.int64) for side in (0, 1)]
        out.append((np.array([r["feature"] for r in nodes]), np.array([r["threshold"] for r in nodes], float), *child,
                    np.array([r["path"] for r in nodes], float)))
    return out
