"""Hyper-parameter search: seeded draws, folds by stratified digest order, macro F1."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.ml.models import SeverityModel
from kerbside.operators.evaluate import class_report
from kerbside.operators.ordered import stratified_folds
from kerbside.session import durable


def draw(space: dict, n: int, seed: int = 42) -> list[dict]:
    """``n`` points: ("int", low, high), ("log", low, high), ("real", low, high) or a list."""
    rng = random.Random(seed)

    def one(spec):
        if isinstance(spec, list):
            return rng.choice(spec)
        kind, low, high = spec
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)
    return [{k: one(v) for k, v in space.items()} for _ in range(n)]


def macro_f1(scored: DataFrame, target: str, classes: list[int]) -> float:
    return class_report(scored, target, "prediction", classes).filter("label = 'macro avg'").first()["f1"]


def search(df: DataFrame, target: str, classes: list[int], keys: list[str],
           fit: Callable[..., SeverityModel], points: list[dict], k: int = 3, seed: int = 42,
           parallelism: int | None = None) -> DataFrame:
    """(rank, params, macro_f1, fold scores), best first.

    Folds are written once; ``parallelism`` fits run at the same time, by default the folds of a point.
    """
    folded = durable(stratified_folds(df, target, keys, k, seed))

    def score(params, f):
        model = fit(folded.filter(F.col("fold") != f), target, classes, **params)
        return macro_f1(model.transform(folded.filter(F.col("fold") == f)), target, classes)
    with ThreadPoolExecutor(parallelism or k) as pool:
        flat = list(pool.map(lambda job: score(*job), [(p, f) for p in points for f in range(k)]))
    scores = [flat[i * k:(i + 1) * k] for i in range(len(points))]
    rows = sorted(((json.dumps(p, sort_keys=True), sum(s) / k, s) for p, s in zip(points, scores)),
                  key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(rows)],
        "rank int, params string, macro_f1 double, fold_scores array<double>")
