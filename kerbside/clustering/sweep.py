"""Trying several algorithms and parameters, keeping the best of each."""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.clustering.silhouette import squared_silhouette
from kerbside.operators.evaluate import best_per_group

ALGORITHMS = {"KMeans": KMeans, "BisectingKMeans": BisectingKMeans}


def vector_labels(df: DataFrame, vector: str, algorithm: str, k: int, label: str, seed: int = 42,
                  max_iter: int = 20) -> DataFrame:
    """Cluster rows by an array column."""
    estimator = ALGORITHMS[algorithm](k=k, seed=seed, maxIter=max_iter, featuresCol="_f", predictionCol=label)
    rows = df.withColumn("_f", array_to_vector(F.col(vector).cast("array<double>")))
    return estimator.fit(rows).transform(rows).drop("_f")


def sweep(df: DataFrame, vector: str, ks: list[int], algorithms: list[str] = ("KMeans", "BisectingKMeans"),
          seed: int = 42) -> DataFrame:
    """(algorithm, parameter, silhouette); the silhouette is over all rows."""
    rows = []
    for name in algorithms:
        for k in ks:
            labelled = vector_labels(df, vector, name, k, "_label", seed)
            score = squared_silhouette(labelled, vector, "_label").first()["silhouette"]
            rows.append((name, k, score))
    return df.sparkSession.createDataFrame(rows, "algorithm string, parameter int, silhouette double")


def best_parameters(results: DataFrame) -> DataFrame:
    return best_per_group(results, "algorithm", "silhouette", [F.asc("parameter")])
