"""Severity models out of MLlib parts.

A fitted model is a chain of MLlib models whose outputs are combined by column
expressions into an array of class probabilities (or decision values) and a prediction.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.ml import target_stats
from kerbside.ml.prepare import feature_names
from kerbside.operators.ordered import undersample
from kerbside.operators.profile import with_class_weight

WITH_SHARES = "_features_with_shares"


@dataclass
class SeverityModel:
    """``kind`` says how the parts combine: decision, average, one_vs_rest or two_stage."""
    pipeline: PipelineModel
    kind: str
    classes: list[int]
    encoder: PipelineModel | None = None       # stages of the model's own, before its parts

    def metadata(self) -> dict:
        return {"kind": self.kind, "classes": self.classes}

    def stages(self) -> list:
        """All stages in order, to be saved as one pipeline."""
        return [*(self.encoder.stages if self.encoder else []), *self.pipeline.stages]

    @staticmethod
    def of_stages(stages: list, kind: str, classes: list[int], parts: int | None = None) -> SeverityModel:
        own = len(stages) - (len(stages) if parts is None else parts)
        return SeverityModel(PipelineModel(stages[own:]), kind, classes, PipelineModel(stages[:own]) if own else None)

    def _part(self, i: int):
        return vector_to_array(f"_prob{i}")

    def transform(self, df: DataFrame) -> DataFrame:
        own = self.encoder.transform(df) if self.encoder else df
        out = self.pipeline.transform(own)
        n = len(self.pipeline.stages)
        if self.kind == "decision":
            values = F.array(*[F.col(f"_pred{i}") for i in range(n)])
        elif self.kind == "average":
            parts = [self._part(i) for i in range(n)]
            total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts)
            values = fc.unit_sum(F.transform(total, lambda p: p / F.lit(float(n))))
        elif self.kind == "one_vs_rest":
            values = fc.unit_sum(F.array(*[self._part(i)[1] for i in range(n)]))
        else:
            values = fc.two_stage_probabilities(self._part(0)[1], self._part(1)[1])
        helpers = [f"{p}{i}" for i in range(n) for p in ("_pred", "_raw", "_prob")]
        column = "scores" if self.kind == "decision" else "probability"
        classes = F.array(*[F.lit(c) for c in self.classes])
        return (out.withColumn(column, values)
                .withColumn("prediction", F.element_at(classes, fc.arg_max(F.col(column)) + 1))
                .drop(*helpers, *[c for c in own.columns if c not in df.columns]))

    def importance(self, encoded: DataFrame, vector: str = "features", top: int = 40) -> DataFrame:
        """(feature, importance): mean over the parts; linear parts sum |coefficient| over
        the classes and zeros are left out."""
        if self.encoder:
            encoded, vector = self.encoder.transform(encoded), WITH_SHARES
        names = feature_names(encoded, vector)
        stages = self.pipeline.stages
        if self.kind == "decision":
            arrays = [[abs(v) for v in m.coefficients.toArray()] for m in stages]
            totals = [sum(a[i] for a in arrays) for i in range(len(arrays[0]))]
        else:
            arrays = [m.featureImportances.toArray() for m in stages]
            totals = [float(sum(a[i] for a in arrays)) / len(arrays) for i in range(len(arrays[0]))]
        names = names if len(names) == len(totals) else [f"f{i}" for i in range(len(totals))]
        rows = [(n, float(v)) for n, v in zip(names, totals) if v or self.kind != "decision"]
        table = encoded.sparkSession.createDataFrame(rows, "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature").limit(top)


def _columns(i: int) -> dict:
    return {"predictionCol": f"_pred{i}", "rawPredictionCol": f"_raw{i}", "probabilityCol": f"_prob{i}"}


def ridge(df: DataFrame, target: str, classes: list[int], alpha: float = 1.5,
          vector: str = "features") -> SeverityModel:
    """Least squares with penalty alpha on -1/+1 targets, one fit per class; highest value wins."""
    counts = {r[0]: r[1] for r in df.groupBy(target).agg(F.count(F.lit(1))).collect()}
    n = sum(counts.values())
    parts = []
    for i, c in enumerate(classes):
        share = counts.get(c, 0) / n
        # The solver divides the penalty by the target's deviation.
        spread = 2 * (share * (1 - share)) ** 0.5
        rows = df.withColumn("_y", F.when(F.col(target) == c, 1.0).otherwise(-1.0))
        fit = LinearRegression(featuresCol=vector, labelCol="_y", predictionCol=f"_pred{i}", regParam=alpha / n * spread,
                               elasticNetParam=0.0, standardization=False, solver="normal", maxIter=1)
        parts.append(fit.fit(rows))
    return SeverityModel(PipelineModel(parts), "decision", classes)


def random_forest(df: DataFrame, target: str, classes: list[int], trees: int = 300, depth: int = 15,
                  weights: dict | None = None, balanced: bool = True, seed: int = 42, bins: int = 64,
                  min_leaf: int = 1, vector: str = "features") -> SeverityModel:
    """Forest with balanced class weights, times a multiplier per class."""
    rows = with_class_weight(df, target, "_w", weights) if balanced else df.withColumn("_w", F.lit(1.0))
    fit = RandomForestClassifier(featuresCol=vector, labelCol=target, weightCol="_w", numTrees=trees, maxDepth=depth,
                                 maxBins=bins, minInstancesPerNode=min_leaf, seed=seed, **_columns(0))
    return SeverityModel(PipelineModel([fit.fit(rows)]), "average", classes)


def decision_tree(df: DataFrame, target: str, classes: list[int], depth: int = 5, bins: int = 64,
                  seed: int = 42, vector: str = "features") -> SeverityModel:
    fit = DecisionTreeClassifier(featuresCol=vector, labelCol=target, maxDepth=depth, maxBins=bins, seed=seed, **_columns(0))
    return SeverityModel(PipelineModel([fit.fit(df)]), "average", classes)


def balanced_forest(df: DataFrame, target: str, classes: list[int], keys: list[str], draws: int = 10,
                    trees: int = 1000, depth: int = 20, seed: int = 42, bins: int = 64, min_leaf: int = 1,
                    vector: str = "features") -> SeverityModel:
    """Forest whose trees see equally many rows of every class.

    The trees are shared out over several balanced draws, each as large as the data
    allows; probabilities are averaged.
    """
    parts = []
    for i in range(draws):
        rows = undersample(df, target, keys, seed + i)
        fit = RandomForestClassifier(featuresCol=vector, labelCol=target, numTrees=max(1, trees // draws), maxDepth=depth,
                                     maxBins=bins, minInstancesPerNode=min_leaf, seed=seed + i, **_columns(i))
        parts.append(fit.fit(rows))
    return SeverityModel(PipelineModel(parts), "average", classes)


def _boosted(rows: DataFrame, label: str, i: int, rounds: int, depth: int, step: float, bins: int,
             min_leaf: int, seed: int, vector: str):
    weighted = with_class_weight(rows, label, "_w")
    fit = GBTClassifier(featuresCol=vector, labelCol=label, weightCol="_w", predictionCol=f"_pred{i}", maxIter=rounds,
                        maxDepth=depth, stepSize=step, maxBins=bins, minInstancesPerNode=min_leaf, seed=seed)
    return fit.setRawPredictionCol(f"_raw{i}").setProbabilityCol(f"_prob{i}").fit(weighted)


def boosted(df: DataFrame, target: str, classes: list[int], rounds: int = 100, depth: int = 6,
            step: float = 0.1, bins: int = 64, min_leaf: int = 1, seed: int = 42,
            vector: str = "features", categories: list[str] = (), keys: list[str] = (),
            prior: float = target_stats.PRIOR) -> SeverityModel:
    """Boosted trees per class against the rest, balanced, normalised over the classes.

    ``categories`` are columns of ``df`` taken as they are: the trees see ordered target statistics
    of them (``keys`` name a row for the order), a report the shares of all training rows.
    """
    encoder = None
    if categories:
        shares = [n for c in categories for n in target_stats.names(c, classes)]
        # the length of a vector without metadata is taken from a row, which must be whole
        known = "num_attrs" in df.schema[vector].metadata.get("ml_attr", {})
        joint = VectorAssembler(inputCols=[vector, *shares], outputCol=WITH_SHARES, handleInvalid="keep" if known else "error")
        encoder = PipelineModel([*target_stats.share_stages(df, list(categories), target, classes, prior), joint])
        df = joint.transform(target_stats.ordered_shares(df, list(categories), target, classes, list(keys), seed, prior))
        vector = WITH_SHARES
    parts = [_boosted(df.withColumn("_y", F.when(F.col(target) == c, 1.0).otherwise(0.0)), "_y", i, rounds,
                      depth, step, bins, min_leaf, seed, vector) for i, c in enumerate(classes)]
    return SeverityModel(PipelineModel(parts), "one_vs_rest", classes, encoder)


def two_stage(df: DataFrame, target: str, rounds: int = 100, depth: int = 6, step: float = 0.1,
              bins: int = 64, min_leaf: int = 1, seed: int = 42, vector: str = "features") -> SeverityModel:
    """Injured or not, then severe or not among the injured."""
    injured = df.withColumn("_y", F.when(F.col(target) >= 1, 1.0).otherwise(0.0))
    severe = df.filter(F.col(target) >= 1).withColumn("_y", F.when(F.col(target) == 2, 1.0).otherwise(0.0))
    parts = [_boosted(rows, "_y", i, rounds, depth, step, bins, min_leaf, seed, vector)
             for i, rows in enumerate((injured, severe))]
    return SeverityModel(PipelineModel(parts), "two_stage", [0, 1, 2])


def out_of_fold(df: DataFrame, fold: str, k: int, fit: Callable[[DataFrame], SeverityModel]) -> DataFrame:
    """Prediction for every row by the model fitted on the other folds."""
    parts = [fit(df.filter(F.col(fold) != f)).transform(df.filter(F.col(fold) == f)) for f in range(k)]
    return reduce(lambda a, b: a.unionByName(b), parts)
