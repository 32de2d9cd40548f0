"""Turning columns into a feature vector; every encoder is a saveable PipelineModel."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel,
                                VectorAssembler, VectorSlicer)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CATEGORIES = 10_000     # default of ``most``: slots a category may take up in the vector


def domain(df: DataFrame, column: str, most: int = MAX_CATEGORIES) -> list[str]:
    """Known values of a column as text, in the column's own order (numbers as numbers).

    More than ``most`` values are an error: every value is a slot or a label of the saved model.
    """
    rows = (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)))
            .orderBy(column).limit(most + 1).select(F.col(column).cast("string").alias("v")).collect())
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values: not a category")
    return [r["v"] for r in rows]


def _run(stages: list, df: DataFrame) -> DataFrame:
    for s in stages:
        df = s.transform(df)
    return df


def one_hot(df: DataFrame, column: str, into: str, most: int = MAX_CATEGORIES) -> list:
    """0/1 per category without the first one; unknown values give zeros only."""
    known = domain(df, column, most)
    # Reverse order puts the first category last, next to the slot of unknown values.
    index = StringIndexerModel.from_labels(known[::-1], inputCol=f"{column}_text", outputCol=f"{column}_ix",
                                           handleInvalid="keep")
    text = SQLTransformer(statement=f"SELECT *, CAST(`{column}` AS STRING) AS `{column}_text` FROM __THIS__")
    if len(known) < 2:
        return []
    encoder = OneHotEncoder(inputCol=f"{column}_ix", outputCol=f"{column}_hot", dropLast=False)
    fitted = encoder.fit(_run([text, index], df.limit(1)))
    cut = VectorSlicer(inputCol=f"{column}_hot", outputCol=into, indices=list(range(len(known) - 1)))
    return [text, index, fitted, cut]


def ordinal(df: DataFrame, column: str, into: str, values: list | None = None, most: int = MAX_CATEGORIES) -> list:
    """Position in the sorted (or given) domain, -1 for unknown values."""
    known = domain(df, column, most) if values is None else list(dict.fromkeys(str(v) for v in values))
    if not known:
        return [SQLTransformer(statement=f"SELECT *, -1.0D AS `{into}` FROM __THIS__")]
    text = SQLTransformer(statement=f"SELECT *, CAST(`{column}` AS STRING) AS `{into}_text` FROM __THIS__")
    index = StringIndexerModel.from_labels(known, inputCol=f"{into}_text", outputCol=f"{into}_ix", handleInvalid="keep")
    # unknown and missing values have the index past the last label
    return [text, index, SQLTransformer(statement=(
        f"SELECT *, IF(`{into}_ix` < {len(known)}, `{into}_ix`, -1.0D) AS `{into}` FROM __THIS__"))]


def label_index(df: DataFrame, column: str, into: str):
    """Fitted indexer in alphabetical order."""
    return StringIndexer(inputCol=column, outputCol=into, stringOrderType="alphabetAsc").fit(df)


def scaled(df: DataFrame, columns: list[str], how: str) -> list:
    """``standard``: zero mean, unit population deviation; ``minmax``: 0..1.  Columns without
    spread become 0."""
    if how == "standard":
        stats = df.agg(*[F.struct(F.avg(c).alias("a"), F.stddev_pop(c).alias("b")).alias(c) for c in columns]).first()
        shift = {c: (stats[c]["a"] or 0.0, stats[c]["b"] or 0.0) for c in columns}
    else:
        stats = df.agg(*[F.struct(F.min(c).cast("double").alias("a"), F.max(c).cast("double").alias("b")).alias(c) for c in columns]).first()
        shift = {c: (stats[c]["a"] or 0.0, (stats[c]["b"] or 0.0) - (stats[c]["a"] or 0.0)) for c in columns}
    exprs = ", ".join(f"(CAST(`{c}` AS DOUBLE) - ({m!r}D)) / {s or 1.0!r}D AS `{c}_scaled`" for c, (m, s) in shift.items())
    return [SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")]


def fit_encoder(df: DataFrame, one_hots: list[str] = (), ordinals: dict | list[str] = (),
                numeric: list[str] = (), scale: str | None = None, vector: str = "features",
                most: int = MAX_CATEGORIES) -> PipelineModel:
    """Encoder of all columns into one vector; feature names are in the vector's metadata."""
    stages, inputs, helpers = [], [], []
    for c in one_hots:
        part = one_hot(df, c, f"{c}_cat", most)
        stages += part
        if part:
            inputs.append(f"{c}_cat")
            helpers += [f"{c}_text", f"{c}_ix", f"{c}_hot", f"{c}_cat"]
    domains = ordinals if isinstance(ordinals, dict) else {c: None for c in ordinals}
    for c, values in domains.items():
        stages += ordinal(df, c, f"{c}_ord", values, most)
        inputs.append(f"{c}_ord")
        helpers.append(f"{c}_ord")
    if numeric:
        if scale:
            stages += scaled(df, list(numeric), scale)
            inputs += [f"{c}_scaled" for c in numeric]
            helpers += [f"{c}_scaled" for c in numeric]
        else:
            inputs += list(numeric)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=vector, handleInvalid="keep"))
    return PipelineModel(stages)


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of the vector's slots from its metadata."""
    meta = df.schema[vector].metadata.get("ml_attr", {})
    slots = [a for group in meta.get("attrs", {}).values() for a in group]
    names = {a["idx"]: a.get("name", str(a["idx"])) for a in slots}
    return [names.get(i, str(i)) for i in range(meta.get("num_attrs", len(names)))]
