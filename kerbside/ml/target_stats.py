"""Categories as numbers: ordered target statistics.

A category's value becomes, per class, the share of that class among rows of the same value, drawn
towards the overall share by a prior. For training a row sees only the rows that come before it in
digest order, never itself, so a model cannot read its own target off the encoding; for scoring the
shares of all training rows are used. Values that were not seen have the overall share.

Running counts go by (value, digest range): the ranges' totals are aggregated before the shuffle and
summed up as a small table, and only rows of one range are sorted together, so a value that a third of
the rows share is spread over many tasks. All categories are encoded in one pass over long rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.ml.prepare import MAX_CATEGORIES
from kerbside.operators.ordered import hash_bucket, hash_digits, range_offsets
from kerbside.operators.profile import long_form
from kerbside.session import match_null_safe

PRIOR = 1.0         # weight of the overall share, in rows


def names(column: str, classes: list) -> list[str]:
    return [f"{column}_share{i}" for i in range(len(classes))]


def class_shares(df: DataFrame, target: str, classes: list) -> list[float]:
    """Overall share of each class, over rows with a known target."""
    row = df.agg(F.count(target).alias("n"), *[F.count(F.when(F.col(target) == c, 1)).alias(f"n{i}")
                                               for i, c in enumerate(classes)]).first()
    return [row[f"n{i}"] / row["n"] if row["n"] else 0.0 for i in range(len(classes))]


def _share(hits: Column, rows: Column, overall: float, prior: float) -> Column:
    return (hits + prior * overall) / (rows + prior)


def _hits(target: str, classes: list) -> dict[str, Column]:
    return {"rows": F.count(target)} | {f"hits{i}": F.count(F.when(F.col(target) == c, 1)) for i, c in enumerate(classes)}


def category_shares(df: DataFrame, columns: list[str], target: str, classes: list,
                    prior: float = PRIOR) -> DataFrame:
    """(column, value, rows, share0, ...) over all rows, one row per value (NULL is one)."""
    overall = class_shares(df, target, classes)
    counts = long_form(df, columns, "string", [target]).groupBy("column", "value").agg(
        *[c.alias(n) for n, c in _hits(target, classes).items()])
    return counts.select("column", "value", "rows", *[
        _share(F.col(f"hits{i}"), F.col("rows"), p, prior).alias(f"share{i}") for i, p in enumerate(overall)])


def ordered_shares(df: DataFrame, columns: list[str], target: str, classes: list, keys: list[str],
                   seed=42, prior: float = PRIOR, rows: int | None = None) -> DataFrame:
    """``df`` with ``<column>_share<i>``: per class the share among earlier rows of the same value.

    ``keys`` name a row; earlier is by the digest of the keys and ``seed``, then by the keys. A row
    with an unknown target is encoded and counts for nobody.
    """
    overall = class_shares(df, target, classes)
    digits = hash_digits(df.count() if rows is None else rows)
    tagged = df.select(*keys, target, *columns).withColumn("_h", fc.shuffle_key(keys, seed))
    cells = long_form(tagged, columns, "string", [*keys, "_h", target]).withColumn("_bucket", hash_bucket("_h", digits))
    hits = _hits(target, classes)
    offsets = range_offsets(cells, ["column", "value"], "_bucket", hits)
    joined = match_null_safe(cells, offsets, ["column", "value", "_bucket"])
    before = W.partitionBy("column", "value", "_bucket").orderBy("_h", *keys).rowsBetween(W.unboundedPreceding, -1)
    # sums over the rows before, which are none for the first
    seen = {n: F.coalesce(c.over(before), F.lit(0)) + F.col(f"{n}_before") for n, c in hits.items()}
    encoded = joined.select(*keys, "column", *[_share(seen[f"hits{i}"], seen["rows"], p, prior).alias(f"share{i}")
                                               for i, p in enumerate(overall)])
    wide = encoded.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col(f"share{i}"))).alias(n)
                                        for c in columns for i, n in enumerate(names(c, classes))])
    return df.join(wide, keys)


def with_shares(df: DataFrame, shares: DataFrame, columns: list[str], overall: list[float]) -> DataFrame:
    """``df`` with ``<column>_share<i>`` from the table of ``category_shares``, however many values it has."""
    out = df
    for c in columns:
        named = names(c, overall)
        own = shares.filter(F.col("column") == c).select(
            F.col("value").alias("_value"), F.lit(True).alias("_met"), *[F.col(f"share{i}").alias(n) for i, n in enumerate(named)])
        out = out.join(own, F.col(c).cast("string").eqNullSafe(F.col("_value")), "left").withColumns(
            {n: F.when(F.col("_met"), F.col(n)).otherwise(p) for n, p in zip(named, overall)}).drop("_value", "_met")
    return out


def share_stages(df: DataFrame, columns: list[str], target: str, classes: list, prior: float = PRIOR,
                 most: int = MAX_CATEGORIES) -> list:
    """Saveable stages that add ``<column>_share<i>`` of all training rows; projections only.

    A column of more than ``most`` values is an error here: use ``with_shares``.
    """
    overall = class_shares(df, target, classes)
    known: dict[str, list] = {c: [] for c in columns}
    for c in columns:
        rows = category_shares(df, [c], target, classes, prior).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{c} has more than {most} values: join them with with_shares")
        known[c] = sorted(rows, key=lambda r: (r["value"] is not None, r["value"] or ""))
    stages = []
    for c in columns:
        met = [r for r in known[c] if r["value"] is not None]
        missing = next((r for r in known[c] if r["value"] is None), None)
        # arrays in the order of the labels; unseen values are past the last label
        slots = [[*(r[f"share{i}"] for r in met), p] for i, p in enumerate(overall)]
        null = [missing[f"share{i}"] if missing else p for i, p in enumerate(overall)]
        if met:
            stages += [SQLTransformer(statement=f"SELECT *, CAST(`{c}` AS STRING) AS `{c}_text` FROM __THIS__"),
                       StringIndexerModel.from_labels([r["value"] for r in met], inputCol=f"{c}_text",
                                                      outputCol=f"{c}_slot", handleInvalid="keep")]
        place = f"CAST(`{c}_slot` AS INT) + 1" if met else "1"
        parts = [f"IF(`{c}` IS NULL, {null[i]!r}D, ELEMENT_AT(ARRAY({', '.join(f'{x!r}D' for x in slots[i])}), {place})) AS `{n}`"
                 for i, n in enumerate(names(c, classes))]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"))
    return stages


def encoder(df: DataFrame, columns: list[str], target: str, classes: list, prior: float = PRIOR,
            most: int = MAX_CATEGORIES) -> PipelineModel:
    return PipelineModel(share_stages(df, columns, target, classes, prior, most))
