"""Column profiles, counts and distributions.

Profiles reduce to one long aggregation ``(column, value) -> n``: partial counts are
made before the shuffle, a frequent value costs one row per task, and no task ever
holds all distinct values of a column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.operators.ordered import range_offsets, with_value_bucket
from kerbside.session import durable, match_null_safe, pin_small

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [n for n, k in df.dtypes if k in NUMERIC or k.startswith("decimal")]


def without_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN of the named columns turned into NULL."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns if kinds[c] in ("double", "float")})


def long_form(df: DataFrame, columns: list[str], kind: str = "string",
              keys: list[str] | None = None) -> DataFrame:
    """(keys..., column, value): one row per cell."""
    cells = df.select(*(keys or []), *[F.col(c).cast(kind).alias(c) for c in columns])
    return cells.unpivot(keys or [], columns, "column", "value")


def value_table(df: DataFrame, columns: list[str], kind: str = "string",
                keys: list[str] | None = None) -> DataFrame:
    """(keys..., column, value, n)."""
    return long_form(df, columns, kind, keys).groupBy(*(keys or []), "column", "value").agg(
        F.count(F.lit(1)).alias("n"))


# ---- counts -----------------------------------------------------------------------
def value_counts(df: DataFrame, column: str, keep_null: bool = False,
                 share: bool = False) -> DataFrame:
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if not share:
        return counts
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values (NULL too) with their percentage."""
    counts = value_counts(df, column, keep_null=True, share=True)
    return (counts.select(column, "n", (F.col("share") * 100).alias("pct"))
            .orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(n))


def inspect_column(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """One row: type, filled rows, rows, distinct values, values not among the top."""
    kind = dict(df.dtypes)[column]
    counts = value_counts(df, column, keep_null=True)
    row = counts.agg(F.sum("n").alias("rows"),
                     F.sum(F.when(F.col(column).isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
                     F.count(column).alias("distinct_values"),
                     F.count(F.lit(1)).alias("_groups"))
    return row.select(F.lit(column).alias("column"), F.lit(kind).alias("dtype"), "rows", "non_null",
                      "distinct_values",
                      F.greatest(F.lit(0), F.col("distinct_values")
                                 - F.least(F.lit(top), F.col("_groups"))).alias("other_values"))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """Key with the highest count (the smallest key among equals) and the count."""
    return (value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(1))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table with the row share: (a, b, n, share)."""
    counts = (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(a)))


def crosstab_wide(df: DataFrame, a: str, b: str, domain: list, percent: bool = False) -> DataFrame:
    """Contingency table with one column per value of ``b``; ``percent`` normalises rows."""
    counts = (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
              .groupBy(a).agg(*[F.count(F.when(F.col(b) == v, 1)).alias(str(v)) for v in domain]))
    if not percent:
        return counts
    total = sum((F.col(str(v)) for v in domain), F.lit(0))
    return counts.select(a, *[(F.col(str(v)) * 100.0 / F.nullif(total, F.lit(0))).alias(str(v))
                              for v in domain])


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count, percentage and the ratio largest / smallest class."""
    counts = value_counts(df, target, share=True)
    ratio = counts.agg((F.max("n") / F.min("n")).alias("r")).scalar()
    return counts.select(target, "n", (F.col("share") * 100).alias("pct"),
                         ratio.alias("imbalance_ratio"))


def class_weights(df: DataFrame, target: str, multipliers: dict | None = None) -> DataFrame:
    """Balanced weight rows / (classes * class rows), times a multiplier per class."""
    counts = value_counts(df, target)
    total = counts.agg(F.sum("n").alias("t")).scalar()
    classes = counts.agg(F.count(F.lit(1)).alias("k")).scalar()
    weight = total / (classes * F.col("n"))
    if multipliers:
        from kerbside.functions.columns import lookup
        weight = weight * lookup(target, {k: float(v) for k, v in multipliers.items()}, 1.0)
    return counts.select(target, "n", weight.alias("weight"))


def with_class_weight(df: DataFrame, target: str, into: str = "weight",
                      multipliers: dict | None = None) -> DataFrame:
    weights = class_weights(df, target, multipliers).select(target, F.col("weight").alias(into))
    return df.join(pin_small(weights), target)


def group_mean(df: DataFrame, by: str, value: str, at_least: int = 50) -> DataFrame:
    """Mean and count per group, groups with fewer known values left out."""
    return (df.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
            .filter(F.col("n") >= at_least))


def ordered_counts(df: DataFrame, key: Column, name: str) -> DataFrame:
    return (df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col(name).isNotNull()).orderBy(name))


# ---- missing values ---------------------------------------------------------------
def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with NULL: count and percentage, most affected first.  One pass."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    return (one.unpivot(["_rows"], df.columns, "column", "missing_count")
            .filter("missing_count > 0")
            .select("column", "missing_count",
                    (F.col("missing_count") * 100.0 / F.col("_rows")).alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "column"))


def not_reported(df: DataFrame, zero_is_missing: list[str] = (),
                 markers: dict[str, list[str]] | None = None) -> DataFrame:
    """How often each column holds something that means "nothing": NULL, blank, a point,
    -1, 0 where it means none, and extra markers.  Counts may overlap.  One pass."""
    markers = markers or {}
    pieces = []
    for c in df.columns:
        text = F.trim(F.col(c).cast("string"))
        number = text.try_cast("double")
        zero = (number == 0) if c in zero_is_missing else F.lit(False)
        extra = text.isin(markers[c]) if markers.get(c) else F.lit(False)
        tests = {"null": F.col(c).isNull(), "blank": text == "", "dot": text == ".",
                 "minus1": number == -1, "zero": zero, "extra": extra}
        pieces.append(F.struct(F.lit(c).alias("column"), *[
            F.count(F.when(t, 1)).alias(k) for k, t in tests.items()]).alias(c))
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*pieces).alias("_cells"))
    out = one.select("rows", F.inline("_cells"))
    total = F.col("null") + F.col("blank") + F.col("dot") + F.col("minus1") + F.col("zero") + F.col("extra")
    pct = F.when(F.col("rows") > 0, F.round(F.col("any_missing_like") * 100.0 / F.col("rows"), 2)).otherwise(0.0)
    return (out.withColumn("any_missing_like", total).withColumn("any_missing_like_pct", pct)
            .select("column", "rows", "null", "blank", "dot", "minus1", "zero", "extra",
                    "any_missing_like", "any_missing_like_pct")
            .orderBy(F.desc("any_missing_like_pct"), "column"))


def minus_one_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns that hold -1 and how often."""
    names = columns or numeric_columns(df)
    one = df.agg(*[F.count(F.when(F.col(c) == -1, 1)).alias(c) for c in names])
    return one.unpivot([], names, "column", "n").filter("n > 0")


# ---- numbers ----------------------------------------------------------------------
def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    by: list[str] | None = None, bits: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, long: (by..., column, prob, quantile).

    Selection instead of sorting: values are counted once, their images are cut by leading
    bits until no range holds many values, counts per range tell in which range each wanted
    rank lies, and only those ranges are read value by value.  Memory per task stays bounded
    for any number of rows and any shape of their distribution.
    """
    by = by or []
    cells = long_form(df, columns, "double", by).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = durable(cells.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("_c")))
    return counted_quantiles(counts, probs, by, bits)


def counted_quantiles(counts: DataFrame, probs: list[float], by: list[str] | None = None,
                      bits: int | None = None) -> DataFrame:
    """``exact_quantiles`` of a table (by..., column, value, _c) that has every value once; it is read a few times."""
    keys = [*(by or []), "column"]
    tagged = with_value_bucket(counts, keys, "value", bits)
    ranges = pin_small(range_offsets(tagged, keys, "_bucket", {"n": F.sum("_c")}, keep=True))
    totals = ranges.groupBy(*keys).agg(F.sum("n").alias("_total"))
    wanted = totals.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    rank = (F.col("_total") - 1) * F.col("prob")
    wanted = wanted.withColumns({"_low": F.floor(rank), "_high": F.ceil(rank),
                                 "_weight": rank - F.floor(rank)})
    wanted = wanted.withColumn("_rank", F.explode(F.array_distinct(F.array("_low", "_high"))))
    located = match_null_safe(wanted, ranges, keys).filter(
        (F.col("_rank") >= F.col("n_before")) & (F.col("_rank") < F.col("n_before") + F.col("n")))
    per_range = located.groupBy(*keys, "_bucket", "n_before").agg(F.collect_list(
        F.struct("prob", "_rank", "_low", "_weight")).alias("_wanted"))   # two ranks per prob
    per_value = match_null_safe(tagged, pin_small(per_range), [*keys, "_bucket"])
    w = W.partitionBy(*keys, "_bucket").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    hits = (per_value.withColumn("_upto", F.col("n_before") + F.sum("_c").over(w))
            .select(*keys, "value", "_upto", "_c", F.inline("_wanted"))
            .filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c"))))
    ends = hits.groupBy(*keys, "prob", "_weight").agg(
        F.min(F.when(F.col("_rank") == F.col("_low"), F.col("value"))).alias("_a"),
        F.max("value").alias("_b"))
    # equal ends (two infinities too) are the quantile; only different ones are interpolated
    return ends.select(*keys, "prob", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(
        F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_weight")).alias("quantile"))


def quantiles_wide(df: DataFrame, columns: list[str], probs: dict[str, float],
                   by: list[str] | None = None) -> DataFrame:
    """One row per (by..., column), one column per named quantile."""
    return _wide(exact_quantiles(df, columns, list(probs.values()), by), probs, by)


def _wide(long: DataFrame, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    return long.groupBy(*(by or []), "column").agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n)
        for n, p in probs.items()])


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per numeric column; NaN counts as missing."""
    names = columns or numeric_columns(df)
    quart = quantiles_wide(df, names, QUARTILES)
    return (_moments(df, names).join(quart, "column", "left")
            .select("column", "n", "mean", "std", "min", "q25", "q50", "q75", "max"))


def _moments(df: DataFrame, names: list[str]) -> DataFrame:
    """(column, n, mean, std, min, max) in one pass; NaN counts as missing."""
    df = without_nan(df, names)
    return df.agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max")) for c in names]).alias("_c")).select(F.inline("_c"))


def _summary(counts: DataFrame) -> DataFrame:
    """Per column: rows, missing rows, distinct values, top value (smallest among equals,
    NULL last) and its count; one aggregation over the value counts."""
    missing = F.when(F.col("value").isNull(), F.col("n")).otherwise(0)
    first = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").isNull().alias("u"), F.col("value").alias("v")))
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"), F.sum(missing).alias("missing_count"),
        F.count("value").alias("unique_count"), first.alias("_top")).withColumns(
        {"top": F.col("_top.v"), "freq": -F.col("_top.m")}).drop("_top")


def describe_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, distinct values, most frequent value and its count per column."""
    counts = value_table(df, columns).filter(F.col("value").isNotNull())
    return _summary(counts).select("column", F.col("rows").alias("count"),
                                   F.col("unique_count").alias("unique"), "top", "freq")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, missing %, distinct values, top value and its %, and numbers where numeric.

    A NULL that is the most frequent entry is reported as ``NaN``. The rows are read twice: once
    for the counts of all values, which give quartiles too, once for the moments.
    """
    counts = durable(value_table(df, df.columns))
    kinds = F.create_map(*[F.lit(x) for n, k in df.dtypes for x in (n, k)])
    base = _summary(counts).select(
        "column", kinds[F.col("column")].alias("dtype"),
        (F.col("missing_count") * 100.0 / F.col("rows")).alias("missing_pct"), "missing_count",
        "unique_count", F.coalesce("top", F.lit("NaN")).alias("top_value"),
        (F.col("freq") * 100.0 / F.col("rows")).alias("top_pct"))
    numeric = numeric_columns(df)
    if not numeric:
        return base
    number = F.col("value").cast("double")
    numbers = counts.filter(F.col("column").isin(numeric) & F.col("value").isNotNull() & ~F.isnan(number)).select(
        "column", number.alias("value"), F.col("n").alias("_c"))
    quart = _wide(counted_quantiles(numbers, list(QUARTILES.values())), QUARTILES)
    # a row per column on each side
    return base.join(F.broadcast(_moments(df, numeric).drop("n")), "column", "left").join(
        F.broadcast(quart), "column", "left").select(*base.columns, "mean", "std", "min", "q25", "q50", "q75", "max")


def quality_table(df: DataFrame) -> DataFrame:
    """Type, missing count, missing % and distinct values per column."""
    kinds = F.create_map(*[F.lit(x) for n, k in df.dtypes for x in (n, k)])
    counts = value_table(df, df.columns)
    return counts.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"),
        (F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) * 100.0
         / F.sum("n")).alias("missing_pct"),
        F.count("value").alias("unique_count")).withColumn("dtype", kinds[F.col("column")])


def histogram(df: DataFrame, column: str, bins: int | None = None, width: float | None = None,
              start: float | None = None) -> DataFrame:
    """Rows per bin: a number of equal bins over min..max (the last one closed on the
    right), or bins of a fixed width from ``start``."""
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    if width is None:
        low = values.agg(F.min("x").alias("v")).scalar()
        step = values.agg(((F.max("x") - F.min("x")) / F.lit(float(bins))).alias("v")).scalar()
        tagged = values.select("x", low.alias("_low"), step.alias("_step")).withColumn(
            "bin", F.least(F.floor((F.col("x") - F.col("_low")) / F.nullif("_step", F.lit(0.0))),
                           F.lit(bins - 1)))
        tagged = tagged.withColumn("bin", F.coalesce("bin", F.lit(0)))
        return tagged.groupBy("bin").agg(F.count(F.lit(1)).alias("n"),
                                         F.first("_low").alias("_low"), F.first("_step").alias("_step")
                                         ).select(F.col("bin").cast("bigint").alias("bin"),
                                                  (F.col("_low") + F.col("bin") * F.col("_step")).alias("bin_start"), "n")
    origin = 0.0 if start is None else float(start)
    bin_no = F.floor((F.col("x") - origin) / float(width)).cast("bigint")
    return (values.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.col("bin") * float(width) + origin).alias("bin_start"), "n"))


def boxplot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the outlier count; NaN counts as missing."""
    df = without_nan(df, columns)
    quart = pin_small(quantiles_wide(df, columns, QUARTILES))
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = (F.col("value") >= F.col("q25") - reach) & (F.col("value") <= F.col("q75") + reach)
    cells = long_form(df, columns, "double").filter(F.col("value").isNotNull())
    return (cells.join(quart, "column").groupBy("column", "q25", "q50", "q75")
            .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                 F.count(F.when(~inside, 1)).alias("outliers")))


def density(df: DataFrame, column: str, points: int = 50, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on a grid over min..max, Scott bandwidth by default.

    Rows meet the grid as one aggregate per grid point, so no row is multiplied.
    """
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    s = values.agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                   F.stddev_samp("x").alias("sd")).first()
    h = bandwidth or (s["sd"] or 0.0) * s["n"] ** -0.2 or 1.0
    grid = [s["lo"] + (s["hi"] - s["lo"]) * i / (points - 1) for i in range(points)]
    scale = 1.0 / (s["n"] * h * math.sqrt(2 * math.pi))
    counted = values.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    kernels = [F.struct(F.lit(g).alias("x"), (F.sum(
        F.col("c") * F.exp(-F.pow((F.col("x") - g) / h, 2) / 2)) * scale).alias("density"))
        for g in grid]
    return counted.agg(F.array(*kernels).alias("_k")).select(F.inline("_k"))


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
