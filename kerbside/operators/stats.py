"""Independence tests and correlations from aggregated tables."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kerbside.operators.profile import long_form
from kerbside.session import pin_small


# ---- tail probabilities -------------------------------------------------------------
def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1:                      # power series of P
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * math.exp(log_front))
    tiny = 1e-300                      # continued fraction of Q
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return math.exp(log_front) * h


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_tail(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or tiny)
            c = 1 + num / c or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) or not d else upper_gamma(d / 2, s / 2)
                      for s, d in zip(x, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def f_tail(x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) else beta_tail(b / 2, a / 2, b / (b + a * s))
                      for s, a, b in zip(x, d1, d2)], dtype="float64")


# ---- chi-square and Cramer's V -------------------------------------------------------
def chi2_independence(df: DataFrame, features: list[str], target: str,
                      alpha: float = 0.05) -> DataFrame:
    """Test of each feature against the target: statistic, dof, p, verdict, Cramer's V.

    All features share one pass.  Empty cells need no rows: the statistic is
    sum o^2/e - n over the filled cells, and the 2x2 case (Yates' correction) has the
    same deviation in all four cells.
    """
    cells = (long_form(df.filter(F.col(target).isNotNull()), features, "string", [target])
             .filter(F.col("value").isNotNull())
             .groupBy("column", "value", target).agg(F.count(F.lit(1)).alias("o")))
    # A row of the table has as many cells as the target has classes; the column sums are
    # one row per feature and class.
    by_row = W.partitionBy("column", "value")
    cells = cells.withColumns({"r": F.sum("o").over(by_row),
                               "_first": F.row_number().over(by_row.orderBy(target)) == 1})
    sums = pin_small(cells.groupBy("column", F.col(target).alias("_t")).agg(F.sum("o").alias("c")))
    totals = F.broadcast(sums.groupBy("column").agg(
        F.sum("c").alias("n"), F.sum(1.0 / F.col("c")).alias("_ic"), F.count(F.lit(1)).alias("cols"))
        .withColumnRenamed("column", "_column"))
    cells = cells.join(sums.withColumnRenamed("column", "_column"),
                       (F.col("column") == F.col("_column")) & (F.col(target) == F.col("_t"))).drop("_column")
    cells = cells.join(totals, F.col("column") == F.col("_column")).drop("_column")
    e = F.col("r") * F.col("c") / F.col("n")
    t = cells.groupBy("column", "n", "_ic", "cols").agg(
        F.sum(F.col("o") * F.col("o") / e).alias("_s"),
        F.max(F.abs(F.col("o") - e)).alias("_d"),
        F.sum(F.when(F.col("_first"), 1.0 / F.col("r"))).alias("_ir"),
        F.count(F.when(F.col("_first"), 1)).alias("rows"))
    corrected = F.col("_d") - F.least(F.lit(0.5), F.col("_d"))
    t = t.withColumn("dof", (F.col("rows") - 1) * (F.col("cols") - 1)).withColumn(
        "chi2", F.when(F.col("dof") == 0, 0.0)
        .when(F.col("dof") == 1, corrected * corrected * F.col("n") * F.col("_ir") * F.col("_ic"))
        .otherwise(F.greatest(F.lit(0.0), F.col("_s") - F.col("n"))))
    p = F.when(F.col("dof") == 0, 1.0).otherwise(chi2_tail("chi2", F.col("dof").cast("double")))
    n1 = F.nullif(F.col("n") - 1, F.lit(0))
    phi = F.greatest(F.lit(0.0), F.col("chi2") / F.col("n")
                     - (F.col("rows") - 1) * (F.col("cols") - 1) / n1)
    rc = F.col("rows") - F.pow(F.col("rows") - 1, 2) / n1
    cc = F.col("cols") - F.pow(F.col("cols") - 1, 2) / n1
    v = F.sqrt(phi / F.nullif(F.least(rc - 1, cc - 1), F.lit(0.0)))
    return t.withColumns({"p_value": p, "cramers_v": v}).select(
        "column", "n", "chi2", "dof", "p_value",
        (F.col("p_value") < alpha).alias("significant"), "cramers_v")


def anova(df: DataFrame, values: list[str], target: str, alpha: float = 0.05) -> DataFrame:
    """One-way analysis of variance of each numeric column over the target's groups."""
    cells = long_form(df.filter(F.col(target).isNotNull()), values, "double", [target]).filter(
        F.col("value").isNotNull())
    groups = cells.groupBy("column", target).agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    t = groups.withColumn("_gm", F.sum(F.col("n") * F.col("m")).over(W.partitionBy("column"))
                          / F.sum("n").over(W.partitionBy("column")))
    t = t.groupBy("column").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("_gm"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    d1, d2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = (F.col("between") / F.nullif(d1, F.lit(0))) / F.nullif(
        F.col("within") / F.nullif(d2, F.lit(0)), F.lit(0.0))
    out = t.withColumns({"f": f, "df_between": d1, "df_within": d2})
    return out.withColumn("p_value", f_tail("f", F.col("df_between").cast("double"),
                                            F.col("df_within").cast("double"))).select(
        "column", "f", "df_between", "df_within", "p_value",
        (F.col("p_value") < alpha).alias("significant"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of all pairs over the rows where both are known, long form."""
    pairs = list(combinations_with_replacement(columns, 2))
    one = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                    F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"))
                           for a, b in pairs]).alias("_p")).select(F.inline("_p"))
    mirrored = one.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return one.unionByName(mirrored)
