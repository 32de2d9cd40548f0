"""What makes a cluster different: numbers by standardised means, categories by lift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.ordered import first_per_key
from kerbside.operators.profile import long_form, quantiles_wide, value_table
from kerbside.session import match_null_safe, pin_small


def numeric_profile(df: DataFrame, cluster: str, columns: list[str],
                    min_abs_z: float | None = None) -> DataFrame:
    """Per (cluster, column): mean, median, std, min, quartiles and the distance of the mean
    from the overall mean in overall standard deviations (0 where nothing varies)."""
    cells = long_form(df, columns, "double", [cluster]).filter(F.col("value").isNotNull())
    per = cells.groupBy(cluster, "column").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"))
    # One row per column: bounded by the column list.
    overall = F.broadcast(cells.groupBy("column").agg(F.avg("value").alias("_m"),
                                                      F.stddev_samp("value").alias("_s")))
    quart = quantiles_wide(df, columns, {"q25": 0.25, "median": 0.5, "q75": 0.75}, [cluster])
    out = match_null_safe(per, pin_small(quart), [cluster, "column"]).join(overall, "column")
    z = F.coalesce((F.col("mean") - F.col("_m")) / F.nullif("_s", F.lit(0.0)), F.lit(0.0))
    out = out.withColumn("z_mean", z).select(cluster, "column", "n", "mean", "median", "std", "min",
                                             "q25", "q75", "z_mean")
    return out if min_abs_z is None else out.filter(F.abs("z_mean") >= min_abs_z)


def category_shares(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Per (cluster, column, value): rows and share inside the cluster, unknowns left out."""
    counts = value_table(df, columns, "string", [cluster]).filter(F.col("value").isNotNull())
    totals = counts.groupBy(cluster, "column").agg(F.sum("n").alias("_t"))
    return match_null_safe(counts, pin_small(totals), [cluster, "column"]).withColumn(
        "share", F.col("n") / F.col("_t")).drop("_t")


def dominant_category(shares: DataFrame, cluster: str) -> DataFrame:
    """Most frequent value per (cluster, column), the smallest among equals."""
    return first_per_key(shares, [cluster, "column"], [F.desc("n"), F.asc("value")])


def over_represented(df: DataFrame, cluster: str, columns: list[str], min_lift: float = 1.2,
                     min_support: float = 0.05, min_spread: float = 0.005) -> DataFrame:
    """Values much more common in a cluster than overall: (cluster, column, value, lift,
    support).

    Columns whose dominant value is the same in every cluster, or whose shares hardly
    differ between clusters (largest standard deviation over clusters), are left out.
    A value missing from a cluster counts with share 0.
    """
    shares = category_shares(df, cluster, columns)
    differs = (dominant_category(shares, cluster).groupBy("column")
               .agg(F.count_distinct("value").alias("_d")).filter("_d > 1").select("column"))
    clusters = shares.select(cluster, "column").distinct().groupBy("column").agg(
        F.count(F.lit(1)).alias("_k"))
    per_value = shares.groupBy("column", "value").agg(
        F.sum("share").alias("_s"), F.sum(F.col("share") * F.col("share")).alias("_q"),
        F.sum("n").alias("_n"))
    spread = F.sqrt(F.greatest(F.lit(0.0), (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_k"))
                               / F.nullif(F.col("_k") - 1, F.lit(0))))
    varied = (per_value.join(F.broadcast(clusters), "column").groupBy("column")
              .agg(F.max(spread).alias("_sd"), F.sum("_n").alias("_all"))
              .filter(F.col("_sd") > min_spread))
    kept = F.broadcast(differs.join(varied, "column"))     # one row per column
    overall = per_value.join(kept, "column").select(
        "column", "value", (F.col("_n") / F.col("_all")).alias("_overall"))
    return (shares.join(overall, ["column", "value"])
            .withColumn("lift", F.col("share") / F.col("_overall"))
            .filter((F.col("lift") >= min_lift) & (F.col("share") >= min_support))
            .select(cluster, "column", "value", "lift", F.col("share").alias("support")))


def joined_profile(categories: DataFrame, numbers: DataFrame, cluster: str) -> DataFrame:
    """One row per cluster: its over-represented values and its unusual numbers.

    Values with a support threshold are few per column, so the lists are short.
    """
    left = categories.groupBy(cluster).agg(F.sort_array(F.collect_list(F.struct(
        "column", "value", F.round("lift", 2).alias("lift"),
        F.round(F.col("support") * 100, 1).alias("support_pct")))).alias("categories"))
    right = numbers.groupBy(cluster).agg(F.sort_array(F.collect_list(F.struct(
        "column", F.round("mean", 2).alias("mean"), F.round("z_mean", 2).alias("z_mean")))).alias("numbers"))
    return left.join(right, cluster, "full")


def cluster_sizes(df: DataFrame, labels: list[str]) -> DataFrame:
    """Rows per label value, one column per clustering, 0 where a label is not used."""
    cells = long_form(df, labels, "int").filter(F.col("value").isNotNull())
    return cells.groupBy(F.col("value").alias("label")).agg(*[
        F.count(F.when(F.col("column") == c, 1)).alias(c) for c in labels])


def largest_shares(df: DataFrame, labels: list[str], top: int = 3) -> DataFrame:
    """Share of the largest clusters of each clustering: (column, place, share_pct)."""
    counts = value_table(df, labels, "int").filter(F.col("value").isNotNull())
    totals = F.broadcast(counts.groupBy("column").agg(F.sum("n").alias("_t")))
    placed = first_per_key(counts, ["column"], [F.desc("n"), F.asc("value")], top, rank="place")
    return placed.join(totals, "column").select(
        "column", "place", F.round(F.col("n") * 100.0 / F.col("_t"), 1).alias("share_pct"))
