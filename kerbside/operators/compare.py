"""Set operations and table comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_schema(left: DataFrame, right: DataFrame, column_order: bool = False) -> bool:
    a, b = left.dtypes, right.dtypes
    return a == b if column_order else sorted(a) == sorted(b)


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus on each side.

    Signed counts in one aggregation: copies collapse before the shuffle.
    """
    cols = left.columns
    both = (left.select(cols).withColumn("_s", F.lit(1))
            .unionByName(right.select(cols).withColumn("_s", F.lit(-1))))
    out = both.groupBy(*cols).agg(F.sum("_s").alias("_s")).filter("_s <> 0")
    return out.withColumns({"only_left": F.greatest(F.col("_s"), F.lit(0)),
                            "only_right": F.greatest(-F.col("_s"), F.lit(0))}).drop("_s")


def diff_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: equal, rows only on the left, rows only on the right."""
    d = table_diff(left, right).agg(
        F.coalesce(F.sum("only_left"), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum("only_right"), F.lit(0)).alias("only_right"))
    return d.select(((F.col("only_left") == 0) & (F.col("only_right") == 0)).alias("equal"),
                    "only_left", "only_right")


def tables_equal(left: DataFrame, right: DataFrame, column_order: bool = False) -> bool:
    return same_schema(left, right, column_order) and diff_summary(left, right).first()["equal"]


def key_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).union(right.select(key)).distinct()
