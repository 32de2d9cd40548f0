"""Rule-based imputation.

Each rule set is one projection followed by one filter, so the whole step fuses into
the scan stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators import ordered
from kerbside.operators.profile import value_table


def fill_where(df: DataFrame, rules: dict[str, list[tuple[Column, object]]]) -> DataFrame:
    """Fill NULL by the first rule whose condition holds: column -> [(condition, value)].

    Conditions see the values from before the step.
    """
    kinds = dict(df.dtypes)

    def filled(name):
        col = F.col(name)
        chain = F.when(col.isNotNull(), col)
        for condition, value in rules[name]:
            chain = chain.when(condition, F.lit(value).cast(kinds[name]))
        return chain
    return df.withColumns({c: filled(c) for c in rules if c in kinds})


def own_vehicle(df: DataFrame, role: str = "role",
                not_applicable: tuple[str, ...] = ("initial_point_of_impact",
                                                   "fixed_obstacle_struck",
                                                   "mobile_obstacle_struck"),
                category: str = "vehicle_category",
                by_activity: tuple[str, ...] = ("main_maneuver_before_accident", "motor_type"),
                pedestrian: str = "pedestrian", passenger: str = "passenger") -> DataFrame:
    """Pedestrians have no own vehicle (-1, category ``none``); manoeuvre and motor are -1
    for pedestrians and passengers and 0 (unknown) for the rest.  Rows still unknown in
    the obstacle, impact or category columns are dropped."""
    on_foot = F.col(role) == pedestrian
    inactive = F.coalesce(F.col(role).isin(pedestrian, passenger), F.lit(False))
    rules = {c: [(on_foot, -1)] for c in not_applicable}
    rules[category] = [(on_foot, "none")]
    rules |= {c: [(inactive, -1), (~inactive, 0)] for c in by_activity}
    required = [c for c in (*not_applicable, category) if c in df.columns]
    return fill_where(df, rules).dropna("any", subset=required)


def other_vehicle(df: DataFrame, presence: str = "id_vehicle_other",
                  category: str = "vehicle_category_other",
                  impact: str = "initial_point_of_impact_other",
                  unknown_if_present: tuple[str, ...] = (
                      "main_maneuver_before_accident_other", "motor_type_other",
                      "direction_of_travel_other", "fixed_obstacle_struck_other",
                      "mobile_obstacle_struck_other")) -> DataFrame:
    """No other vehicle: -1 and category ``none``.  A vehicle with gaps: 0 (unknown).
    Rows still unknown in impact point or category are dropped."""
    present = F.col(presence).isNotNull() if presence in df.columns else F.lit(False)
    rules = {c: [(~present, -1), (present, 0)] for c in unknown_if_present}
    rules[impact] = [(~present, -1)]
    rules[category] = [(~present, "none")]
    required = [c for c in (impact, category) if c in df.columns]
    return fill_where(df, rules).dropna("any", subset=required)


def fill_text(df: DataFrame, value: str = "Unknown") -> DataFrame:
    return df.fillna(value, subset=[n for n, k in df.dtypes if k == "string"])


def impute_all(df: DataFrame, target: str = "injury_target", age: str = "age") -> DataFrame:
    """Own side, other side, rows without target dropped, text gaps ``Unknown``, age 0."""
    out = other_vehicle(own_vehicle(df))
    if target in out.columns:
        out = out.dropna(subset=[target])
    out = fill_text(out)
    return out.fillna(0, subset=[age]) if age in out.columns else out


def flag_present(df: DataFrame, column: str, into: str) -> DataFrame:
    return df.withColumn(into, F.col(column).isNotNull().cast("int"))


def mode_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULL with the most frequent value, the smallest among equals.

    Values are counted in one distributed aggregation over all columns; only the
    winning value of each column reaches the driver.
    """
    kinds = dict(df.dtypes)
    groups = [[c for c in columns if kinds[c] == "string"],
              [c for c in columns if kinds[c] != "string"]]
    fills = {}
    for names, kind in zip(groups, ("string", "double")):
        if not names:
            continue
        counts = value_table(df, names, kind).filter(F.col("value").isNotNull())
        # Largest count first, then the smallest value: pre-aggregated, one row per column.
        best = counts.groupBy("column").agg(F.max("n").alias("_top"))
        tied = counts.join(F.broadcast(best), "column").filter(F.col("n") == F.col("_top"))
        for row in tied.groupBy("column").agg(F.min("value").alias("v")).collect():
            fills[row["column"]] = row["v"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
                           for c, v in fills.items()})


random_impute = ordered.random_draw_impute


def any_positive(columns: list[str]) -> Column:
    """1 if any of the flag columns is above zero, else 0."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > 0, F.lit(False)) for c in columns]).cast("int")


def row_sum(columns: list[str]) -> Column:
    """Sum over columns of one row, NULL counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])
