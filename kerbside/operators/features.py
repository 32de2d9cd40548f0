"""Derived features of the merged table, one projection per theme."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import codes
from kerbside.functions import columns as fc
from kerbside.session import pin_small


def cyclic_pair(df: DataFrame, name: str, value, period: float) -> DataFrame:
    s, c = fc.cyclic(value, period)
    return df.withColumns({name + "_sin": s, name + "_cos": c})


def add_time(df: DataFrame, hour_minute: str = "hour_minute") -> DataFrame:
    """Hour, minute, hour on the circle and time of day; the text column goes."""
    t = fc.clock(hour_minute)
    out = df.withColumns({"hour": F.hour(t), "minute": F.minute(t)}).drop(hour_minute)
    return cyclic_pair(out, "hour", "hour", 24).withColumn("time_of_day", fc.time_of_day("hour"))


def add_calendar(df: DataFrame, date: str, month: str = "month") -> DataFrame:
    """Weekday (Monday 0), and weekday, month and day of year on the circle."""
    d = F.col(date)
    out = df.withColumn("day_of_week", F.weekday(d))
    out = cyclic_pair(out, "day_of_week", "day_of_week", 7)
    out = cyclic_pair(out, "month", month, 12)
    return cyclic_pair(out, "day_of_year", F.dayofyear(d), 365.25)


def add_age(df: DataFrame, year: str = "year", born: str = "year_of_birth") -> DataFrame:
    age = F.col(year) - F.col(born)
    return df.withColumns({"age": age, "age_group": fc.age_group(age)})


def add_safety_flags(df: DataFrame, columns: list[str],
                     flags: dict[str, list[int]] | None = None) -> DataFrame:
    flags = codes.SAFETY_FLAGS if flags is None else flags
    return df.withColumns({name: fc.any_code(columns, values) for name, values in flags.items()})


def add_equipment_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Any equipment, none, not reported, not determinable."""
    return df.withColumns({
        "any_equipment": fc.any_code(columns, [1, 2, 3, 4, 5, 6, 7, 9]),
        "no_equipment": fc.any_code(columns, [0]),
        "equipment_not_reported": fc.any_code(columns, [-1]),
        "equipment_not_determinable": fc.any_code(columns, [8])})


def add_vehicle_scores(df: DataFrame, own: str = "vehicle_category",
                       other: str = "vehicle_category_other",
                       none_weight: int | None = None) -> DataFrame:
    """Simplified classes, impact scores of both sides and own minus other."""
    out = df.withColumns({own + "_simplified": fc.simplified_class(own, "unknown"),
                          "vehicle_category_simplified_other": fc.simplified_class(other, "none")})
    out = out.withColumns({
        "impact_score": fc.impact_score(own + "_simplified"),
        "impact_score_other": fc.impact_score("vehicle_category_simplified_other", none_weight)})
    return out.withColumn("impact_delta", F.col("impact_score") - F.col("impact_score_other"))


def range_per_group(df: DataFrame, value: Column, by: str | None) -> DataFrame:
    """Smallest and largest value per group (of all rows without a group)."""
    tagged = df.select((F.col(by) if by else F.lit(0)).alias("_by"), value.alias("_v"))
    return tagged.groupBy("_by").agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))


def min_max_scaled(df: DataFrame, column: str, by: str | None = None, top: float = 10.0,
                   ranges: DataFrame | None = None) -> DataFrame:
    """Scale a column to 0..top inside each group; an empty range gives 0."""
    ranges = pin_small(range_per_group(df, F.col(column), by) if ranges is None else ranges)
    key = F.col(by) if by else F.lit(0)
    joined = df.join(ranges, key.eqNullSafe(F.col("_by")))
    return joined.withColumn(column, fc.scaled(column, "_low", "_high", top)).drop("_by", "_low", "_high")


def add_surface(df: DataFrame, pavement: str = "pavement_condition",
                profile: str = "longitudinal_profile") -> DataFrame:
    return df.withColumn("surface_quality_indicator", fc.both_equal(pavement, profile, 1))


def add_role(df: DataFrame, category: str = "user_category") -> DataFrame:
    role = fc.lookup(category, codes.ROLES, "other") if category in df.columns else F.lit("other")
    return df.withColumn("role", role)


def add_ordinals(df: DataFrame, lighting: str = "lighting_condition",
                 weather: str = "weather_condition") -> DataFrame:
    new = {}
    if lighting in df.columns:
        new["lighting_ordinal"] = fc.lookup(lighting, codes.LIGHTING_SCALE, 0)
    if weather in df.columns:
        new["weather_ordinal"] = fc.lookup(weather, codes.WEATHER_SCALE, 0)
    return df.withColumns(new) if new else df


def add_target(df: DataFrame, severity: str = "injury_severity") -> DataFrame:
    return df.withColumn("injury_target", fc.lookup(severity, codes.TARGET_SCALE))
