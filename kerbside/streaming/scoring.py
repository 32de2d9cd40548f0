"""Scoring of accident reports, on a table or on a stream.

Nothing here keeps state or joins: every step is a projection, so the same functions run
on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import codes
from kerbside.functions import columns as fc
from kerbside.operators import features


def complete(reports: DataFrame, wanted: list[str], categorical: list[str],
             keep: list[str] = ()) -> DataFrame:
    """Exactly the wanted columns; absent or unknown ones become -1 (codes) or 0.0."""
    kinds = dict(reports.dtypes)

    def one(name: str) -> Column:
        default = F.lit(-1) if name in categorical else F.lit(0.0)
        if name not in kinds:
            return default.alias(name)
        if kinds[name] == "string":
            return F.coalesce(F.col(name), F.lit("-1")).alias(name)
        return F.coalesce(F.col(name), default.cast(kinds[name])).alias(name)
    return reports.select(*keep, *[one(n) for n in wanted])


def derive(reports: DataFrame) -> DataFrame:
    """Model features from what a report says, by the definitions used in training:
    ``hour``, ``day_of_week``, ``age``, ``vehicle_category`` and its other, where present."""
    out = reports
    if "hour" in out.columns:
        out = features.cyclic_pair(out, "hour", "hour", 24).withColumn("time_of_day", fc.time_of_day("hour"))
    if "day_of_week" in out.columns:
        out = features.cyclic_pair(out, "day_of_week", "day_of_week", 7)
    if "age" in out.columns:
        out = out.withColumn("age_group", F.coalesce(fc.age_group("age"), F.lit("Unknown")))
    if {"vehicle_category", "vehicle_category_other"} <= set(out.columns):
        out = features.add_vehicle_scores(out)
    return out


def with_severity(scored: DataFrame, probability: str = "probability") -> DataFrame:
    """Most likely class, expected severity (0..2), gauge (0..1) and risk label."""
    kind = next(f.dataType.typeName() for f in scored.schema.fields if f.name == probability)
    p = F.col(probability) if kind == "array" else vector_to_array(probability)
    expected = fc.expected_class(p)
    return scored.withColumns({"severity": fc.arg_max(p), "expected_severity": expected,
                               "gauge": expected / 2.0,
                               "risk": fc.lookup(fc.arg_max(p), codes.RISK_LABELS)})


def risk_factors(reports: DataFrame, keys: list[str], factors: dict | None = None) -> DataFrame:
    """Long table (keys..., factor, intensity): report fields relative to their maximum."""
    factors = codes.RISK_FACTORS if factors is None else factors
    wide = reports.select(*keys, *[(F.col(c) / F.lit(float(top))).alias(name)
                                   for name, (c, top) in factors.items()])
    return wide.unpivot(keys, list(factors), "factor", "intensity")


def scenarios(reports: DataFrame, overrides: dict[str, dict]) -> DataFrame:
    """Each report once per scenario, with the scenario's fields replaced.

    The scenarios are a literal array on every row, so reports are not joined to anything.
    """
    fields = sorted({f for o in overrides.values() for f in o})
    kinds = dict(reports.dtypes)
    cells = [F.struct(F.lit(name).alias("scenario"), *[
        F.lit(o.get(f)).cast(kinds[f]).alias("_" + f) for f in fields]) for name, o in overrides.items()]
    out = reports.withColumn("_s", F.explode(F.array(*cells)))
    replaced = {f: F.coalesce(F.col(f"_s._{f}"), F.col(f)) for f in fields}
    return out.withColumns({**replaced, "scenario": F.col("_s.scenario")}).drop("_s")


def what_if(reports: DataFrame, overrides: dict[str, dict],
            score: Callable[[DataFrame], DataFrame], outcome: str = "expected_severity") -> DataFrame:
    """Outcome of every scenario and its change against the report as it is."""
    base = score(reports)
    added = [c for c in base.columns if c not in reports.columns and c != outcome]
    base = base.withColumnRenamed(outcome, "_base").drop(*added)
    after = score(scenarios(base, overrides))
    return after.withColumn("change", F.col(outcome) - F.col("_base")).drop("_base")


def score_stream(spark: SparkSession, schema, source: str, sink: str, checkpoint: str,
                 score: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
                 max_files: int = 1000):
    """Score every new file of a folder once, then stop.

    The offset log under ``checkpoint`` (a folder all executors share) makes a rerun after
    a failure go on where the last one stopped.
    """
    reports = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
               .format(fmt).load(source))
    return (score(reports).writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())
