"""Writing stages, final sets and fitted models."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import durable


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", by: str = "year") -> None:
    """One folder per year; CSV uses ``;`` and a header."""
    flat = df.drop("_src_pos")
    writer = flat.write.mode("overwrite")
    if by in flat.columns:
        writer = writer.partitionBy(by)
    if fmt == "csv":
        writer.option("sep", ";").option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_stages(stages: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    for name, df in stages.items():
        write_stage(df, f"{folder}/{name}", fmt)


def write_sets(train: DataFrame, test: DataFrame, folder: str) -> None:
    """Train and test set as Parquet, CSV and compressed CSV; each set is computed once."""
    for name, df in (("train_val_data", durable(train)), ("test_data", durable(test))):
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        writer = df.write.mode("overwrite").option("sep", ";").option("header", True)
        writer.csv(f"{folder}/{name}.csv")
        writer.option("compression", "gzip").csv(f"{folder}/{name}.csv.gz")


def save_model(model: PipelineModel, metadata: dict, folder: str) -> None:
    """A fitted pipeline and, beside it, its feature and category lists as one JSON row."""
    model.write().overwrite().save(f"{folder}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata),)], "metadata string").coalesce(1).write.mode(
        "overwrite").text(f"{folder}/metadata")


def load_model(spark: SparkSession, folder: str) -> tuple[PipelineModel, dict]:
    row = spark.read.text(f"{folder}/metadata").select(F.col("value")).first()
    return PipelineModel.load(f"{folder}/model"), json.loads(row["value"])
