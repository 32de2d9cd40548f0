"""Scoring a stream so that every report counts once, with the rejected ones beside it.

Each micro-batch writes its scored and its rejected reports to a folder of its own number, which a
repeated batch overwrites, and then its line in the ledger. The offset log of the checkpoint gives a
batch the same files again after a failure, so a batch that broke off before its line is written anew
and one that has its line is passed over. Readers take batches with a line only: a half-written batch
is never seen, and none is seen twice, whatever failed in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

LEDGER = "batch long, scored long, rejected long"


def _done(spark: SparkSession, out: str) -> DataFrame:
    """The ledger, with no lines if there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{out}/ledger/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def split(reports: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Reports that pass all checks, and the others with ``reason``, the first check they fail."""
    tests = [F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in checks.items()]
    tagged = reports.withColumn("reason", F.coalesce(*tests) if tests else F.lit(None).cast("string"))
    return tagged.filter("reason IS NULL").drop("reason"), tagged.filter("reason IS NOT NULL")


def write_batch(reports: DataFrame, number: int, out: str, score: Callable[[DataFrame], DataFrame],
                checks: dict[str, Column], before_line: Callable[[int], None] | None = None) -> None:
    """One micro-batch: its folders first, its line in the ledger last."""
    spark = reports.sparkSession
    if _done(spark, out).filter(F.col("batch") == number).limit(1).count():
        return
    good, bad = split(reports, checks)
    counts = []
    for kind, rows in (("scored", score(good)), ("rejected", bad)):
        path = f"{out}/{kind}/batch={number}"
        rows.write.mode("overwrite").parquet(path)
        counts.append(spark.read.schema(rows.schema).parquet(path).count())
    if before_line:
        before_line(number)
    line = spark.createDataFrame([(number, *counts)], LEDGER)
    line.coalesce(1).write.mode("overwrite").parquet(f"{out}/ledger/{number}")


def score_once(spark: SparkSession, schema: StructType, source: str, out: str, checkpoint: str,
               score: Callable[[DataFrame], DataFrame], checks: dict[str, Column] | None = None,
               max_files: int = 1000, fmt: str = "parquet", before_line: Callable[[int], None] | None = None):
    """Score every new file of a folder, in batches of ``max_files``, then stop; returns the started query.

    ``checkpoint`` and ``out`` are folders all executors share; the same ones again go on where the
    last run stopped. ``before_line`` is called between a batch and its line (tests break off there).
    """
    reports = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(source)
    return (reports.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(lambda df, number: write_batch(df, number, out, score, checks or {}, before_line)).start())


def _finished(spark: SparkSession, out: str, kind: str, schema: StructType) -> DataFrame:
    numbers = sorted(r["batch"] for r in _done(spark, out).select("batch").collect())      # one line a batch
    paths = [f"{out}/{kind}/batch={n}" for n in numbers]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def scored(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """Scored reports of all finished batches."""
    return _finished(spark, out, "scored", schema)


def rejected(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """Rejected reports of all finished batches, with their reason."""
    return _finished(spark, out, "rejected", schema)
