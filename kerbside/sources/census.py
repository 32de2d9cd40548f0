"""What is in a folder of files: rows, columns, separators and years of every file in one scan.

Text files are read as lines once, whatever their number: lines are counted per file, and the first
line, which comes at the lowest place, tells separator and columns. Rows of Parquet files are counted in
one scan as well; their columns come from the footers, which are read without a job. Several part files
under one name (a folder written by Spark) count as that file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.sources.raw import _files

SEPARATORS = [";", ",", "\t", "|"]          # the first of equal counts is taken
NAME = r"([^/=]+\.(?:csv|txt|parquet))(?:/|$)"
YEAR = r"-(\d{4})\."
CENSUS = "file string, year int, kind string, separator string, rows long, columns long"


def _name(path: Column) -> Column:
    """The first file or folder in a path that is named like a table."""
    return F.url_decode(F.regexp_replace(F.regexp_extract(path, NAME, 1), r"\+", "%2B"))


def _year(name: Column) -> Column:
    return F.regexp_extract(name, YEAR, 1).try_cast("int")


def text_census(spark: SparkSession, paths: list[str], separators: list[str] = SEPARATORS) -> DataFrame:
    """(file, year, kind, separator, rows, columns): rows without the header of each part file."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("part"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"))
    filled = F.length(F.trim("value")) > 0
    parts = lines.groupBy("part").agg(F.count(F.when(filled, 1)).alias("lines"), F.min_by("value", "at").alias("first"))
    hits = [F.length("first") - F.length(F.replace("first", F.lit(s))) for s in separators]
    most = F.greatest(*hits) if len(hits) > 1 else hits[0]
    separator = F.coalesce(*[F.when(h == most, F.lit(s)) for h, s in zip(hits, separators)])
    known = parts.withColumns({"file": _name(F.col("part")), "separator": separator, "n": most + 1})
    return known.groupBy("file").agg(
        F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("headers"),
        F.max_by("separator", "n").alias("separator"), F.max("n").cast("long").alias("columns")).select(
        "file", _year(F.col("file")).alias("year"), F.lit("text").alias("kind"), "separator",
        F.greatest(F.lit(0), F.col("lines") - F.col("headers")).alias("rows"), "columns")


def footer_columns(spark: SparkSession, path: str) -> int:
    """Columns of a Parquet file, by its footer."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    first = path
    if not path.endswith(".parquet") or len(_files(spark, f"{path}/*.parquet")):
        first = _files(spark, f"{path}/*.parquet")[0]
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(first), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return reader.getFooter().getFileMetaData().getSchema().getFieldCount()
    finally:
        reader.close()


def parquet_census(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, year, kind, separator, rows, columns): one scan that reads no column."""
    counted = spark.read.parquet(*paths).select(_name(F.col("_metadata.file_path")).alias("file")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"))
    footers = spark.createDataFrame([(p.rsplit("/", 1)[-1], footer_columns(spark, p)) for p in paths], "file string, columns long")
    return footers.join(counted, "file", "left").select(
        "file", _year(F.col("file")).alias("year"), F.lit("parquet").alias("kind"), F.lit(None).cast("string").alias("separator"),
        F.coalesce("rows", F.lit(0)).alias("rows"), "columns")


def census(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV, text and Parquet file of a folder: (file, year, kind, separator, rows, columns)."""
    paths = _files(spark, f"{folder}/*")
    texts = [p for p in paths if p.lower().endswith((".csv", ".txt"))]
    tables = [p for p in paths if p.lower().endswith(".parquet")]
    out = spark.createDataFrame([], CENSUS)
    if texts:
        out = out.unionByName(text_census(spark, texts))
    if tables:
        out = out.unionByName(parquet_census(spark, tables))
    return out


def years(found: DataFrame) -> list[int]:
    """Years that files are named by."""
    return sorted(r[0] for r in found.filter("year IS NOT NULL").select("year").distinct().collect())
