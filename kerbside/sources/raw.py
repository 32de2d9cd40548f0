"""Reading the yearly files and looking at what is there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.sources import schemas

YEAR_IN_NAME = r"-(\d{4})\.csv"


def _files(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders matching a glob on whatever file system the path names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in system.globStatus(path) or [])


def header(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Column names of a CSV file or folder; only the first line is read."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("inferSchema", False).csv(path).columns)


def _scans(spark: SparkSession, folder: str, table: str, sep: str) -> dict[tuple, DataFrame]:
    """One scan per distinct header of a table's yearly files."""
    prefix = schemas.FILE_PREFIX[table]
    by_header: dict[tuple, list[str]] = {}
    for path in _files(spark, f"{folder}/{prefix}-[0-9][0-9][0-9][0-9].csv"):
        by_header.setdefault(tuple(header(spark, path, sep)), []).append(path)
    if not by_header:
        raise FileNotFoundError(f"no yearly {prefix} files in {folder}")
    scans = {}
    for columns, paths in by_header.items():
        scan = (spark.read.schema(schemas.raw_schema(list(columns))).option("sep", sep)
                .option("header", True).csv(paths))
        scans[columns] = scan.select(
            *columns,
            F.regexp_extract("_metadata.file_name", YEAR_IN_NAME, 1).try_cast("int").alias("file_year"),
            F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row")).alias("_src_pos"))
    return scans


def _union(scans: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_table(spark: SparkSession, folder: str, table: str, sep: str = ";") -> DataFrame:
    """All years of one raw table as text, with ``file_year`` and ``_src_pos``.

    Columns that some years lack are NULL there.  ``_src_pos`` orders rows as in the files.
    """
    return _union(list(_scans(spark, folder, table, sep).values()))


def read_raw(spark: SparkSession, folder: str, sep: str = ";") -> dict[str, DataFrame]:
    """The raw tables over all years found in the folder.

    Users of years whose files have no user id come apart, as ``users_without_id``.
    """
    out = {t: read_table(spark, folder, t, sep) for t in schemas.FILE_PREFIX if t != "users"}
    users = _scans(spark, folder, "users", sep)
    for name, test in (("users", True), ("users_without_id", False)):
        part = [df for columns, df in users.items() if ("id_usager" in columns) is test]
        if part:
            out[name] = _union(part)
    return out


def years_in(spark: SparkSession, folder: str) -> list[int]:
    import re
    names = " ".join(_files(spark, f"{folder}/*-*.csv"))
    return sorted({int(y) for y in re.findall(YEAR_IN_NAME, names)})


def typed(df: DataFrame, done: list[str] = ()) -> DataFrame:
    """Clean types for the columns that are there; unreadable values become NULL.

    Columns in ``done`` and those that start with ``_`` stay as they are. Columns of one kind are
    read by one expression over an array of them, which keeps the generated code short.
    """
    kinds: dict[str, list[str]] = {"long": [], "lanes": [], "double": [], "code": []}
    for name in df.columns:
        if name in done or name[0] == "_" or name == "file_year" or name in schemas.TEXTS:
            continue
        kinds["long" if name in schemas.LONGS else "lanes" if name == "number_of_traffic_lanes"
              else "double" if name in schemas.DOUBLES else "code"].append(name)
    readers = {"long": fc.blank_free_long, "lanes": fc.lane_count, "double": fc.blank_free_double, "code": fc.code}
    read = {f"_{k}s": F.transform(F.array(*[F.col(c).cast("string") for c in names]), readers[k]) for k, names in kinds.items() if names}
    out = df.withColumns(read)
    return out.withColumns({c: F.col(f"_{k}s")[i] for k, names in kinds.items() for i, c in enumerate(names)}).drop(*read)


def rejects(df: DataFrame, key: str, checks: dict[str, F.Column], year: str = "file_year") -> DataFrame:
    """Rows that fail a check, with year and the first reason: bad data of one year is
    reported and the other years go on."""
    reason = F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name))
                          for name, test in checks.items()])
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        F.col(year).alias("year"), F.col(key).cast("string").alias("key"), "reason")


# ---- stages -------------------------------------------------------------------------
def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", sep: str = ";",
               schema=None) -> DataFrame:
    """A stage written earlier; CSV stages take their declared schema."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("sep", sep).option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_stage_year(spark: SparkSession, path: str, year: int, **kwargs) -> DataFrame:
    """One year of a stage; only that year's partition is scanned."""
    return read_stage(spark, path, **kwargs).filter(F.col("year") == year)


# ---- looking at files -----------------------------------------------------------------
def guess_separator(first_line: str, candidates: str = ";,\t|") -> str:
    return max(candidates, key=first_line.count)


def compare_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """(column, one flag per table, is_different); no data is read."""
    spark = next(iter(tables.values())).sparkSession
    names = sorted({c for t in tables.values() for c in t.columns})
    rows = []
    for c in names:
        flags = [c in t.columns for t in tables.values()]
        rows.append((c, *flags, len(set(flags)) > 1))
    schema = ", ".join(["column string", *[f"`{t}` boolean" for t in tables], "is_different boolean"])
    return spark.createDataFrame(rows, schema).orderBy(F.desc("is_different"), "column")


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, columns) for each table."""
    parts = [t.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(n).alias("table"), "rows", F.lit(len(t.columns)).cast("bigint").alias("columns"))
        for n, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def folder_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of each CSV and Parquet file of a folder, separator guessed."""
    tables = {}
    for path in _files(spark, f"{folder}/*"):
        name = path.rsplit("/", 1)[-1]
        if name.lower().endswith(".parquet"):
            tables[name] = spark.read.parquet(path)
        elif name.lower().endswith(".csv"):
            first = spark.read.text(path).limit(1).collect()
            sep = guess_separator(first[0]["value"]) if first else ","
            tables[name] = spark.read.option("header", True).option("sep", sep).csv(path)
    if not tables:
        return spark.createDataFrame([], "table string, rows bigint, columns bigint")
    return table_shapes(tables)
