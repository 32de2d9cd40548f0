"""Shared by the operators: tables in the shared folder, Arrow columns beside a table, components."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a table that may be collected or sent to every executor, where its rows are of fixed width.
BROADCAST_BYTES = 16 << 20
# Rows of an Arrow batch between the JVM and Python: both hold a batch a task, and a buffer outside the heap
# stays at the size of the largest. A text has kilobytes, so Spark's 10,000 rows are tens of MB a task.
ARROW_ROWS = 500


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="kerbside-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Whole texts go to Python in batches of at most ``rows``; never changes what comes out."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fits_broadcast(rows: int, bytes_per_row: int) -> bool:
    return rows * bytes_per_row <= BROADCAST_BYTES


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small parts, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def with_columns_from(df: DataFrame, fields: list[T.StructField],
                      make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]) -> DataFrame:
    """``df`` with columns computed per Arrow batch; a column of the same name is replaced.

    ``make`` runs once per task and returns the function of a batch.
    """
    new = {f.name.lower() for f in fields}
    old = [c for c in df.columns if c.lower() not in new]
    df = df.select(*old) if any(c.lower() in new for c in df.columns) and old else df
    schema = T.StructType(df.select(*old).schema.fields + fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in old] + compute(batch), names=names)

    return df.mapInArrow(run, schema)


def labelled(labels: DataFrame, label: str, modulus: int, held: int, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` labelled documents outside the held-out fold.

    The fold is ``crc32(doc_id as text) mod modulus``; among its complement the rows with the
    smallest hash of their id are taken, so the sample is the same on any layout. A document
    labelled twice counts with the larger label.
    """
    return (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
            .where(F.crc32(F.col("doc_id").cast("string")) % modulus != held)
            .groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def held_out(modulus: int, held: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == held, F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); root is the smallest node reachable.

    Large-star and small-star steps until nothing changes. Each step takes a minimum per node,
    combined before the shuffle, and joins it back; links are never multiplied, and each step's
    links are written to the shared folder.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "links")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, F.col("u") == F.col("k"))
        small = (small.select("v", "m").where("v <> m").toDF("u", "v")
                 .unionByName(low.toDF("u", "v")).distinct())
        e = stored(small, "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    # converged: every node but the roots has exactly one link, to its root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

