"""Session helpers: building a session, cutting lineage, pinning small tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on the bytes of a table that may be held by every executor.
SMALL_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, set as the session's checkpoint folder.

    Only a local session without that setting gets a folder of its own; a cluster session
    without it is an error, since a folder on one machine cannot survive the loss of that machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir")
        if configured is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="kerbside-checkpoint-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: for wide rows of which later steps
    read a few columns."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_settings(spark: SparkSession) -> None:
    """Two settings of the session that change how plans run, never what they give.

    Joins use rows that are already placed by some of their keys, where Spark would exchange both
    sides again by all of them. And a stage whose generated method is too long for the JVM to
    compile falls back to one method per operator, which is split: projections of fifty columns
    would be interpreted otherwise.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a table out over the cores if its files give fewer splits than there are cores.

    Worth it before work that is heavy per row; a table of many splits comes back as it is.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, *keys) if df.rdd.getNumPartitions() < wanted else df


def row_width(df: DataFrame) -> int:
    """Rough bytes of a row by its types: 8 for a fixed width, 64 for text, 512 for anything nested."""
    kinds = [k for _, k in df.dtypes]
    return sum(64 if k in ("string", "binary") else 512 if "<" in k else 8 for k in kinds) + 8


def pin_small(df: DataFrame, row_bytes: int | None = None, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Replace a small aggregate by its rows, marked for broadcast.

    Rows times width are checked first (``row_bytes`` where the types don't tell the
    width): a larger table comes back unchanged, so that the join falls to a shuffle
    (with adaptive skew handling) instead of a broadcast.
    """
    max_rows = max(1, max_bytes // (row_bytes or row_width(df)))
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def match_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                    how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL meeting NULL; the keys of the left side stay."""
    right = right.withColumnsRenamed({k: "_right_" + k for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col("_right_" + k))
    return left.join(right, on, how).drop(*["_right_" + k for k in keys])
