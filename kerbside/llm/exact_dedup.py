"""Exact deduplication: a stateful stream over digests, full bytes checked on hits.

Arrivals (digest, identifier, length, content locator) stream through a keyed aggregation whose
state lives in RocksDB on disk, checkpointed in the shared folder, and never expires. Per digest
it retains the number of arrivals and, of the text that stays, identifier and locator (file and
row). State updates go to a table as each micro-batch ends.

On hits, a digest met more than once, whole normalised texts are compared: rows are grouped by
digest and text, combined before the shuffle, so copies of a hot text collapse in each task.
Should a digest have more than one text, its rows are told apart by their text.

Null counts as empty, empty texts are equal. Of equal texts the most code points in the original
stay, then the smallest doc_id (null last), then the later file and row: of repeated rows exactly
one stays. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kerbside.llm.common import fits_broadcast, shared_folder, stored

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# the keyed state on disk; many small stores, so no file space reserved ahead
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with _loc_file and _loc_row, the locator of each row's content; written first unless it is a file scan."""
    where = [F.col("_metadata.file_path").alias("_loc_file"), F.col("_metadata.row_index").alias("_loc_row")]
    try:
        found = docs.select("*", *where)
        found.schema     # noqa: B018  analysed here
        return found
    except AnalysisException:
        return stored(docs, "documents").select("*", *where)


def _best() -> Column:
    """Largest for the row that stays: length, then smaller id, then locator."""
    return F.max(F.struct("chars", F.bitwise_not("doc_id").alias("order"), "_loc_file", "_loc_row"))


def stream_state(arrivals: DataFrame, max_files: int | None = None) -> DataFrame:
    """Stream a stored table of arrivals through the keyed state; (digest, n, best) at the end.

    ``max_files`` files make a micro-batch (None: all at once). Each call has a checkpoint of
    its own; a micro-batch repeated after a failure overwrites its own updates.
    """
    spark = arrivals.sparkSession
    base = f"{shared_folder(spark)}/dedup-stream-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(arrivals.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    source = {f.rsplit("/", 1)[0] for f in arrivals.inputFiles()}
    updates = arrivals.limit(0).groupBy("digest").agg(F.count("*").alias("n"), _best().alias("best"))
    updates = updates.withColumn("batch", F.lit(0).cast("long"))
    if not source:
        return updates.drop("batch")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        state = reader.parquet(source.pop()).groupBy("digest").agg(F.count("*").alias("n"), _best().alias("best"))

        def keep(batch: DataFrame, number: int) -> None:
            (batch.withColumn("batch", F.lit(number).cast("long"))
             .write.mode("overwrite").parquet(f"{base}/updates/part={number}"))

        (state.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True)
         .option("checkpointLocation", f"{base}/state").start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    log = spark.read.schema(updates.schema).parquet(f"{base}/updates")
    if max_files is None:
        return log.drop("batch")      # one micro-batch: one update per digest
    return (log.groupBy("digest").agg(F.max_by(F.struct("n", "best"), "batch").alias("s"))
            .select("digest", "s.n", "s.best"))


def assign(docs: DataFrame, digest=sha256, max_files: int | None = None) -> DataFrame:
    """One row per row of ``docs``: _loc_file, _loc_row, doc_id, digest, keep_id, group_size, kept.

    ``digest`` maps the normalised text to bytes; results don't depend on its quality.
    """
    rows = located(docs.select("doc_id", "text")).withColumn("norm", normalised(F.col("text")))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    sized = rows.withColumn("chars", F.coalesce(F.char_length("text"), F.lit(0)))
    arrivals = stored(sized.select("digest", "doc_id", "chars", "_loc_file", "_loc_row"), "arrivals")
    state = stored(stream_state(arrivals, max_files), "dedup-state")

    hits = state.where("n > 1").select("digest")
    n_hits = hits.count()
    found = sized.select("digest", "norm", "doc_id", "chars", "_loc_file", "_loc_row")
    if fits_broadcast(n_hits, 64):
        found = found.join(F.broadcast(hits), "digest", "left_semi")
    # beyond that size all texts are compared, which needs no second shuffle
    texts = found.groupBy("digest", "norm").agg(F.count("*").alias("n"), _best().alias("best"))
    clash = stored(texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"),
                   "clashing-digests")
    picked = arrivals.join(state, "digest")
    if not clash.isEmpty():
        told = (found.join(clash, "digest", "left_semi").join(texts, ["digest", "norm"])
                .select("digest", "doc_id", "chars", "_loc_file", "_loc_row", "n", "best"))
        picked = picked.join(clash, "digest", "left_anti").select(told.columns).unionByName(told)
    return picked.select(
        "_loc_file", "_loc_row", "doc_id", "digest", F.bitwise_not(F.col("best.order")).alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("_loc_file") == F.col("best._loc_file")) & (F.col("_loc_row") == F.col("best._loc_row"))).alias("kept"))


def unique_documents(docs: DataFrame) -> DataFrame:
    """The row of each group that stays, with its columns."""
    columns = docs.columns
    own = [f"c{i}" if c not in ("doc_id", "text") else c for i, c in enumerate(columns)]     # no name can clash
    docs = located(docs.toDF(*own))
    dropped = stored(assign(docs).where("not kept").select("_loc_file", "_loc_row"), "copies")
    return docs.join(dropped, ["_loc_file", "_loc_row"], "left_anti").select(*own).toDF(*columns)
