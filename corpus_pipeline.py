"""From documents to packed training sequences: five stages, each reading what the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``. Rows
with a null text pass the filters (they hold nothing toxic and no benchmark item); equal ones are
copies of each other. An empty table passes through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import common, decontaminate, exact_dedup, packing, queries, simhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.arrow_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.arrow_batches(spark)
    return exact_dedup.unique_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.arrow_batches(spark)
    return simhash.one_per_group(docs, words=4, bits=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.arrow_batches(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.arrow_batches(spark)
    return packing.packed(docs, queries.tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies),
          ("decontamination", drop_leaks), ("packing", pack)]
# a fitted classifier, fingerprints and a tokenizer are no SQL: tests hold the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
