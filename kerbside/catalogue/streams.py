"""Registered queries: a table streamed through the saved scorer, with a failure on the way."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kerbside.catalogue.tables import table
from kerbside.ml import models
from kerbside.plans import modelling
from kerbside.session import shared_folder
from kerbside.streaming import ledger

QUERIES, SQL = {}, {}


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn
    return add


class Broken(Exception):
    """A failure on purpose."""


def _reports(spark, sf):
    k = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 10 > 0, (k % 3 * 30 + 20)).cast("int").alias("speed_limit"),
        F.when(F.col("o_orderstatus") == "F", "driver").otherwise("passenger").alias("role"))


def _saved_scorer(spark, sf, folder):
    """Severity by speed limit, fitted, saved and loaded again."""
    rows = _reports(spark, sf).filter("speed_limit IS NOT NULL").withColumn("injury_target", ((F.col("speed_limit") - 20) / 30).cast("int"))
    fit = lambda t, y, c: models.decision_tree(t, y, c)
    modelling.train(rows, ["o_orderkey"], ["role"], [], fit, trees=5, outlier=1.0).save(folder)
    return modelling.Scorer.load(spark, folder)


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 10 > 0 THEN (o_custkey % 3)::INT END AS severity, CASE WHEN o_custkey % 10 = 0 THEN 'no speed limit' END AS reason, true AS broke_off FROM orders""")
def stream_once(spark, sf):
    """Reports streamed in several batches through the saved scorer; the second batch breaks off before its
    line, the stream starts again from its checkpoint, and every report is there once."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    scorer = _saved_scorer(spark, sf, f"{folder}/model")
    reports = _reports(spark, sf)
    reports.repartition(6, "o_orderkey").write.parquet(f"{folder}/in")
    score = lambda df: scorer.score(df, ["o_orderkey"]).select("o_orderkey", "severity")
    checks = {"no speed limit": F.col("speed_limit").isNotNull()}

    def break_off(number):
        if number == 1:
            raise Broken("on purpose")

    def run(before_line):
        started = ledger.score_once(spark, reports.schema, f"{folder}/in", f"{folder}/out", f"{folder}/state", score, checks,
                                    max_files=2, before_line=before_line)
        started.awaitTermination()

    broke = False
    try:
        run(break_off)
    except Exception as error:
        if "on purpose" not in str(error):
            raise
        broke = True
    run(None)
    good = ledger.scored(spark, f"{folder}/out", score(reports.limit(0)).schema)
    bad = ledger.rejected(spark, f"{folder}/out", ledger.split(reports, checks)[1].schema)
    return (good.withColumn("reason", F.lit(None).cast("string")).unionByName(
        bad.select("o_orderkey", F.lit(None).cast("int").alias("severity"), "reason")).withColumn("broke_off", F.lit(broke)))
