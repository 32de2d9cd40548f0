"""Licence scans: a sparse n-gram logistic regression per paragraph, confirmed by templates.

Paragraphs (lines) that hold one of the licence words are split into words, and those into n-grams
of one to three words. A multinomial logistic regression, fitted to windows of the templates below
and to paragraphs of other kinds, gives each n-gram a weight per family; most weights are zero
and are left out. Scoring is SQL: n-grams are joined with the table of weights and summed up per
paragraph and family. Probabilities are calibrated by a temperature chosen on windows held out of
the fit; a paragraph is ``unknown`` if that class or no family above ``LEAST`` wins.

A prediction stands if one of the family's templates is found: at least 0.8 of its five-word
shingles are in the paragraph (a shorter template counts as one shingle). Else it is unknown.

Null and empty texts have no paragraph; repeated rows give repeated results; empty tables give
empty results; extra columns are ignored; texts are read whole, very long paragraphs too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import stored

UNKNOWN = "unknown"
LEAST = 0.3              # calibrated probability a family needs; a template confirms it after that
SHINGLE, SHARE = 5, 0.8
NEGATIVES = 2_000        # paragraphs of other kinds the model is fitted to, at most
VOCABULARY = 1 << 14
TEMPERATURES = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
# fixed values: words of which a licence paragraph has one
ANCHORS = ("licen[cs]", "copyright", "copyleft", "permission", "permitted", "redistribut", "warrant",
           "public domain", "spdx", "\\bgnu\\b", "\\bgpl", "\\bbsd\\b", "creative commons", "\\bcc[ -]")
# parts of them, one of which is in every text that has such a word: found faster than a pattern
PARTS = ("licens", "licenc", "copyright", "copyleft", "permission", "permitted", "redistribut", "warrant", "public domain",
         "spdx", "gnu", "gpl", "bsd", "creative commons", "cc ", "cc-")
# fixed values: notices of the families, and notices that belong to none
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License."),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
    ("public-domain", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0."),
    (UNKNOWN, "Copyright by the authors. All rights reserved. No part of this may be copied without permission."),
    (UNKNOWN, "Please ask for permission before you use our pictures."),
    (UNKNOWN, "A driving licence is needed for this work, and a fishing license for that."),
    (UNKNOWN, "The warranty covers parts and labour for two years."),
    (UNKNOWN, "Licensed under the terms of the agreement between you and the company."),
]


def words(text: Column) -> Column:
    """Words of a paragraph, lower case, with inner dots and hyphens."""
    clean = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9.+\-]+|[.\-]+(?![a-z0-9])|(?<![a-z0-9])[.\-]+", " "))
    return F.filter(F.split(clean, " +"), lambda w: w != "")


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """Every run of ``low`` to ``high`` words; all words if there are fewer than ``low``."""
    def runs(n):
        return F.when(F.size(tokens) >= n, F.transform(
            F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
            lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[runs(n) for n in range(low, high + 1)]))


def shingles(tokens: Column) -> Column:
    return F.when(F.size(tokens) >= SHINGLE, ngrams(tokens, SHINGLE, SHINGLE)).when(
        F.size(tokens) > 0, F.array(F.array_join(tokens, " ")))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, text) of the lines with a licence word; paragraph counts from 0."""
    return (docs.where(_may_hold("text"))
            .select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "text"))
            .where(_may_hold("text")).where(F.col("text").rlike("(?i)" + "|".join(ANCHORS))))


def _may_hold(text: str) -> Column:
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in PARTS])


def training_rows(spark: SparkSession, others: DataFrame) -> DataFrame:
    """(family, template, tokens, held): windows of the templates of at least five words, and other paragraphs.

    Every fifth window is held out, by its digest, but whole templates never are.
    """
    given = (spark.createDataFrame(TEMPLATES, "family string, text string").withColumn("tokens", words(F.col("text")))
             .withColumn("template", F.xxhash64("text")))
    n = F.size("tokens")
    windows = (given.select("family", "template", "tokens", F.explode(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0)))).alias("a"))
               .select("family", "template", "tokens", n.alias("n"), "a", F.explode(F.sequence(F.least(F.lit(SHINGLE), n), n - F.col("a"))).alias("k"))
               .select("family", "template", F.slice("tokens", F.col("a") + 1, F.col("k")).alias("tokens"), (F.col("k") == F.col("n")).alias("whole")))
    plain = (others.where(~_may_hold("text"))
             .orderBy(F.xxhash64("text"), "text").limit(NEGATIVES)
             .select(F.lit(UNKNOWN).alias("family"), F.lit(0).cast("long").alias("template"), words(F.col("text")).alias("tokens"),
                     F.lit(False).alias("whole")))
    rows = windows.unionByName(plain).where(F.size("tokens") > 0)
    return rows.withColumn("held", ~F.col("whole") & (F.pmod(F.xxhash64("tokens"), F.lit(5)) == 0))


def fit(spark: SparkSession, others: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """(weights (gram, family, weight), biases (family, bias), temperature); tables of bounded size."""
    rows = training_rows(spark, others).select("family", "template", "held", "whole", ngrams(F.col("tokens"), 1, 3).alias("grams")).coalesce(2).persist()      # a few thousand rows
    families = sorted({f for f, _ in TEMPLATES})
    labelled = rows.withColumn("label", F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1)
    counts = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=1.0, binary=True)
    vocabulary = counts.fit(labelled.where("not held"))
    # every template weighs as much as another, however many windows it has, and half of that whole;
    # so do the other paragraphs together
    each = labelled.where("not held").groupBy("template").agg(F.count("*").alias("n"))
    weighted = (vocabulary.transform(labelled.where("not held")).join(F.broadcast(each), "template")
                .withColumn("weight", F.when(F.col("whole"), 100.0).otherwise(0.0) + 100 / F.col("n")).select("features", "label", "weight").persist())
    model = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.5, maxIter=25, weightCol="weight",
                               standardization=False).fit(weighted)
    weighted.unpersist()
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = spark.createDataFrame(
        [(g, families[k], float(matrix[k, i])) for i, g in enumerate(vocabulary.vocabulary) for k in range(len(families))
         if abs(matrix[k, i]) > 1e-6] or [("", UNKNOWN, 0.0)], "gram string, family string, weight double")
    biases = spark.createDataFrame([(f, float(b)) for f, b in zip(families, bias)], "family string, bias double")
    held = labelled.where("held").withColumn("id", F.monotonically_increasing_id()).select("id", "family", "grams").persist()
    margins = _margins(held.select("id", "grams"), ["id"], weights, biases).persist()
    truth = held.select("id", F.col("family").alias("truth"))
    losses = margins.select("id", "family", "margin", F.explode(F.array(*[F.lit(t) for t in TEMPERATURES])).alias("t"))
    losses = (losses.groupBy("id", "t").agg(
        F.max(F.col("margin") / F.col("t")).alias("top"),
        F.collect_list(F.struct("family", "margin")).alias("all"))
        .join(truth, "id").select("t", (F.col("top") + F.log(F.aggregate(
            "all", F.lit(0.0), lambda s, m: s + F.exp(m.margin / F.col("t") - F.col("top"))))
            - F.aggregate("all", F.lit(0.0), lambda s, m: s + F.when(m.family == F.col("truth"), m.margin / F.col("t"))
                          .otherwise(0.0))).alias("loss")))
    best = losses.groupBy("t").agg(F.avg("loss").alias("loss")).orderBy("loss", "t").first()
    for held_table in (rows, held, margins):
        held_table.unpersist()
    return weights, biases, best["t"] if best else 1.0


def _margins(rows: DataFrame, keys: list[str], weights: DataFrame, biases: DataFrame) -> DataFrame:
    """(keys, family, margin) for every family; rows without a weighted n-gram have the biases alone."""
    sums = (rows.select(*keys, F.explode("grams").alias("gram")).join(F.broadcast(weights), "gram")
            .groupBy(*keys, "family").agg(F.sum("weight").alias("sum")))
    families = F.array(*[F.struct(F.lit(r["family"]).alias("family"), F.lit(r["bias"]).alias("bias"))
                         for r in biases.collect()])
    every = rows.select(*keys, F.explode(families).alias("f")).select(*keys, "f.family", "f.bias")
    return (every.join(sums, [*keys, "family"], "left")
            .select(*keys, "family", (F.col("bias") + F.coalesce("sum", F.lit(0.0))).alias("margin")))


def scan(docs: DataFrame, model: tuple[DataFrame, DataFrame, float]) -> DataFrame:
    """Per paragraph with a licence word: doc_id, paragraph, predicted, probability, share, family.

    ``family`` is the prediction if a template confirms it, else ``unknown``; ``share`` is the best
    share of a template of the predicted family.
    """
    weights, biases, temperature = model
    spark = docs.sparkSession
    # equal paragraphs are judged once, however many documents hold them
    lines = stored(paragraphs(docs), "licence-paragraphs")
    texts = lines.groupBy("text").agg(F.lit(1).alias("one")).select("text", words(F.col("text")).alias("tokens"))
    margins = _margins(texts.select("text", ngrams(F.col("tokens"), 1, 3).alias("grams")), ["text"], weights, biases)
    scaled = margins.withColumn("z", F.col("margin") / temperature)
    top = (scaled.groupBy("text").agg(F.max(F.struct("z", "family")).alias("best"), F.collect_list("z").alias("all"))
           .select("text", F.col("best.family").alias("first"), (1 / F.aggregate(
               "all", F.lit(0.0), lambda s, z: s + F.exp(z - F.col("best.z")))).alias("probability"))
           .withColumn("predicted", F.when(F.col("probability") >= LEAST, F.col("first")).otherwise(UNKNOWN)))
    given = (spark.createDataFrame(TEMPLATES, "predicted string, template string")
             .select("predicted", shingles(words(F.col("template"))).alias("wanted")))
    share = F.size(F.array_intersect("wanted", "shingles")) / F.size("wanted")
    confirmed = (top.where(F.col("predicted") != UNKNOWN).join(
        texts.select("text", shingles(F.col("tokens")).alias("shingles")), "text")
        .join(F.broadcast(given), "predicted").groupBy("text").agg(F.max(share).alias("share")))
    judged = (top.join(confirmed, "text", "left")
              .select("text", "predicted", "probability", F.coalesce("share", F.lit(0.0)).alias("share")))
    return (lines.join(judged, "text").select(
        "doc_id", "paragraph", "predicted", F.round("probability", 6).alias("probability"), F.round("share", 6).alias("share"),
        F.when(F.col("share") >= SHARE, F.col("predicted")).otherwise(UNKNOWN).alias("family")))


def find(docs: DataFrame) -> DataFrame:
    """``scan`` with a model fitted to the templates and a bounded number of the documents' other paragraphs."""
    others = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("text")).where("text <> ''")
    return scan(docs, fit(docs.sparkSession, others))
