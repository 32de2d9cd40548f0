"""The modelling plan, the saved scorer, and loops and draws beyond their former limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.clustering import dbscan, kprototypes, silhouette
from kerbside.functions import columns as fc
from kerbside.ml import isolation, models
from kerbside.plans import modelling
from kerbside.streaming import scoring


def test_prepared(spark):
    rows = spark.createDataFrame(
        [(1, None, 0, -1, "Night", 2), (2, 5, 0, None, "Midday", 1), (3, 5, -1, 4, "Night", 0), (4, 5, 3, 4, "Nowhen", 0), (5, 5, 3, 4, None, 0)],
        "id int, age int, location int, sex int, time_of_day string, injury_target int")
    out = modelling.prepared(rows.withColumn("year", F.lit(None).cast("int")), keep=["id", "year"]).orderBy("id").collect()
    assert [(r.id, r.sex, r.time_of_day_code, r.injury_target_code, r.year) for r in out] == [(1, -1, 3, 2, None), (2, -1, 1, 1, None)]
    assert "age" not in out[0].asDict()


@pytest.fixture(scope="module")
def scorer(spark):
    rows = spark.range(600).select(
        "id", (F.col("id") % 3).cast("int").alias("injury_target"), (F.col("id") % 3 * 30 + 20).cast("int").alias("speed_limit"),
        F.when(F.col("id") % 2 == 0, "driver").otherwise("passenger").alias("role"), (F.col("id") % 4).cast("int").alias("weather_ordinal"),
        *[(F.col("id") * p % 601).cast("int").alias(f"x{p}") for p in (7, 91, 255)])
    return modelling.train(rows, ["id"], ["role"], ["weather_ordinal"], lambda t, y, c: models.decision_tree(t, y, c),
                           numeric=["speed_limit", "x7", "x91", "x255"], trees=20, outlier=1.0)


def test_scorer_survives_saving(spark, scorer, tmp_path):
    reports = spark.createDataFrame([(1, 20, "driver", 1), (2, 80, "passenger", 2), (3, 50, "unheard of", 9), (4, None, None, None)],
                                    "id int, speed_limit int, role string, weather_ordinal int")
    scorer.save(str(tmp_path / "model"))
    again = modelling.Scorer.load(spark, str(tmp_path / "model"))
    first, second = [s.score(reports, ["id"]).orderBy("id").collect() for s in (scorer, again)]
    assert first == second
    assert [r.prediction for r in first[:3]] == [0, 2, 1] and first[1].risk == "HIGH RISK"


def test_scorer_on_a_stream(spark, scorer, tmp_path):
    reports = spark.createDataFrame([(i, 20 + 30 * (i % 3), "driver", 1) for i in range(30)],
                                    "id int, speed_limit int, role string, weather_ordinal int")
    reports.write.parquet(str(tmp_path / "in"))
    scoring.score_stream(spark, reports.schema, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"),
                         lambda r: scorer.score(r, ["id"])).awaitTermination()
    got = {r.id: r.prediction for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {i: i % 3 for i in range(30)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)], "u long, v long")
    assert {r.component for r in dbscan.components(edges).collect()} == {0}


def test_draw_position_reaches_all_of_a_large_pool(spark):
    digits = spark.range(2000).select(fc.hash_unit(fc.shuffle_key([F.col("id")])).alias("u")).collect()
    assert any((r.u * 16 ** 7) % 1 for r in digits) and all(0 <= r.u < 1 for r in digits)


def test_trees_draw_from_all_rows(spark):
    rows = spark.range(100_000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    model = isolation.fit(rows, ["a", "b"], ["id"], trees=8)
    assert len(model.trees) == 8 and model.sample == 256
    far = spark.createDataFrame([(1, 0.5, 0.5), (2, 9.0, -9.0)], "id long, a double, b double")
    inner, outer = [r.anomaly_score for r in model.transform(far).orderBy("id").collect()]
    assert outer > inner


def test_kprototypes_says_whether_it_converged(spark):
    rows = spark.range(300).select((F.col("id") % 100 * 1.0).alias("x"), (F.col("id") % 2).cast("string").alias("c"))
    free = kprototypes.KPrototypes(k=3, numeric=["x"], categorical=["c"], restarts=1).fit(rows)
    cut = kprototypes.KPrototypes(k=3, numeric=["x"], categorical=["c"], restarts=1, max_rounds=1).fit(rows)
    assert free.converged and not cut.converged


def test_silhouette_beyond_one_block(spark):
    rng = np.random.default_rng(0)
    x, labels = rng.normal(size=(300, 2)), rng.integers(0, 3, 300)
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, labels)], "v array<double>, l int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    scores = []
    for i in range(300):
        mean = {c: d[i, labels == c].sum() / ((labels == c).sum() - (c == labels[i])) for c in range(3)}
        a = mean.pop(labels[i])
        scores.append((min(mean.values()) - a) / max(a, *[min(mean.values())]))
    got = silhouette.euclidean_silhouette(df, "v", "l", block=64).first()["silhouette"]
    assert abs(got - np.mean(scores)) < 1e-9


def test_euclidean_silhouette_asks_few_clusters(spark):
    """Far clusters are not compared; the measure is the one of all distances."""
    rng = np.random.default_rng(12)
    labels = rng.integers(0, 12, 500)
    x = rng.normal(0, 1, (500, 3)) + np.array([[20 * (k % 4), 20 * (k // 4), k % 2] for k in labels])
    rows = [(int(a), v.tolist()) for a, v in zip(labels, x)] + [(77, [0.0, 0.0, 0.0]), (-1, [5.0, 5.0, 5.0])]
    df = spark.createDataFrame(rows, "l int, v array<double>").repartition(4)
    kept = [(a, np.array(v)) for a, v in rows if a != -1]
    y, lab = np.stack([v for _, v in kept]), np.array([a for a, _ in kept])
    d = np.sqrt(((y[:, None] - y[None]) ** 2).sum(2))
    scores = []
    for i, a in enumerate(lab):
        own = lab == a
        means = [d[i, lab == c].mean() for c in set(lab) - {a}]
        inner = d[i, own].sum() / max(own.sum() - 1, 1)
        scores.append((min(means) - inner) / max(min(means), inner) if own.sum() > 1 else 0.0)
    for block in (50, 4096):
        got = silhouette.euclidean_silhouette(df, "v", "l", block=block).first()
        assert (got["silhouette"], got["clusters"]) == (pytest.approx(np.mean(scores)), 13)
    held = df.filter("l <> -1").select(F.monotonically_increasing_id().alias("_id"), F.col("l").alias("_l"), F.col("v").alias("_v"))
    sums = silhouette.cluster_sums(held, "_v", "_l", 3)
    for cells in (9, 10 ** 6):                                    # the cluster table in several parts, and whole
        asked = silhouette.asked_clusters(held, sums, 3, "int", cells).groupBy("_id").count().collect()
        assert len(asked) == 501 and np.mean([r["count"] for r in asked]) < 6


def test_squared_silhouette_of_many_parts(spark):
    rng = np.random.default_rng(13)
    rows = [(int(k), rng.normal(k, 1, 2).tolist()) for k in rng.integers(0, 9, 300)]
    df = spark.createDataFrame(rows, "l int, v array<double>").withColumn("i", F.monotonically_increasing_id())
    few, whole = [{r.i: r.s for r in silhouette.squared_per_row(df, "v", "l", "s", cells).collect()} for cells in (4, 10 ** 6)]
    assert few == pytest.approx(whole)
