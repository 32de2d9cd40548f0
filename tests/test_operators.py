"""Operators against brute force on small tables, with hot keys and copies."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from kerbside.clustering import dbscan as db
from kerbside.clustering import silhouette
from kerbside.ml import famd, isolation, models, prepare, smote
from kerbside.operators import clean, compare, joins, ordered, profile, stats
from kerbside.sources import raw, sinks
from kerbside.streaming import scoring


# ---- order ---------------------------------------------------------------------------
@pytest.mark.parametrize("parts", [1, 7])
def test_numbering_with_a_hot_key(spark, parts):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50).alias("k"))
    out = ordered.row_number_in_group(df.repartition(parts), ["k"], [F.col("id")], F.floor(F.col("id") / 100))
    want = {}
    for r in out.orderBy("id").collect():
        want[r["k"]] = want.get(r["k"], 0) + 1
        assert r["rn"] == want[r["k"]]


def test_sampling_does_not_depend_on_layout(spark):
    df = spark.range(3000).select("id", (F.pmod(F.col("id"), F.lit(10)) > 6).cast("int").alias("y"))
    def picked(d): return sorted(r["id"] for r in ordered.undersample(d, "y", ["id"]).collect())
    a, b = picked(df.coalesce(1)), picked(df.repartition(9))
    assert a == b and len(a) == 1800
    folds = ordered.stratified_folds(df, "y", ["id"], 3).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds if r["y"] == 1} == {300}


def test_more_wanted_than_there_is(spark):
    df = spark.range(10).withColumn("y", F.lit(1))
    need = spark.createDataFrame([(1, 50)], "y int, need long")
    assert ordered.first_by_hash(df, "y", ["id"], need).count() == 10


def test_running_sums(spark):
    rng = random.Random(1)
    values = sorted({rng.expovariate(0.01) for _ in range(2000)})
    df = spark.createDataFrame([("a", v, i % 7) for i, v in enumerate(values)], "g string, v double, n long")
    out = ordered.running_sums(df, ["g"], "v", ["n"], bits=5).orderBy("v").collect()
    assert [r["n_cum"] for r in out] == list(np.cumsum([i % 7 for i in range(len(values))]))


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random(3000) < 0.34, 5.0, rng.lognormal(2, 2, 3000))
    g = rng.integers(0, 3, 3000)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g int, x double").union(
        spark.createDataFrame([(0, None), (0, float("nan"))], "g int, x double"))
    probs = [0, 0.1, 0.25, 0.5, 0.9, 1]
    for r in profile.exact_quantiles(df, ["x"], probs, ["g"]).collect():
        assert r["quantile"] == pytest.approx(np.quantile(x[g == r["g"]], r["prob"]))


# ---- joins -----------------------------------------------------------------------------
def test_opponents_with_repeated_and_unknown_members(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4, 5, 6]), rng.choice([None, 1, 2, 3, 4]), rng.randint(1, 3), i) for i in range(60)]
    rows.append((99, 7, 1, 60))
    df = spark.createDataFrame(rows, "g int, m int, s int, p int")
    got = {(r["g"], r["m"]): (r["p"], r["p_other"]) for r in joins.with_opponent(df, "g", "m", "s", F.col("p"), ["p", "s"]).collect()}
    want = {}
    for g, m in {(r[0], r[1]) for r in rows}:
        own = max(r[3] for r in rows if r[0] == g and r[1] == m)
        others = [r for r in rows if r[0] == g and r[1] != m]
        want[(g, m)] = (own, max(others, key=lambda r: (r[2], r[3]))[3] if others else None)
    assert got == want


def test_null_safe_join_and_swap(spark):
    a = spark.createDataFrame([(1, None, "u"), (1, 5, "v")], "k int, m int, x string")
    b = spark.createDataFrame([(1, None, "n"), (2, 5, "z")], "k int, m int, y string")
    out = {r["x"]: r["y"] for r in joins.left_null_safe(a, b, ["k", "m"], ["m"]).collect()}
    assert out == {"u": "n", "v": None}


# ---- cleaning and comparison -------------------------------------------------------------
def test_text_to_number(spark):
    from kerbside.functions import columns as fc
    df = spark.createDataFrame([("138 306 524", "1,5", " 3 ", "#VALEURMULTI"), ("x", "", "4.0", "2")], "a string, b string, c string, d string")
    out = df.select(fc.blank_free_long("a").alias("a"), fc.decimal_comma("b").alias("b"), fc.code("c").alias("c"), fc.lane_count("d").alias("d")).collect()
    assert [tuple(r) for r in out] == [(138306524, 1.5, 3, -1.0), (None, None, 4, 2.0)]


def test_complete_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (-1, 2, "a"), (2, -1, "-1")], "a int, b int, c string")
    assert [tuple(r) for r in clean.complete_rows(df, ["b"]).collect()] == [(1, -1, "a")]


def test_table_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = a.select("s", "i")
    assert compare.tables_equal(a, b) and not compare.tables_equal(a, b, column_order=True)
    assert not compare.tables_equal(a, a.distinct())
    assert not compare.tables_equal(a, a.withColumn("i", F.col("i").cast("long")))


# ---- statistics ----------------------------------------------------------------------------
def test_tail_probabilities():
    assert stats.upper_gamma(1.0, 3.0) == pytest.approx(math.exp(-3))
    assert stats.upper_gamma(0.5, 1.92072941) == pytest.approx(0.05, abs=1e-6)     # chi2 3.8414588, 1 dof
    assert stats.beta_tail(2.0, 3.0, 0.4) == pytest.approx(0.5248)
    assert stats.beta_tail(0.5, 0.5, 0.5) == pytest.approx(0.5)


def test_p_values(spark):
    rows = [(i % 2, int(i % 2 == 0 or i % 7 == 0), float(i % 2 * 10 + i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "f int, t int, x double")
    assert stats.chi2_independence(df, ["f"], "t").first()["significant"]
    r = stats.anova(df, ["x"], "t").first()
    assert r["df_between"] == 1 and r["p_value"] < 1e-6


# ---- clustering ----------------------------------------------------------------------------
def brute_dbscan(points, eps, least):
    n = len(points)
    near = [[j for j in range(n) if (points[i][0] - points[j][0]) ** 2 + (points[i][1] - points[j][1]) ** 2 <= eps * eps] for i in range(n)]
    core = [len(x) >= least for x in near]
    label = [-1] * n
    for i in range(n):
        if core[i] and label[i] == -1:
            stack = [i]
            while stack:
                a = stack.pop()
                if label[a] == -1:
                    label[a] = i
                    stack += [b for b in near[a] if core[b] and label[b] == -1]
    for i in range(n):
        if not core[i]:
            label[i] = min((label[j] for j in near[i] if core[j]), default=-1)
    return label


def test_dbscan_with_copies_and_chains(spark):
    rng = random.Random(5)
    points = [(1.0, 1.0)] * 150                                          # a third are copies
    points += [(rng.uniform(0, 6), rng.uniform(0, 6)) for _ in range(200)]
    points += [(8 + 0.24 * i, 3.0) for i in range(60)]                   # a long chain
    points += [(round(rng.uniform(0, 2), 1), round(rng.uniform(7, 9), 1)) for _ in range(60)]   # a lattice
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    got = {r["id"]: r["cluster"] for r in db.dbscan(df, "id", "x", "y", 0.25, 4).collect()}
    assert [got[i] for i in range(len(points))] == brute_dbscan(points, 0.25, 4)


def test_one_cluster_has_no_silhouette(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(5)], "id int, v array<double>, l int")
    assert silhouette.squared_silhouette(df, "v", "l").first()["silhouette"] is None
    assert "1 cluster" in silhouette.euclidean_silhouette(df, "v", "l").first()["message"]


# ---- models ----------------------------------------------------------------------------------
def test_neighbours_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(smote, "CHUNK_ROWS", 16)
    monkeypatch.setattr(smote, "PIVOTS", 6)
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.3, (60, 3)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, v array<double>, copies long")
    got = {}
    for r in smote.neighbours(df, 3).orderBy("id", "place").collect():
        got.setdefault(r["id"], []).append(r["near"])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert got == {i: list(np.argsort(d[i])[:3]) for i in range(len(x))}


def test_oversampling(spark):
    rows = [(i, 0, [float(i), 0.0]) for i in range(40)] + [(100 + i, 1, [1.0, 1.0] if i < 6 else [float(i), 2.0]) for i in range(11)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    out = smote.oversample(df, "y", "id", "v").collect()
    assert len(out) == 29 and {r["y"] for r in out} == {1}
    assert all(1.0 <= r["v"][0] <= 10.0 and 1.0 <= r["v"][1] <= 2.0 for r in out)


def test_isolation_forest(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (400, 2)))] + [(900, 30.0, -30.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    model = isolation.fit(df, ["a", "b"], ["id"], trees=60)
    again = isolation.fit(df.repartition(5), ["a", "b"], ["id"], trees=60)
    top = model.transform(df).orderBy(F.desc("anomaly_score")).first()
    assert top["id"] == 900 and top["anomaly_score"] > 0.7
    assert again.transform(df).orderBy(F.desc("anomaly_score")).first()["anomaly_score"] == pytest.approx(top["anomaly_score"])
    assert 900 not in [r["id"] for r in model.inliers(df).collect()]


def test_famd(spark):
    rng = np.random.default_rng(9)
    rows = [(i, float(a), float(a + b), "xyz"[i % 3], "pq"[int(a > 0)]) for i, (a, b) in enumerate(rng.normal(0, 1, (120, 2)))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c string, d string")
    model = famd.fit(df, ["a", "b"], ["c", "d"], 3)
    cols = []
    for k in (1, 2):
        v = np.array([r[k] for r in rows]); cols.append((v - v.mean()) / v.std())
    for k in (3, 4):
        for u in sorted({r[k] for r in rows}):
            z = np.array([float(r[k] == u) for r in rows]); p = z.mean(); cols.append(z / p ** 0.5 - p ** 0.5)
    m = np.array(cols).T
    want = np.linalg.eigvalsh(m.T @ m / len(rows))[::-1][:3]
    assert model.values == pytest.approx(want)
    out = model.rows(df).orderBy("id").select("f0", "f1").toPandas().to_numpy()
    assert np.abs(out) == pytest.approx(np.abs(m @ model.vectors[:, :2]))
    assert model.columns(spark).groupBy("component").agg(F.sum("contribution").alias("s")).first()["s"] == pytest.approx(1)


def _learning(spark, n=240):
    rng = np.random.default_rng(10)
    rows = []
    for i in range(n):
        y = i % 3
        rows.append((i, y, [float(v) for v in rng.normal(y, 0.8, 4)]))
    return spark.createDataFrame(rows, "id long, y int, v array<double>").withColumn("features", array_to_vector("v")).cache()


def test_ridge_matches_the_closed_form(spark):
    df = _learning(spark)
    model = models.ridge(df, "y", [0, 1, 2], alpha=1.5)
    x = np.array([r["v"] for r in df.orderBy("id").collect()])
    y = np.array([r["y"] for r in df.orderBy("id").collect()])
    xc = x - x.mean(0)
    for c, part in enumerate(model.pipeline.stages):
        t = np.where(y == c, 1.0, -1.0)
        w = np.linalg.solve(xc.T @ xc + 1.5 * np.eye(4), xc.T @ (t - t.mean()))
        assert part.coefficients.toArray() == pytest.approx(w, abs=1e-4)


def test_models_give_probabilities(spark, tmp_path):
    df = _learning(spark)
    for model in (models.boosted(df, "y", [0, 1, 2], rounds=3, depth=2), models.two_stage(df, "y", rounds=3, depth=2),
                  models.balanced_forest(df, "y", [0, 1, 2], ["id"], draws=2, trees=6, depth=4)):
        out = model.transform(df)
        total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
        r = out.agg(F.min(total).alias("a"), F.max(total).alias("b"), F.avg((F.col("prediction") == F.col("y")).cast("int")).alias("hit")).first()
        assert r["a"] == pytest.approx(1) and r["b"] == pytest.approx(1) and r["hit"] > 0.6
    sinks.save_model(model.pipeline, model.metadata(), str(tmp_path / "m"))
    pipeline, meta = sinks.load_model(spark, str(tmp_path / "m"))
    loaded = models.SeverityModel(pipeline, **meta)
    assert loaded.transform(df).select("prediction").collect() == out.select("prediction").collect()


def test_unknown_categories(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    enc = prepare.fit_encoder(train, one_hots=["c"], ordinals=["c"])
    test = spark.createDataFrame([("a",), ("c",), ("zzz",), (None,)], "c string")
    got = [r["v"] for r in enc.transform(test).select(vector_to_array("features").alias("v")).collect()]
    assert got == [[0, 0, 0], [1, 0, 2], [0, 0, -1], [0, 0, -1]]


# ---- sources, sinks, streaming -----------------------------------------------------------------
def test_stage_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2022, 1, "a;b"), (2023, 2, None)], "year int, x int, s string")
    sinks.write_stages({"C": df}, str(tmp_path))
    back = raw.read_stage(spark, str(tmp_path / "C"), "csv", schema="x int, s string, year int")
    assert compare.tables_equal(df, back)
    sinks.write_stage(df, str(tmp_path / "P"))
    assert raw.read_stage_year(spark, str(tmp_path / "P"), 2023).count() == 1
    sinks.write_sets(df, df.limit(1), str(tmp_path / "sets"))
    assert spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "sets/train_val_data.csv.gz")).count() == 2
    with open(tmp_path / "one.csv", "w") as f:
        f.write("a,b\n1,2\n3,4\n")
    shapes = raw.folder_shapes(spark, str(tmp_path)).collect()
    assert [(r["table"], r["rows"], r["columns"]) for r in shapes] == [("one.csv", 2, 2)]


def test_stream_scoring(spark, tmp_path):
    schema = "id long, hour int, day_of_week int, age int, vehicle_category string, vehicle_category_other string, v array<double>"
    rows = [(i, i % 24, i % 7, i, "bicycle", None, [float(i % 3)] * 4) for i in range(50)]
    reports = spark.createDataFrame(rows, schema)
    reports.write.parquet(str(tmp_path / "in"))
    model = models.boosted(_learning(spark), "y", [0, 1, 2], rounds=2, depth=2)

    def score(df):
        return scoring.with_severity(model.transform(scoring.derive(df).withColumn("features", array_to_vector("v")))).drop("features")
    q = scoring.score_stream(spark, reports.schema, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt"), score)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 50
    cols = ["id", "severity", "risk", "impact_delta", "age_group"]
    assert compare.tables_equal(got.select(cols), score(reports).select(cols))
