"""Target statistics, grouped prototypes and the projection forest against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbside.catalogue import learning
from kerbside.clustering import grouped, kprototypes
from kerbside.ml import forest, models, smote, target_stats
from kerbside.operators import ordered
from kerbside.plans import modelling
from tests import compare


# ---- target statistics -------------------------------------------------------------------
def rows_with_categories(n=900):
    rng = np.random.default_rng(1)
    kinds = ["hot", None, "", "a\\b", "rare"] + [f"k{i}" for i in range(40)]
    weights = np.array([300, 30, 20, 10, 1] + [2] * 40, float)
    return [(i, str(rng.choice(np.array(kinds, object), p=weights / weights.sum())) if i % 9 else None, [None, 0, 1, 2][int(rng.integers(4))]) for i in range(n)]


def test_ordered_shares(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 1)              # many ranges
    rows = rows_with_categories()
    df = spark.createDataFrame(rows, "id long, kind string, y int").repartition(7)
    out = {r.id: r for r in target_stats.ordered_shares(df, ["kind"], "y", [0, 1, 2], ["id"], prior=2.0).collect()}
    known = [y for _, _, y in rows if y is not None]
    overall = [known.count(c) / len(known) for c in range(3)]
    seen = {}
    for i, kind, y in sorted(rows, key=lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest()):
        before = seen.setdefault(kind, [])
        for c in range(3):
            assert out[i][f"kind_share{c}"] == pytest.approx((before.count(c) + 2 * overall[c]) / (len(before) + 2), abs=1e-12)
        if y is not None:
            before.append(y)
    assert len(out) == len(rows)


def test_stages_and_join_agree(spark):
    rows = rows_with_categories()
    df = spark.createDataFrame(rows, "id long, kind string, y int")
    asked = spark.createDataFrame([(1, "hot"), (2, None), (3, "never met"), (4, ""), (5, "a\\b")], "id long, kind string")
    stages = target_stats.encoder(df, ["kind"], "y", [0, 1, 2]).transform(asked)
    joined = target_stats.with_shares(asked, target_stats.category_shares(df, ["kind"], "y", [0, 1, 2]), ["kind"],
                                      target_stats.class_shares(df, "y", [0, 1, 2]))
    names = target_stats.names("kind", [0, 1, 2])
    a, b = [[[r[n] for n in names] for r in x.orderBy("id").collect()] for x in (stages, joined)]
    assert a == b and a[2] == target_stats.class_shares(df, "y", [0, 1, 2])
    with pytest.raises(ValueError):
        target_stats.share_stages(df, ["kind"], "y", [0, 1, 2], most=3)


def test_boosted_categories_survive_saving(spark, tmp_path):
    rows = spark.range(900).select(
        "id", (F.col("id") % 30 % 3).cast("int").alias("injury_target"), F.concat(F.lit("c"), F.col("id") % 30).alias("kind"),
        (F.col("id") * 7 % 101).cast("int").alias("speed_limit"), F.when(F.col("id") % 2 == 0, "driver").otherwise("passenger").alias("role"))
    fit = lambda t, y, c: models.boosted(t, y, c, rounds=2, depth=2, categories=["kind"], keys=["id"])
    scorer = modelling.train(rows, ["id"], ["role"], [], fit, trees=5, outlier=1.0, categories=["kind"])
    scorer.save(str(tmp_path / "m"))
    again = modelling.Scorer.load(spark, str(tmp_path / "m"))
    reports = rows.filter("id < 60").drop("injury_target")
    first, second = [{r.id: r.prediction for r in s.score(reports, ["id"]).collect()} for s in (scorer, again)]
    assert first == second == {i: i % 30 % 3 for i in range(60)}
    table = again.model.importance(again.encoder.transform(rows))
    assert table.first()["feature"].startswith("kind_share")


# ---- prototypes by group ------------------------------------------------------------------
def mixed(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        y, c = i % 3, i % 2
        rows.append((i, 2000 + y, float(rng.normal(20 * c, 1)) if i % 17 else None, float(rng.normal(0, 1)), ["x", "y", None][c + (i % 13 == 0)], "pq"[(i // 7) % 2]))
    return spark.createDataFrame(rows, "id long, year int, a double, b double, s string, t string").repartition(5)


def test_group_fits_equal_single_fits(spark):
    """All years in one pass give what a fit of each year gives."""
    df = mixed(spark)
    models_ = grouped.GroupedKPrototypes(k=2, numeric=["a", "b"], categorical=["s", "t"], by="year", restarts=3).fit(df)
    out = {r.id: r.cluster for r in grouped.assign(df, models_, "year").collect()}
    assert len(out) == 600 and len(models_.numbers) == 9
    for year in (2000, 2001, 2002):
        own = df.filter(F.col("year") == year)
        single = kprototypes.KPrototypes(k=2, numeric=["a", "b"], categorical=["s", "t"], restarts=3).fit(own)
        best = models_.best(str(year))
        assert models_.cost[best] == pytest.approx(single.cost)
        ids = {r.id: r.cluster for r in single.transform(own).collect()}
        assert {(out[i], c) for i, c in ids.items()} in ({(0, 0), (1, 1)}, {(0, 1), (1, 0)})
    assert models_.converged == set(models_.numbers)


def test_rounds_cost_the_same_for_any_number_of_models(spark):
    df = mixed(spark)
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for by, restarts in ((None, 1), ("year", 4)):
        for rounds in (1, 3):
            group = f"{by}-{restarts}-{rounds}"
            spark.sparkContext.setJobGroup(group, group)
            grouped.GroupedKPrototypes(k=2, numeric=["a", "b"], categorical=["s", "t"], by=by, restarts=restarts, max_rounds=rounds).fit(df)
            jobs[by, rounds] = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[None, 3] - jobs[None, 1] <= jobs["year", 3] - jobs["year", 1] + 1
    assert jobs["year", 1] == jobs[None, 1]


def test_groups_of_few_rows_and_no_numbers(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, 5, "u"), (3, 5, "u"), (4, 5, "v"), (5, 6, None)], "id long, g int, s string")
    model = grouped.GroupedKPrototypes(k=2, categorical=["s"], by="g", restarts=2, gamma=1.0).fit(df)
    out = {r.id: r.cluster for r in grouped.assign(df, model, "g").collect()}
    assert out[2] == out[3] != out[4] and out[1] == out[5] == 0


# ---- projection forest -----------------------------------------------------------------------
def test_cut_keeps_parts_small():
    rng = np.random.default_rng(3)
    for v in (rng.normal(size=(500, 4)), np.repeat([[0.0, 1.0]], 200, 0) + np.arange(200)[:, None] * [1e-9, 0], np.array([[1.0], [1.0 + 2e-16]])):
        cuts = forest.cut(v, 10, 1)
        parts = np.bincount(cuts.part(v))
        assert parts.max() <= 10 and parts.sum() == len(v)


@pytest.mark.parametrize("broadcast_bytes", [1 << 24, 0])
def test_forest_recall_and_leaves(spark, broadcast_bytes):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 1.0, (700, 8)) for c in (0, 4, 9)])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, v array<double>, copies long").repartition(4)
    members = forest.leaves(df, trees=6, leaf=100, broadcast_bytes=broadcast_bytes)
    sizes = members.groupBy("tree", "node").count().collect()
    assert max(r["count"] for r in sizes) <= 100 and sum(r["count"] for r in sizes) == 6 * len(x)
    found = {}
    for r in forest.neighbours(df, 3, trees=6, leaf=100, broadcast_bytes=broadcast_bytes).collect():
        found.setdefault(r.id, {})[r.place] = (r.near, r.distance)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert all(sorted(v) == [1, 2, 3] and v[1][1] <= v[2][1] <= v[3][1] for v in found.values())
    assert all(abs(d[i, n] - dist) < 1e-12 for i, v in found.items() for n, dist in v.values())
    hits = sum(len({n for n, _ in found[i].values()} & set(np.argsort(d[i])[:3])) for i in range(len(x)))
    assert hits / (3 * len(x)) >= 0.9


def test_one_leaf_is_exact(spark):
    x = np.random.default_rng(5).normal(size=(90, 3))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "id long, v array<double>, copies long")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in forest.neighbours(df, 3, leaf=100).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(r.near)
    assert got == {i: list(np.argsort(d[i])[:3]) for i in range(90)}
    assert forest.neighbours(df.limit(0), 3).count() == 0


# ---- exact neighbours ------------------------------------------------------------------------
def test_rows_of_equal_vectors_are_neighbours(spark, tmp_path):
    """The query against its SQL where vectors, ids or whole rows come more than once."""
    rng = np.random.default_rng(6)
    v = [rng.integers(0, 3, 3).astype(float).tolist() for _ in range(90)] + [[1.0, 1.0, 1.0]] * 30
    for kind, ids in (("copies", range(120)), ("ids", [int(i) for i in rng.integers(0, 90, 120)])):
        rows = [*zip(ids, v)] + ([*zip(ids, v)][:40] if kind == "ids" else [])
        folder = str(tmp_path / kind)
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).toPandas().to_parquet(
            (tmp_path / kind).mkdir() or f"{folder}/embeddings.parquet")
        ok, n, _, note = compare.check(spark, compare.connect(folder), kind, learning.QUERIES["nearest_neighbours"], learning.SQL["nearest_neighbours"], folder)
        assert ok and n == 3 * len(set(ids)), note


def test_nearest_of_some_rows(spark, monkeypatch):
    """Against all distances, in many blocks; no row of the plan is a pair."""
    monkeypatch.setattr(smote, "CHUNK_ROWS", 7)
    x = np.random.default_rng(7).integers(0, 4, (300, 3)).astype(float)
    x[5, 1] = np.nan
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, v array<double>").repartition(4)
    got = {}
    for r in smote.nearest_of(df.filter("id % 5 = 0"), df, 3).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append((r.distance, r.near))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert got == {i: sorted((d[i, j], j) for j in range(300) if j not in (i, 5))[:3] for i in range(0, 300, 5) if i != 5}
    plan = learning.forest_recall(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT (id" not in plan and "zip_with" not in plan
