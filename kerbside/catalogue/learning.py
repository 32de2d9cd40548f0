"""Registered queries: feature preparation and models.  All read whole tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from kerbside.catalogue.tables import r6, table
from kerbside.ml import famd, forest, isolation, models, prepare, search, smote
from kerbside.operators import evaluate, ordered

QUERIES, SQL = {}, {}
CLASSES = [0, 1, 2]


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


@query("""SELECT p_partkey, round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS price,
 CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'PROMO' THEN 2 ELSE -1 END::DOUBLE AS type_code,
 """ + ", ".join(f"CASE WHEN p_type = '{t}' THEN 1.0 ELSE 0.0 END::DOUBLE AS hot{i}" for i, t in enumerate(["STANDARD", "SMALL", "PROMO", "MEDIUM", "LARGE"])) + " FROM part")
def encode_features(spark, sf):
    part = table(spark, sf, "part")
    enc = prepare.fit_encoder(part, one_hots=["p_type"], ordinals={"p_type": ["ECONOMY", "LARGE", "PROMO"]}, numeric=["p_retailprice"], scale="standard")
    a = vector_to_array("features")
    out = enc.transform(part).select("p_partkey", a.alias("v"))
    return out.select("p_partkey", r6(F.col("v")[6]).alias("price"), F.col("v")[5].alias("type_code"), *[F.col("v")[i].alias(f"hot{i}") for i in range(5)])


@query("""SELECT p_partkey, round((p_size - 1.0 * (SELECT min(p_size) FROM part)) / (SELECT max(p_size) - min(p_size) FROM part), 6) AS size_scaled,
 (SELECT count(DISTINCT q.p_type) FROM part q WHERE q.p_type < part.p_type)::DOUBLE AS type_index FROM part""")
def scale_and_index(spark, sf):
    part = table(spark, sf, "part")
    enc = prepare.fit_encoder(part, numeric=["p_size"], scale="minmax")
    out = prepare.label_index(part, "p_type", "type_index").transform(enc.transform(part))
    return out.select("p_partkey", r6(vector_to_array("features")[0]).alias("size_scaled"), "type_index")


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", (F.col("label") % 3).alias("y"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")).cache()


def _predicted(model, rows):
    return model.transform(rows).select("vec_id", "y", F.col("prediction").cast("int").alias("prediction"))


@query()
def ridge(spark, sf):
    rows = _vectors(spark, sf)
    return _predicted(models.ridge(rows, "y", CLASSES), rows)


@query()
def random_forest(spark, sf):
    rows = _vectors(spark, sf)
    return _predicted(models.random_forest(rows, "y", CLASSES, trees=20, depth=6, weights={0: 0.5, 2: 4.0}), rows)


@query()
def decision_tree(spark, sf):
    rows = _vectors(spark, sf)
    return _predicted(models.decision_tree(rows, "y", CLASSES), rows)


@query()
def balanced_forest(spark, sf):
    rows = _vectors(spark, sf)
    return _predicted(models.balanced_forest(rows, "y", CLASSES, ["vec_id"], draws=3, trees=15, depth=6), rows)


@query()
def boosted_trees(spark, sf):
    rows = _vectors(spark, sf)
    return _predicted(models.boosted(rows, "y", CLASSES, rounds=5, depth=3), rows)


@query()
def two_stage(spark, sf):
    rows = _vectors(spark, sf)
    return _predicted(models.two_stage(rows, "y", rounds=5, depth=3), rows)


@query()
def feature_importance(spark, sf):
    rows = _vectors(spark, sf)
    return models.random_forest(rows, "y", CLASSES, trees=20, depth=6).importance(rows, top=40)


@query()
def out_of_fold(spark, sf):
    rows = ordered.stratified_folds(_vectors(spark, sf), "y", ["vec_id"], 3)
    return models.out_of_fold(rows, "fold", 3, lambda t: models.ridge(t, "y", CLASSES)).select("vec_id", "fold", "y", "prediction")


@query()
def parameter_search(spark, sf):
    points = search.draw({"depth": ("int", 2, 5), "bins": [16, 32]}, 3)
    return search.search(_vectors(spark, sf), "y", CLASSES, ["vec_id"], models.decision_tree, points).drop("fold_scores")


_LINES = """p AS (SELECT l_linenumber % 3 AS y, CASE WHEN l_quantity > 30 THEN 0 WHEN l_quantity > 15 THEN 1 ELSE 2 END AS pred, l_quantity / 50.0::DOUBLE AS p0,
  l_tax * 10.0::DOUBLE AS p1, l_discount * 10.0::DOUBLE AS p2 FROM lineitem), n AS (SELECT count(*)::DOUBLE AS n FROM p)"""
_PER = """lab AS (SELECT c, (SELECT count(*) FROM p WHERE y = c)::DOUBLE AS support, (SELECT count(*) FROM p WHERE {pred} = c)::DOUBLE AS said,
  (SELECT count(*) FROM p WHERE y = c AND {pred} = c)::DOUBLE AS tp FROM (VALUES (0), (1), (2)) v(c)),
 f AS (SELECT *, coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(said + support, 0), 0) AS f1 FROM lab),
 al AS (SELECT sum(tp) / sum(support) AS accuracy, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) / sum(support) AS wp,
  sum(recall * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf, sum(support) AS n FROM f),
 ka AS (SELECT 1 - sum((y - {pred}) ** 2) / nullif(sum(y * y) + sum({pred} * {pred}) - 2.0::DOUBLE * sum(y) * sum({pred}) / count(*), 0) AS kappa FROM p)"""
_SCORES = """SELECT '{part}' AS part, 'all' AS row, unnest(['accuracy', 'macro_f1', 'weighted_f1', 'kappa']) AS col, unnest([accuracy, mf, wf, kappa]) AS value FROM al, ka"""
_CURVE = " UNION ALL ".join(f"""SELECT '{c}' AS class, score, sum(n) OVER w AS predicted, sum(pos) OVER w AS tp, pos, sum(pos) OVER () AS positives FROM (
  SELECT p{c} AS score, count(*) AS n, count(*) FILTER (WHERE y = {c}) AS pos FROM p GROUP BY 1) WINDOW w AS (ORDER BY score DESC)""" for c in range(3))
_MAJORITY = "(SELECT y FROM p GROUP BY y ORDER BY count(*) DESC, y LIMIT 1)"


@query(f"""SELECT part, row, col, round(value, 6) AS value FROM (
WITH {_LINES}, {_PER.format(pred='pred')}, cv AS ({_CURVE}), g AS (SELECT t.c AS y, s.c AS pred, (SELECT count(*) FROM p WHERE p.y = t.c AND p.pred = s.c)::DOUBLE AS n FROM lab t, lab s)
SELECT 'confusion_n' AS part, y::VARCHAR AS row, pred::VARCHAR AS col, n AS value FROM g
UNION ALL SELECT 'confusion_share_of_truth', y::VARCHAR, pred::VARCHAR, n / nullif(sum(n) OVER (PARTITION BY y), 0) FROM g
UNION ALL SELECT 'confusion_share_of_pred', y::VARCHAR, pred::VARCHAR, n / nullif(sum(n) OVER (PARTITION BY pred), 0) FROM g
UNION ALL SELECT 'report', c::VARCHAR, unnest(['precision', 'recall', 'f1', 'support']), unnest([precision, recall, f1, support]) FROM f
UNION ALL SELECT 'report', 'accuracy', unnest(['precision', 'recall', 'f1', 'support']), unnest([accuracy, accuracy, accuracy, n]) FROM al
UNION ALL SELECT 'report', 'macro avg', unnest(['precision', 'recall', 'f1', 'support']), unnest([mp, mr, mf, n]) FROM al
UNION ALL SELECT 'report', 'weighted avg', unnest(['precision', 'recall', 'f1', 'support']), unnest([wp, wr, wf, n]) FROM al
UNION ALL {_SCORES.format(part='scores')}
UNION ALL SELECT 'precision', class, predicted::VARCHAR, tp / predicted::DOUBLE FROM cv
UNION ALL SELECT 'recall', class, predicted::VARCHAR, tp / nullif(positives, 0)::DOUBLE FROM cv
UNION ALL SELECT 'average_precision', class, 'average_precision', sum(pos / positives::DOUBLE * tp / predicted::DOUBLE) FROM cv GROUP BY class)
UNION ALL SELECT part, row, col, round(value, 6) FROM (WITH {_LINES}, {_PER.format(pred=_MAJORITY)} {_SCORES.format(part='baseline')})""")
def model_evaluation(spark, sf):
    """Everything an evaluation gives, of given predictions, as one long table."""
    quantity = F.col("l_quantity")
    scored = table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") % 3).cast("int").alias("y"), F.when(quantity > 30, 0).when(quantity > 15, 1).otherwise(2).alias("prediction"),
        F.array(quantity / 50, F.col("l_tax") * 10, F.col("l_discount") * 10).alias("probability"))
    parts = evaluate.evaluate_model(scored, scored, "y", CLASSES)
    return evaluate.as_long(parts).withColumn("value", F.round("value", 6))


@query()
def isolation_forest(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    model = isolation.fit(li, cols, keys, trees=50)
    return model.inliers(li.select(*dict.fromkeys([*keys, *cols])))


@query()
def famd_components(spark, sf):
    li = table(spark, sf, "lineitem")
    model = famd.fit(li, ["l_quantity", "l_extendedprice"], ["l_returnflag", "l_linestatus", "l_linenumber"], 5)
    return model.eigenvalues(spark)


@query()
def famd_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    model = famd.fit(li, ["l_quantity", "l_extendedprice"], ["l_returnflag", "l_linestatus", "l_linenumber"], 2)
    return model.rows(li).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", r6("f0").alias("f0"), r6("f1").alias("f1"))


@query("""WITH c AS (SELECT label % 3 AS y, count(*) AS n FROM embeddings GROUP BY 1) SELECT y, (SELECT max(n) FROM c) - n AS n_new, 64 AS dims FROM c WHERE n < (SELECT max(n) FROM c)""")
def smote_counts(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("y", F.col("label") % 3)
    out = smote.oversample(e, "y", "vec_id", "embedding", k=3)
    return out.groupBy("y").agg(F.count(F.lit(1)).alias("n_new"), F.max(F.size("embedding")).alias("dims"))


@query("""WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT a.id, b.id AS near, round(list_distance(a.v, b.v), 6) AS distance, CAST(row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS INT) AS place
FROM e a JOIN e b ON a.id <> b.id QUALIFY place <= 3""")
def nearest_neighbours(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    out = smote.row_neighbours(e, 3)
    return out.select("id", "near", r6("distance").alias("distance"), "place")


@query("SELECT count(*) AS searched, true AS found_nine_in_ten FROM embeddings WHERE vec_id % 50 = 0")
def forest_recall(spark, sf):
    """Neighbours out of a forest with small leaves, against all distances of every fiftieth vector."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.lit(1).alias("copies"))
    found = forest.neighbours(e, 3, leaf=64, trees=24).filter("id % 50 = 0").select("id", "distance", "place")
    third = smote.nearest_of(e.filter("id % 50 = 0"), e, 3).filter("place = 3").select("id", F.col("distance").alias("d"))
    out = found.join(third, "id", "right").groupBy("id").agg(F.count(F.when(F.col("distance") <= F.col("d") * (1 + 1e-9), 1)).alias("hits"))
    return out.agg(F.count("*").alias("searched"), (F.sum("hits") >= 0.9 * 3 * F.count("*")).alias("found_nine_in_ten"))


@query("""WITH s AS (SELECT s_suppkey AS id, md5('42|' || s_suppkey) AS h FROM supplier WHERE s_suppkey BETWEEN 1 AND 3), n AS (SELECT count(*) - 6 AS need FROM supplier),
t AS (SELECT id, need // 3 + CASE WHEN row_number() OVER (ORDER BY h) <= need % 3 THEN 1 ELSE 0 END AS times, CASE id WHEN 2 THEN 1 ELSE 2 END AS near FROM s, n),
j AS (SELECT id, near, unnest(range(1, times + 1)) AS j FROM t), g AS (SELECT id, near, ('0x' || substr(md5('42|' || id || '|' || j), 20, 13))::BIGINT / 4503599627370496.0::DOUBLE AS g FROM j)
SELECT 1 AS y, round(id + (near - id) * g, 9) AS a, round(2 * id + (2 * near - 2 * id) * g, 9) AS b FROM g""")
def smote_values(spark, sf):
    """Three rows on a line: the nearest of each is known, place and number of new rows come from digests."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey").between(1, 3), 1).otherwise(0).alias("y"),
                                            F.array(F.col("s_suppkey").cast("double"), F.col("s_suppkey") * 2.0).alias("v"))
    out = smote.oversample(s, "y", "id", "v", k=1)
    return out.select("y", F.round(F.col("v")[0], 9).alias("a"), F.round(F.col("v")[1], 9).alias("b"))
