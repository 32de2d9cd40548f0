"""Registered queries: models on data whose answer SQL can state (closed forms, exhaustive splits, separable targets)."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbside.catalogue import accident, clusters
from kerbside.catalogue.tables import r6, table
from kerbside.clustering import gower, kprototypes, profile, sweep
from kerbside.functions import columns as fc
from kerbside.ml import famd, isolation, models, prepare, search
from kerbside.operators import clean, impute, ordered, stats
from kerbside.operators import profile as columns_profile
from kerbside.sources import raw, schemas

QUERIES, SQL = {}, {}
CLASSES = [0, 1, 2]


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


def _vector(*cells):
    return array_to_vector(F.array(*[c.cast("double") for c in cells]))


def _separable(spark, sf):
    """A class that the first feature separates; the second one is noise."""
    y = F.col("label") % 3
    return table(spark, sf, "embeddings").select(
        "vec_id", y.alias("y"), _vector(y * 10, F.col("embedding")[1]).alias("features"))


_SEPARABLE = "SELECT vec_id, label % 3 AS y, label % 3 AS prediction FROM embeddings"


def _exact(model, rows):
    return model.transform(rows).select("vec_id", "y", F.col("prediction").cast("int").alias("prediction"))


# ---- linear: closed form -------------------------------------------------------------
_RIDGE = """WITH e AS (SELECT vec_id, label % 3 AS y, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings),
t AS (SELECT c, e.*, CASE WHEN y = c THEN 1.0 ELSE -1.0 END::DOUBLE AS s FROM e, (VALUES (0), (1), (2)) v(c)),
m AS (SELECT c, count(*) * var_pop(a) + 1.5 AS aa, count(*) * var_pop(b) + 1.5 AS bb, count(*) * covar_pop(a, b) AS ab, count(*) * covar_pop(a, s) AS sa,
  count(*) * covar_pop(b, s) AS sb, avg(a) AS ma, avg(b) AS mb, avg(s) AS ms FROM t GROUP BY c),
w AS (SELECT c, ma, mb, ms, (sa * bb - sb * ab) / (aa * bb - ab * ab) AS wa, (sb * aa - sa * ab) / (aa * bb - ab * ab) AS wb FROM m),
p AS (SELECT vec_id, c, ms + wa * (a - ma) + wb * (b - mb) AS v FROM e, w)
SELECT vec_id, """ + ", ".join(f"round(max(v) FILTER (WHERE c = {c}), 6) AS s{c}" for c in CLASSES) + ", CAST(arg_max(c, v) AS INT) AS prediction FROM p GROUP BY vec_id"


@query(_RIDGE)
def ridge_scores(spark, sf):
    e = table(spark, sf, "embeddings")
    rows = e.select("vec_id", (F.col("label") % 3).alias("y"), _vector(F.col("embedding")[0], F.col("embedding")[1]).alias("features"))
    out = models.ridge(rows, "y", CLASSES).transform(rows)
    return out.select("vec_id", *[r6(F.col("scores")[c]).alias(f"s{c}") for c in CLASSES], F.col("prediction").cast("int").alias("prediction"))


# ---- trees ----------------------------------------------------------------------------
_STUMP = """WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber > 4 AND l_quantity > 10 THEN 2 WHEN l_quantity > 40 THEN 1 ELSE 0 END AS y FROM lineitem),
s AS (SELECT t, l_linenumber > t AS above, y, count(*) AS n FROM li, range(1, 7) r(t) GROUP BY ALL),
g AS (SELECT t, above, sum(n) AS n, sum(n) - sum(n * n) * 1.0 / sum(n) AS impurity, arg_max(y, (n, -y)) AS majority FROM s GROUP BY ALL),
best AS (SELECT t FROM g GROUP BY t ORDER BY sum(impurity), t LIMIT 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y, g.majority AS prediction FROM li JOIN g ON g.above = (l_linenumber > g.t) WHERE g.t = (SELECT t FROM best)"""


@query(_STUMP)
def tree_stump(spark, sf):
    y = F.when((F.col("l_linenumber") > 4) & (F.col("l_quantity") > 10), 2).when(F.col("l_quantity") > 40, 1).otherwise(0)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, sf, "lineitem").select(*keys, y.alias("y"), _vector(F.col("l_linenumber")).alias("features"))
    out = models.decision_tree(rows, "y", CLASSES, depth=1).transform(rows)
    return out.select(*keys, "y", F.col("prediction").cast("int").alias("prediction"))


@query(_SEPARABLE)
def forest_separable(spark, sf):
    rows = _separable(spark, sf)
    return _exact(models.random_forest(rows, "y", CLASSES, trees=20, depth=6, weights={0: 0.5, 2: 4.0}), rows)


@query(_SEPARABLE)
def balanced_forest_separable(spark, sf):
    rows = _separable(spark, sf)
    return _exact(models.balanced_forest(rows, "y", CLASSES, ["vec_id"], draws=3, trees=15, depth=6), rows)


@query(_SEPARABLE)
def boosted_separable(spark, sf):
    rows = _separable(spark, sf)
    return _exact(models.boosted(rows, "y", CLASSES, rounds=4, depth=3), rows)


@query(_SEPARABLE)
def two_stage_separable(spark, sf):
    rows = _separable(spark, sf)
    return _exact(models.two_stage(rows, "y", rounds=4, depth=3), rows)


@query(_SEPARABLE)
def out_of_fold_separable(spark, sf):
    rows = ordered.stratified_folds(_separable(spark, sf), "y", ["vec_id"], 3)
    out = models.out_of_fold(rows, "fold", 3, lambda t: models.decision_tree(t, "y", CLASSES))
    return out.select("vec_id", "y", F.col("prediction").cast("int").alias("prediction"))


@query("SELECT 'f0' AS feature, CASE WHEN count(DISTINCT label % 3) > 1 THEN 1.0 END::DOUBLE AS importance FROM embeddings UNION ALL SELECT 'f1', 0.0::DOUBLE")
def importance_separable(spark, sf):
    y = F.col("label") % 3
    rows = table(spark, sf, "embeddings").select(y.alias("y"), _vector(y * 10 + F.col("embedding")[0], F.lit(1.0)).alias("features"))
    return models.random_forest(rows, "y", CLASSES, trees=5, depth=4).importance(rows).select("feature", r6("importance").alias("importance"))


@query("""SELECT CAST(row_number() OVER (ORDER BY p) AS INT) AS rank, p AS params, CASE WHEN (SELECT count(DISTINCT label % 3) FROM embeddings) = 3 THEN 1.0 END::DOUBLE AS macro_f1
FROM (VALUES ('{"bins": 16, "depth": 3}'), ('{"bins": 32, "depth": 2}')) v(p)""")
def search_separable(spark, sf):
    points = [{"depth": 2, "bins": 32}, {"depth": 3, "bins": 16}]
    out = search.search(_separable(spark, sf), "y", CLASSES, ["vec_id"], models.decision_tree, points)
    return out.select("rank", "params", r6("macro_f1").alias("macro_f1"))


# ---- isolation scores of given trees -------------------------------------------------
_TREES = [(("l_quantity", 20.0), (("l_tax", 0.03), 2.5, 3.25), 1.5), (("l_discount", 0.05), 1.25, (("l_quantity", 45.0), 4.0, 1.0))]


def _arrays(tree, names):
    nodes = []

    def add(t):
        at = len(nodes)
        nodes.append(None)
        if isinstance(t, float):
            nodes[at] = (-1, 0.0, -1, -1, t)
        else:
            (name, cut), left, right = t
            nodes[at] = (names.index(name), cut, add(left), add(right), 0.0)
        return at
    add(tree)
    return tuple(np.array(c) for c in zip(*nodes))


def _case(t):
    return repr(t) if isinstance(t, float) else f"CASE WHEN {t[0][0]} < {t[0][1]} THEN {_case(t[1])} ELSE {_case(t[2])} END"


_NORM = isolation.mean_path(256)


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(pow(2.0, -(({_case(_TREES[0])})::DOUBLE + ({_case(_TREES[1])})::DOUBLE) / 2 / {_NORM!r}::DOUBLE), 6) AS score FROM lineitem""")
def isolation_scores(spark, sf):
    names = ["l_quantity", "l_discount", "l_tax"]
    model = isolation.IsolationForestModel([_arrays(t, names) for t in _TREES], names, 256)
    return model.transform(table(spark, sf, "lineitem"), "score").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6("score").alias("score"))


# ---- mixed factor analysis of two numbers -------------------------------------------------
_CORR = "(SELECT abs(corr(l_quantity, l_extendedprice)) AS r, count(*) AS n FROM lineitem)"


@query(f"SELECT CAST(0 AS INT) AS component, round(1 + r, 6) AS eigenvalue, round(50 * (1 + r), 5) AS pct FROM {_CORR} UNION ALL SELECT 1, round(1 - r, 6), round(50 * (1 - r), 5) FROM {_CORR}")
def famd_two_numbers(spark, sf):
    model = famd.fit(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], [], 2)
    return model.eigenvalues(spark).select("component", r6("eigenvalue").alias("eigenvalue"), F.round("pct", 5).alias("pct"))


@query("""WITH z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS a,
  (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS b FROM lineitem), s AS (SELECT sign(corr(a, b)) AS s FROM z)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(a + s * b) / sqrt(2.0), 5) AS first, round(abs(a - s * b) / sqrt(2.0), 5) AS second FROM z, s""")
def famd_two_coordinates(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = famd.fit(li, ["l_quantity", "l_extendedprice"], [], 2).rows(li)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.abs("f0"), 5).alias("first"), F.round(F.abs("f1"), 5).alias("second"))


# ---- clustering ----------------------------------------------------------------------
@query("""WITH e AS (SELECT vec_id, label % 3 AS l, (label % 3) * 1000.0 + embedding[1]::DOUBLE AS x FROM embeddings), n AS (SELECT l, count(*) AS n FROM e GROUP BY 1),
d AS (SELECT a.vec_id, a.l AS own, b.l AS other, sum(pow(a.x - b.x, 2)) AS s FROM e a, e b GROUP BY ALL),
m AS (SELECT vec_id, max(CASE WHEN own = other THEN s / (n.n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n.n END) AS b FROM d JOIN n ON d.other = n.l GROUP BY ALL)
SELECT v.a AS algorithm, 3 AS parameter, round(avg((m.b - m.a) / greatest(m.a, m.b)), 6) AS silhouette FROM m, (VALUES ('KMeans'), ('BisectingKMeans')) v(a) GROUP BY ALL""")
def sweep_separated(spark, sf):
    e = table(spark, sf, "embeddings").select(F.array((F.col("label") % 3) * 1000.0 + F.col("embedding")[0].cast("double")).alias("v"))
    out = sweep.best_parameters(sweep.sweep(e, "v", [3]))
    return out.select("algorithm", "parameter", r6("silhouette").alias("silhouette"))


@query("""SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY CASE WHEN p_size <= 25 THEN 0 ELSE 1 END) AS INT) AS cluster, true AS converged FROM part""")
def kproto_converged(spark, sf):
    """Two far groups: the fit ends when the cost falls no more, each group one cluster."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") <= 25, 0.0).otherwise(1e4).alias("far"))
    model = kprototypes.KPrototypes(k=2, numeric=["far"], categorical=["p_brand"], gamma=1.0, restarts=4).fit(part)
    low = min(range(2), key=lambda i: model.prototypes[i]["far"])
    return model.transform(part).select("p_partkey", F.when(F.col("cluster") == low, 1).otherwise(2).alias("cluster"), F.lit(model.converged).alias("converged"))


# ---- gaps and odd values -----------------------------------------------------------------
_ACCT = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal::DECIMAL(15,2) END"
_NAT = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END"


@query(f"""WITH c AS (SELECT c_custkey AS k, c_custkey % 3 AS g, {_ACCT} AS x, {_NAT} AS y, c_mktsegment AS s FROM customer),
r AS (SELECT (max(x) - min(x))::DOUBLE AS rx, (max(y) - min(y))::DOUBLE AS ry FROM c),
p AS (SELECT a.k, a.g AS own, b.g AS "group", sum(abs(a.x - b.x))::DOUBLE / (rx * count(b.x)) AS dx, sum(abs(a.y - b.y))::DOUBLE / (ry * count(b.y)) AS dy,
  sum(CASE WHEN a.s = b.s THEN 0 ELSE 1 END)::DOUBLE / count(*) AS ds FROM c a JOIN c b ON a.k <> b.k, r GROUP BY a.k, a.g, b.g, rx, ry)
SELECT k, own, "group", round((coalesce(dx, 0) + coalesce(dy, 0) + ds) / (1 + (dx IS NOT NULL)::INT + (dy IS NOT NULL)::INT), 6) AS distance FROM p""")
def gower_with_gaps(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), (F.col("c_custkey") % 3).alias("g"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal").cast("decimal(15,2)")).alias("x"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("y"), F.col("c_mktsegment").alias("s"))
    out = gower.to_groups(c, "k", "g", [0, 1, 2], ["x", "y"], ["s"])
    return out.select("k", "own", "group", r6("distance").alias("distance"))


@query("""SELECT c_custkey, (SELECT count(DISTINCT v) FROM (SELECT c_mktsegment || '\\' AS v FROM customer WHERE c_custkey % 11 <> 0) q WHERE q.v < c.c_mktsegment || '\\')::DOUBLE
  * CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1 END - CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS code FROM customer c""")
def ordinal_learned(spark, sf):
    """Learned domain, values that end in a backslash, gaps as -1."""
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.concat("c_mktsegment", F.lit("\\"))).alias("segment"))
    for stage in prepare.ordinal(c, "segment", "code"):
        c = stage.transform(c)
    return c.select("c_custkey", "code")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (coalesce(l_linenumber - 4, 0) > 0 OR l_quantity > 45)::INT AS any_set FROM lineitem")
def any_positive_values(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"a": F.col("l_linenumber") - 4, "b": F.when(F.col("l_quantity") > 45, F.lit(3))})
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", impute.any_positive(["a", "b"]).alias("any_set"))


_ODD = "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 'Infinity'::DOUBLE ELSE l_quantity END"


@query(f"""WITH q AS (SELECT {_ODD} AS v FROM lineitem), s AS (SELECT quantile_disc(v, 0.25) AS a, quantile_disc(v, 0.75) AS b FROM q)
SELECT 'v' AS "column", count(v) FILTER (WHERE v > b + 1.5 * (b - a)) AS outliers, max(v) FILTER (WHERE v <= b + 1.5 * (b - a)) AS whisker_high FROM q, s GROUP BY ALL""")
def boxplot_odd_values(spark, sf):
    """NaN is missing, infinity an outlier."""
    v = F.when(F.col("l_linenumber") == 7, float("nan")).when(F.col("l_linenumber") == 6, float("inf")).otherwise(F.col("l_quantity").cast("double"))
    out = columns_profile.boxplot(table(spark, sf, "lineitem").select(v.alias("v")), ["v"])
    return out.select("column", "outliers", "whisker_high")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber WHEN 1 THEN 5 WHEN 2 THEN NULL WHEN 3 THEN 10 ELSE NULL END::INT AS code FROM lineitem""")
def code_text(spark, sf):
    text = F.element_at(F.array(*[F.lit(x) for x in (" 5 ", "5.07", "10.0", "x.0", "", ".0", "1.0.0")]), F.col("l_linenumber").cast("int"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fc.code(text).alias("code"))


# ---- tests with their p-values -------------------------------------------------------------
@query("""WITH c AS (SELECT l_linenumber, l_returnflag, count(*) AS o FROM lineitem GROUP BY ALL), x AS (SELECT sum(o) AS n FROM c),
e AS (SELECT c.o, r.t * k.t * 1.0 / n AS e FROM c JOIN (SELECT l_linenumber, sum(o) AS t FROM c GROUP BY 1) r USING (l_linenumber) JOIN (SELECT l_returnflag, sum(o) AS t FROM c GROUP BY 1) k USING (l_returnflag), x),
h AS (SELECT sum((o - e) * (o - e) / e) / 2 AS h FROM e)
SELECT 'l_linenumber' AS "column", 12 AS dof, round(exp(-h) * (1 + h + h**2 / 2 + h**3 / 6 + h**4 / 24 + h**5 / 120), 8) AS p_value, exp(-h) * (1 + h + h**2 / 2 + h**3 / 6 + h**4 / 24 + h**5 / 120) < 0.05 AS significant FROM h""")
def chi2_p_value(spark, sf):
    """Twelve degrees of freedom: the tail is a closed sum."""
    out = stats.chi2_independence(table(spark, sf, "lineitem"), ["l_linenumber"], "l_returnflag")
    return out.select("column", F.col("dof").cast("int").alias("dof"), F.round("p_value", 8).alias("p_value"), "significant")


@query("""WITH g AS (SELECT l_returnflag AS k, v.c, count(*) AS n, avg(v.x) AS m, var_pop(v.x) AS s FROM (SELECT l_returnflag, 'l_tax' AS c, l_tax::DOUBLE AS x FROM lineitem UNION ALL SELECT l_returnflag, 'l_quantity', l_quantity::DOUBLE FROM lineitem) v GROUP BY ALL),
t AS (SELECT c, sum(n) AS n, count(*) AS k, sum(n * m * m) - pow(sum(n * m), 2) / sum(n) AS b, sum(n * s) AS w FROM g GROUP BY c), f AS (SELECT c, n - k AS d, (b / 2) / (w / (n - k)) AS f FROM t WHERE k = 3)
SELECT c AS "column", round(pow(1 + 2 * f / d, -d / 2.0), 6) AS p_value, pow(1 + 2 * f / d, -d / 2.0) < 0.05 AS significant FROM f""")
def anova_p_value(spark, sf):
    """Three groups: with two degrees of freedom the tail is a power."""
    out = stats.anova(table(spark, sf, "lineitem"), ["l_tax", "l_quantity"], "l_returnflag")
    return out.select("column", r6("p_value").alias("p_value"), "significant")


# ---- lists of the cluster profile; text lines to typed rows ----------------------------------
@query(f"""WITH {clusters._CL}, {clusters._LIFT}, nz AS ({clusters._NUMZ}) SELECT cluster, col AS "column", value, round(lift, 2) AS a, round(support * 100, 1) AS b FROM lift
UNION ALL SELECT cluster, col, NULL, round(mean, 2), round(z, 2) FROM nz WHERE abs(z) >= 0.5""")
def cluster_profile_lists(spark, sf):
    df = clusters._clustered(spark, sf)
    out = profile.joined_profile(profile.over_represented(df, "cluster", clusters._CATS),
                                 profile.numeric_profile(df, "cluster", ["l_quantity", "l_extendedprice"], min_abs_z=0.5), "cluster")
    values = out.select("cluster", F.explode("categories").alias("x")).select(
        "cluster", "x.column", "x.value", F.col("x.lift").alias("a"), F.col("x.support_pct").alias("b"))
    numbers = out.select("cluster", F.explode("numbers").alias("x")).select(
        "cluster", "x.column", F.lit(None).cast("string").alias("value"), F.col("x.mean").alias("a"), F.col("x.z_mean").alias("b"))
    return values.unionByName(numbers)


_VEHICLE = {"id_accident": "Num_Acc", "id_vehicle": "id_vehicule", "number_vehicle": "num_veh", "direction_of_travel": "senc", "vehicle_category": "catv",
            "fixed_obstacle_struck": "obs", "mobile_obstacle_struck": "obsm", "initial_point_of_impact": "choc", "main_maneuver_before_accident": "manv",
            "motor_type": "motor"}


@query("SELECT " + ", ".join(f"CAST(replace({accident._VEH[c]}, ' ', '') AS BIGINT) AS {n}" if n == "id_vehicle" else f"{accident._VEH[c]} AS {n}"
                             for n, c in _VEHICLE.items()) + " FROM lineitem")
def typed_text_lines(spark, sf):
    """Lines of a raw file, as written with ``;``, read with their declared schema and typed."""
    v = accident.raw_tables(spark, sf)["vehicles"].drop("_src_pos")
    line = v.select(F.to_csv(F.struct(*v.columns), {"sep": ";"}).alias("line"))
    schema = ", ".join(f"`{c}` string" for c in v.columns)
    back = line.select(F.from_csv("line", schema, {"sep": ";"}).alias("r")).select("r.*")
    return raw.typed(clean.rename(back, schemas.RENAMES["vehicles"])).select(*_VEHICLE)
