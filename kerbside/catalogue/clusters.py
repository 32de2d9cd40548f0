"""Registered queries: clustering and cluster profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalogue.tables import r6, table
from kerbside.clustering import dbscan as db
from kerbside.clustering import gower, kprototypes, profile, silhouette, sweep
from kerbside.operators.profile import crosstab
from kerbside.session import pin_small

QUERIES, SQL = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


def _rounded(df, digits=6):
    return df.withColumns({c: F.round(c, digits) for c, k in df.dtypes if k == "double"})


_CL = "cl AS (SELECT CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_quantity > 30 THEN 1 ELSE 2 END AS cluster, * FROM lineitem)"


def _clustered(spark, sf):
    c = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_quantity") > 30, 1).otherwise(2)
    return table(spark, sf, "lineitem").withColumn("cluster", c)


_NUM = """SELECT cluster, '{c}' AS "column", count(*) AS n, round(avg({c}), 5) AS mean, round(quantile_cont({c}, 0.5), 5) AS median, round(stddev_samp({c}), 5) AS std, min({c})::DOUBLE AS min,
 round(quantile_cont({c}, 0.25), 5) AS q25, round(quantile_cont({c}, 0.75), 5) AS q75, round((avg({c}) - (SELECT avg({c}) FROM cl)) / (SELECT stddev_samp({c}) FROM cl), 5) AS z_mean FROM cl GROUP BY cluster"""


@query(f"WITH {_CL} " + " UNION ALL ".join(_NUM.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def cluster_numeric_profile(spark, sf):
    return _rounded(profile.numeric_profile(_clustered(spark, sf), "cluster", ["l_quantity", "l_extendedprice", "l_tax"]), 5)


_CATS = ["l_returnflag", "l_linestatus", "l_linenumber"]
_LONG = " UNION ALL ".join(f"SELECT cluster, '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM cl GROUP BY ALL" for c in _CATS)
_LIFT = f"""lo AS ({_LONG}), sh AS (SELECT *, n * 1.0 / sum(n) OVER (PARTITION BY cluster, col) AS share FROM lo),
dom AS (SELECT cluster, col, value FROM sh QUALIFY row_number() OVER (PARTITION BY cluster, col ORDER BY n DESC, value) = 1),
dif AS (SELECT col FROM dom GROUP BY col HAVING count(DISTINCT value) > 1),
grid AS (SELECT c.cluster, v.col, v.value, coalesce(s.share, 0) AS share FROM (SELECT DISTINCT cluster, col FROM sh) c JOIN (SELECT DISTINCT col, value FROM sh) v ON c.col = v.col
  LEFT JOIN sh s ON s.cluster = c.cluster AND s.col = v.col AND s.value = v.value),
va AS (SELECT col FROM (SELECT col, value, stddev_samp(share) AS sd FROM grid GROUP BY ALL) GROUP BY col HAVING max(sd) > 0.005),
gl AS (SELECT col, value, sum(n) * 1.0 / sum(sum(n)) OVER (PARTITION BY col) AS g FROM lo GROUP BY col, value),
lift AS (SELECT cluster, sh.col, sh.value, share / g AS lift, share AS support FROM sh JOIN gl ON sh.col = gl.col AND sh.value = gl.value
 WHERE sh.col IN (SELECT col FROM dif) AND sh.col IN (SELECT col FROM va) AND share / g >= 1.2 AND share >= 0.05)"""


@query(f"WITH {_CL}, {_LIFT} SELECT cluster, col AS \"column\", value, round(lift, 6) AS lift, round(support, 6) AS support FROM lift")
def cluster_lift(spark, sf):
    return _rounded(profile.over_represented(_clustered(spark, sf), "cluster", _CATS))


@query(f"WITH {_CL}, {_LIFT} SELECT cluster, col AS \"column\", value AS dominant FROM dom")
def dominant_category(spark, sf):
    shares = profile.category_shares(_clustered(spark, sf), "cluster", _CATS)
    return profile.dominant_category(shares, "cluster").select("cluster", "column", F.col("value").alias("dominant"))


_NUMZ = " UNION ALL ".join(f"SELECT cluster, '{c}' AS col, avg({c}) AS mean, (avg({c}) - (SELECT avg({c}) FROM cl)) / (SELECT stddev_samp({c}) FROM cl) AS z FROM cl GROUP BY cluster" for c in ("l_quantity", "l_extendedprice"))


@query(f"""WITH {_CL}, {_LIFT}, nz AS ({_NUMZ}), a AS (SELECT cluster, count(*) AS n_categories FROM lift GROUP BY 1), b AS (SELECT cluster, count(*) AS n_numbers FROM nz WHERE abs(z) >= 0.5 GROUP BY 1)
SELECT coalesce(a.cluster, b.cluster) AS cluster, n_categories, n_numbers FROM a FULL JOIN b ON a.cluster = b.cluster""")
def cluster_profile(spark, sf):
    df = _clustered(spark, sf)
    out = profile.joined_profile(profile.over_represented(df, "cluster", _CATS),
                                 profile.numeric_profile(df, "cluster", ["l_quantity", "l_extendedprice"], min_abs_z=0.5), "cluster")
    count = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint")
    return out.select("cluster", count("categories").alias("n_categories"), count("numbers").alias("n_numbers"))


@query(f"""WITH {_CL} SELECT cluster, l_linestatus, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY cluster), 6) AS share FROM cl GROUP BY 1, 2""")
def cluster_target_crosstab(spark, sf):
    return _rounded(crosstab(_clustered(spark, sf), "cluster", "l_linestatus"))


@query("""SELECT l.label, (SELECT count(*) FROM embeddings e WHERE e.label = l.label) AS a, (SELECT count(*) FROM embeddings e WHERE e.label % 3 = l.label) AS b
FROM (SELECT DISTINCT label FROM embeddings) l""")
def cluster_sizes(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("label").alias("a"), (F.col("label") % 3).alias("b"))
    return profile.cluster_sizes(e, ["a", "b"])


@query(""" SELECT 'a' AS "column", CAST(row_number() OVER (ORDER BY n DESC, label) AS INT) AS place, round(n * 100.0 / sum(n) OVER (), 1) AS share_pct FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) QUALIFY place <= 3
UNION ALL SELECT 'b', CAST(row_number() OVER (ORDER BY n DESC, label) AS INT) AS place, round(n * 100.0 / sum(n) OVER (), 1) FROM (SELECT label % 3 AS label, count(*) AS n FROM embeddings GROUP BY 1) QUALIFY place <= 3""")
def largest_clusters(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("label").alias("a"), (F.col("label") % 3).alias("b"))
    return profile.largest_shares(e, ["a", "b"])


def _silhouette_sql(distance):
    return f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label % 3 AS l FROM embeddings), n AS (SELECT l, count(*) AS n FROM e GROUP BY 1),
d AS (SELECT a.vec_id, a.l AS own, b.l AS other, sum({distance}) AS s FROM e a, e b GROUP BY ALL),
m AS (SELECT vec_id, own, max(CASE WHEN own = other THEN s / (n.n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n.n END) AS b FROM d JOIN n ON d.other = n.l GROUP BY ALL)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette, 3 AS clusters FROM m"""


def _third(spark, sf):
    return table(spark, sf, "embeddings").withColumn("l", F.col("label") % 3)


@query(_silhouette_sql("pow(list_distance(a.v, b.v), 2)"))
def silhouette_squared(spark, sf):
    return silhouette.squared_silhouette(_third(spark, sf), "embedding", "l").select(r6("silhouette").alias("silhouette"), "clusters")


@query(_silhouette_sql("list_distance(a.v, b.v)"))
def silhouette_euclidean(spark, sf):
    out = silhouette.euclidean_silhouette(_third(spark, sf), "embedding", "l")
    return out.select(r6("silhouette").alias("silhouette"), "clusters")


_GOW = """WITH c AS (SELECT c_custkey AS k, c_custkey % 3 AS g, c_acctbal AS x, c_nationkey::DOUBLE AS y, c_mktsegment AS s FROM customer),
r AS (SELECT max(x) - min(x) AS rx, max(y) - min(y) AS ry FROM c), n AS (SELECT g, count(*) AS n FROM c GROUP BY 1)
SELECT k, own, "group", round(t / (n.n - CASE WHEN own = "group" THEN 1 ELSE 0 END), 6) AS distance FROM (
 SELECT a.k, a.g AS own, b.g AS "group", sum((abs(a.x - b.x) / rx + abs(a.y - b.y) / ry + CASE WHEN a.s = b.s THEN 0 ELSE 1 END) / 3) AS t FROM c a, c b, r GROUP BY ALL) q JOIN n ON q."group" = n.g"""


def _gower(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 3).alias("g"), "c_acctbal", "c_nationkey", "c_mktsegment")
    return gower.to_groups(c, "k", "g", [0, 1, 2], ["c_acctbal", "c_nationkey"], ["c_mktsegment"])


@query(_GOW)
def gower_group_distance(spark, sf):
    return _rounded(_gower(spark, sf))


@query(f"""SELECT own, "group", round(avg(distance), 4) AS distance FROM ({_GOW}) WHERE own <> "group" GROUP BY ALL""")
def gower_linkage(spark, sf):
    return _rounded(gower.group_linkage(_gower(spark, sf)), 4)


@query("""WITH r AS (SELECT max(o_totalprice) - min(o_totalprice) AS r1 FROM orders)
SELECT o_orderkey, round((abs(o_totalprice - c_acctbal) / r1 + abs(year(o_orderdate) % 25 - c_nationkey) / 24.0 + CASE WHEN substr(o_orderpriority, 3, 1) = substr(c_mktsegment, 1, 1) THEN 0 ELSE 1 END) / 3, 6) AS distance
FROM orders JOIN customer ON o_custkey = c_custkey, r""")
def gower_pairs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.struct(
        F.col("o_totalprice").alias("x"), (F.year("o_orderdate") % 25).alias("y"), F.substring("o_orderpriority", 3, 1).alias("s")).alias("a"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.struct(
        F.col("c_acctbal").alias("x"), F.col("c_nationkey").alias("y"), F.substring("c_mktsegment", 1, 1).alias("s")).alias("b"))
    span = gower.ranges(table(spark, sf, "orders"), ["o_totalprice"])["o_totalprice"]
    return o.join(c, "k").select("o_orderkey", r6(gower.distance("a", "b", {"x": span, "y": 24.0}, ["s"])).alias("distance"))


_EPS, _MIN = 0.02, 5
_PTS = "p AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)"
_DB = f"""{_PTS}, co AS (SELECT a.id, a.x, a.y FROM p a JOIN p b ON pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {_EPS * _EPS} GROUP BY ALL HAVING count(*) >= {_MIN})"""


def _plane(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("x"),
                                                 F.col("embedding")[1].cast("double").alias("y"))


@query(f"WITH {_DB} SELECT id, id IN (SELECT id FROM co) AS core FROM p")
def eps_neighbours(spark, sf):
    return db.core_points(_plane(spark, sf), "id", "x", "y", _EPS, _MIN)


@query(f"""WITH RECURSIVE {_DB}, e AS (SELECT a.id AS u, b.id AS v FROM co a JOIN co b ON pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {_EPS * _EPS}),
t AS (SELECT id AS u, id AS v FROM co UNION SELECT t.u, e.v FROM t JOIN e ON t.v = e.u), nm AS (SELECT u AS id, min(v) AS name FROM t GROUP BY 1),
bo AS (SELECT p.id, min(nm.name) AS name FROM p JOIN co ON pow(p.x - co.x, 2) + pow(p.y - co.y, 2) <= {_EPS * _EPS} JOIN nm ON nm.id = co.id WHERE p.id NOT IN (SELECT id FROM co) GROUP BY 1)
SELECT p.id, coalesce(nm.name, bo.name, -1) AS cluster FROM p LEFT JOIN nm ON p.id = nm.id LEFT JOIN bo ON p.id = bo.id""")
def dbscan(spark, sf):
    return db.dbscan(_plane(spark, sf), "id", "x", "y", _EPS, _MIN)


_PROTO = [{"p_size": 10.0, "p_retailprice": 905.0, "p_brand": "Brand#1", "p_type": "ECONOMY"},
          {"p_size": 25.0, "p_retailprice": 1000.0, "p_brand": "Brand#2", "p_type": "PROMO"},
          {"p_size": 40.0, "p_retailprice": 1090.0, "p_brand": "Brand#3", "p_type": "SMALL"}]
_D = ", ".join(f"pow(p_size - {p['p_size']}, 2) + pow(p_retailprice - {p['p_retailprice']}, 2) + CASE WHEN p_brand = '{p['p_brand']}' THEN 0 ELSE 8.0 END + CASE WHEN p_type = '{p['p_type']}' THEN 0 ELSE 8.0 END AS d{i}" for i, p in enumerate(_PROTO))
_ASSIGN = f"a AS (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM (SELECT *, {_D} FROM part))"


def _assigned(spark, sf):
    return kprototypes.assign(table(spark, sf, "part"), _PROTO, ["p_size", "p_retailprice"], ["p_brand", "p_type"], 8.0, cost="cost")


@query(f"WITH {_ASSIGN} SELECT p_partkey, cluster, round(least(d0, d1, d2), 4) AS cost FROM a")
def kproto_assign(spark, sf):
    return _assigned(spark, sf).select("p_partkey", "cluster", F.round("cost", 4).alias("cost"))


@query(f"""WITH {_ASSIGN}, m AS (SELECT cluster, count(*) AS n, round(avg(p_size), 6) AS p_size, round(avg(p_retailprice), 6) AS p_retailprice FROM a GROUP BY 1)
SELECT m.*, (SELECT p_brand FROM a WHERE a.cluster = m.cluster GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_brand,
 (SELECT p_type FROM a WHERE a.cluster = m.cluster GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS p_type FROM m""")
def kproto_update(spark, sf):
    a = _assigned(spark, sf)
    modes = kprototypes.modes(a, ["p_brand", "p_type"])
    wide = modes.groupBy("cluster").agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in ("p_brand", "p_type")])
    return _rounded(kprototypes.means(a, ["p_size", "p_retailprice"]).join(pin_small(wide), "cluster"))


@query()
def kproto(spark, sf):
    part = table(spark, sf, "part")
    model = kprototypes.KPrototypes(k=3, numeric=["p_size", "p_retailprice"], categorical=["p_brand", "p_type"], restarts=2, max_rounds=8).fit(part)
    return model.transform(part).select("p_partkey", "cluster")


@query()
def kmeans_sweep(spark, sf):
    return sweep.best_parameters(sweep.sweep(table(spark, sf, "embeddings"), "embedding", [3, 5, 7]))
