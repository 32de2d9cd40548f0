"""Registered queries: counts, profiles, distributions, tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalogue.tables import r6, table
from kerbside.operators import profile, stats
from kerbside.session import spread

QUERIES, SQL = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


@query("""SELECT p_type, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share FROM part GROUP BY 1""")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "part"), "p_type", share=True).select("p_type", "n", r6("share").alias("share"))


@query("""SELECT source, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 6) AS pct FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 20""")
def top_values(spark, sf):
    return profile.top_values(table(spark, sf, "documents"), "source", 20).select("source", "n", r6("pct").alias("pct"))


@query("""SELECT 'tax' AS "column", 'double' AS dtype, count(*) AS rows, count(tax) AS non_null, count(DISTINCT tax) AS distinct_values,
 greatest(0, count(DISTINCT tax) - 5) AS other_values FROM (SELECT nullif(l_tax, 0.0) AS tax FROM lineitem)""")
def inspect_column(spark, sf):
    li = table(spark, sf, "lineitem").select(F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return profile.inspect_column(li, "tax", 5)


@query("""SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 1""")
def most_frequent(spark, sf):
    return profile.most_frequent(table(spark, sf, "orders"), "o_custkey")


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share
FROM orders GROUP BY 1, 2""")
def crosstab_norm(spark, sf):
    out = profile.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    return out.withColumn("share", r6("share"))


@query("""SELECT o_orderpriority, round(100.0 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 6) AS "F",
 round(100.0 * sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) / count(*), 6) AS "O", round(100.0 * sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) / count(*), 6) AS "P"
FROM orders GROUP BY 1""")
def crosstab_percent(spark, sf):
    out = profile.crosstab_wide(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], percent=True)
    return out.select("o_orderpriority", *[r6(c).alias(c) for c in "FOP"])


def _gappy(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_linenumber", F.lit(1)).alias("no"), "l_quantity", F.nullif("l_returnflag", F.lit("N")).alias("flag"))


_GAPPY = """g AS (SELECT nullif(l_tax, 0.0) AS tax, nullif(l_discount, 0.0) AS discount, nullif(l_linenumber, 1) AS no, l_quantity, nullif(l_returnflag, 'N') AS flag FROM lineitem)"""


def _per_column(cols, template):
    return " UNION ALL ".join(template.format(c=c, k=k) for c, k in cols)


_COLS = [("tax", "double"), ("discount", "double"), ("no", "int"), ("l_quantity", "double"), ("flag", "string")]


@query(f"""WITH {_GAPPY}, u AS ({_per_column(_COLS, "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct FROM g")})
SELECT * FROM u WHERE missing_count > 0""")
def missing_summary(spark, sf):
    return profile.missing_summary(_gappy(spark, sf)).withColumn("missing_pct", r6("missing_pct"))


_DIRTY = """d AS (SELECT CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN ' ' WHEN l_linenumber = 3 THEN '.' WHEN l_linenumber = 4 THEN '-1'
 WHEN l_linenumber = 5 THEN '0' WHEN l_linenumber = 6 THEN '99' ELSE l_returnflag END AS code, CAST(l_quantity AS INT) % 4 - 1 AS num FROM lineitem)"""


@query(f"""WITH {_DIRTY}, a AS (SELECT 'code' AS "column", count(*) AS rows, count(*) - count(code) AS "null", count(CASE WHEN trim(code) = '' THEN 1 END) AS blank,
 count(CASE WHEN trim(code) = '.' THEN 1 END) AS dot, count(CASE WHEN TRY_CAST(code AS DOUBLE) = -1 THEN 1 END) AS minus1,
 count(CASE WHEN TRY_CAST(code AS DOUBLE) = 0 THEN 1 END) AS zero, count(CASE WHEN code IN ('99') THEN 1 END) AS extra FROM d
 UNION ALL SELECT 'num', count(*), 0, 0, 0, count(CASE WHEN num = -1 THEN 1 END), 0, 0 FROM d)
SELECT *, "null" + blank + dot + minus1 + zero + extra AS any_missing_like, round(("null" + blank + dot + minus1 + zero + extra) * 100.0 / rows, 2) AS any_missing_like_pct FROM a""")
def not_reported(spark, sf):
    n = F.col("l_linenumber")
    code = (F.when(n == 1, None).when(n == 2, " ").when(n == 3, ".").when(n == 4, "-1").when(n == 5, "0")
            .when(n == 6, "99").otherwise(F.col("l_returnflag")))
    d = table(spark, sf, "lineitem").select(code.alias("code"), (F.col("l_quantity").cast("int") % 4 - 1).alias("num"))
    return profile.not_reported(d, ["code"], {"code": ["99"]})


@query("""SELECT 'num' AS "column", count(*) AS n FROM lineitem WHERE CAST(l_quantity AS INT) % 4 = 0""")
def neg1_counts(spark, sf):
    d = table(spark, sf, "lineitem").select((F.col("l_quantity").cast("int") % 4 - 1).alias("num"), "l_tax", "l_linenumber")
    return profile.minus_one_counts(d)


_TOP = """(SELECT coalesce(CAST({c} AS VARCHAR), 'NaN') FROM g GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) NULLS LAST LIMIT 1)"""
_TOPN = "(SELECT count(*) FROM g GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)"


def _profile_part(c, kind):
    numbers = (f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
               f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c})::DOUBLE AS max") if kind != "string" else \
        "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25, NULL::DOUBLE AS q50, NULL::DOUBLE AS q75, NULL::DOUBLE AS max"
    return (f"SELECT '{c}' AS \"column\", '{kind}' AS dtype, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct, count(*) - count({c}) AS missing_count, "
            f"count(DISTINCT {c}) AS unique_count, {_TOP.format(c=c)} AS top_value, round({_TOPN.format(c=c)} * 100.0 / count(*), 6) AS top_pct, {numbers} FROM g")


@query(f"WITH {_GAPPY} " + " UNION ALL ".join(_profile_part(c, k) for c, k in _COLS))
def column_profile(spark, sf):
    out = profile.column_profile(spread(_gappy(spark, sf), "l_quantity", "tax", "discount"))
    rounded = [c for c, k in out.dtypes if k == "double"]
    return out.withColumns({c: r6(c) for c in rounded})


@query(f"""WITH {_GAPPY} """ + _per_column(_COLS, "SELECT '{c}' AS \"column\", '{k}' AS dtype, count(*) - count({c}) AS missing_count, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct, count(DISTINCT {c}) AS unique_count FROM g"))
def quality_table(spark, sf):
    return profile.quality_table(_gappy(spark, sf)).withColumn("missing_pct", r6("missing_pct"))


_DESC = """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
 round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c})::DOUBLE AS max FROM lineitem"""


@query(" UNION ALL ".join(_DESC.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")))
def describe_numeric(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])
    return out.withColumns({c: F.round(c, 5) for c in ("mean", "std")} | {c: r6(c) for c in ("q25", "q50", "q75")})


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", (SELECT count({c}) FROM orders) AS count, (SELECT count(DISTINCT {c}) FROM orders) AS "unique", top, freq
 FROM (SELECT {c} AS top, count(*) AS freq FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)""" for c in ("o_orderstatus", "o_orderpriority")))
def describe_text(spark, sf):
    return profile.describe_categories(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("""SELECT l_linenumber, round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1 HAVING count(*) >= 50""")
def group_mean_having(spark, sf):
    out = profile.group_mean(table(spark, sf, "lineitem").filter("l_quantity > 45"), "l_linenumber", "l_quantity", 50)
    return out.withColumn("mean", r6("mean"))


@query("""SELECT CAST(floor((hour(ts) * 60 + minute(ts)) / 15.0) AS BIGINT) AS bin, floor((hour(ts) * 60 + minute(ts)) / 15.0) * 15.0 AS bin_start, count(*) AS n FROM events GROUP BY ALL""")
def histogram_width(spark, sf):
    e = table(spark, sf, "events").select((F.hour("ts") * 60 + F.minute("ts")).alias("m"))
    return profile.histogram(e, "m", width=15)


@query("""WITH s AS (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / 24.0 AS w FROM lineitem)
SELECT CAST(least(floor((l_quantity - lo) / w), 23) AS BIGINT) AS bin, round(lo + least(floor((l_quantity - lo) / w), 23) * w, 6) AS bin_start, count(*) AS n FROM lineitem, s GROUP BY ALL""")
def histogram(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), "l_quantity", bins=24).withColumn("bin_start", r6("bin_start"))


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q25, quantile_cont(l_extendedprice, 0.5) AS q50, quantile_cont(l_extendedprice, 0.75) AS q75 FROM lineitem),
t AS (SELECT l_extendedprice AS x, q.*, l_extendedprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM lineitem, q)
SELECT 'l_extendedprice' AS "column", round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, min(CASE WHEN inside THEN x END) AS whisker_low, max(CASE WHEN inside THEN x END) AS whisker_high,
 count(CASE WHEN NOT inside THEN 1 END) AS outliers FROM t GROUP BY q25, q50, q75""")
def boxplot(spark, sf):
    out = profile.boxplot(table(spark, sf, "lineitem"), ["l_extendedprice"])
    return out.withColumns({c: r6(c) for c in ("q25", "q50", "q75")})


@query("""WITH s AS (SELECT count(*) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2) AS h FROM events),
g AS (SELECT lo + (hi - lo) * i / 24.0 AS x FROM s, range(25) r(i))
SELECT round(x, 3) AS x, round((SELECT sum(exp(-pow((value - x) / h, 2) / 2)) FROM events) / (n * h * sqrt(2 * pi())), 8) AS density FROM g, s""")
def density(spark, sf):
    out = profile.density(table(spark, sf, "events"), "value", points=25)
    return out.select(F.round("x", 3).alias("x"), F.round("density", 8).alias("density"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _NUM for b in _NUM))
def corr_matrix(spark, sf):
    return stats.correlation_matrix(table(spark, sf, "lineitem"), _NUM).withColumn("corr", r6("corr"))


def _chi(feature, target, source, name):
    return f"""SELECT '{name}' AS "column", n, chi2, dof, v AS cramers_v FROM (SELECT n, round(chi2, 5) AS chi2, dof, round(sqrt(greatest(0, chi2 / n - dof * 1.0 / (n - 1))
 / least(k - pow(k - 1, 2) / (n - 1) - 1, r - pow(r - 1, 2) / (n - 1) - 1)), 6) AS v FROM (
 SELECT n, r, k, (r - 1) * (k - 1) AS dof, CASE WHEN (r - 1) * (k - 1) = 1 THEN sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) ELSE sum(pow(o - e, 2) / e) END AS chi2 FROM (
  SELECT f, t, coalesce(o, 0) AS o, rt * ct * 1.0 / n AS e, n, r, k FROM
   (SELECT {feature} AS f, count(*) AS rt FROM {source} GROUP BY 1) a, (SELECT {target} AS t, count(*) AS ct FROM {source} GROUP BY 1) b,
   (SELECT count(*) AS n, count(DISTINCT {feature}) AS r, count(DISTINCT {target}) AS k FROM {source}) c
   LEFT JOIN (SELECT {feature} AS f2, {target} AS t2, count(*) AS o FROM {source} GROUP BY 1, 2) x ON f2 = f AND t2 = t) GROUP BY n, r, k))"""


@query(_chi("l_linenumber", "l_returnflag", "lineitem", "l_linenumber") + " UNION ALL "
       + _chi("year(l_shipdate)", "l_returnflag", "lineitem", "y") + " UNION ALL " + _chi("l_quantity", "l_returnflag", "lineitem", "l_quantity"))
def chi2_cramers_v(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("y", F.year("l_shipdate"))
    out = stats.chi2_independence(li, ["l_linenumber", "y", "l_quantity"], "l_returnflag")
    return out.select("column", "n", F.round("chi2", 5).alias("chi2"), "dof", r6("cramers_v").alias("cramers_v"))


@query(_chi("l_quantity > 25", "l_linestatus", "lineitem", "big"))
def chi2_yates(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("big", F.col("l_quantity") > 25)
    out = stats.chi2_independence(li, ["big"], "l_linestatus")
    return out.select("column", "n", F.round("chi2", 5).alias("chi2"), "dof", r6("cramers_v").alias("cramers_v"))


_AN = """SELECT '{c}' AS "column", round((sum(n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 5) AS f, count(*) - 1 AS df_between, (sum(n) - count(*))::BIGINT AS df_within
FROM (SELECT l_returnflag, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM lineitem) AS gm FROM lineitem GROUP BY 1)"""


@query(" UNION ALL ".join(_AN.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_linenumber")))
def anova_f(spark, sf):
    out = stats.anova(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"], "l_returnflag")
    return out.select("column", F.round("f", 5).alias("f"), "df_between", "df_within")


@query("""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, n, round(n * 100.0 / (SELECT sum(n) FROM c), 6) AS pct, round((SELECT max(n) * 1.0 / min(n) FROM c), 6) AS imbalance_ratio FROM c""")
def class_distribution(spark, sf):
    out = profile.class_distribution(table(spark, sf, "events"), "event_type")
    return out.withColumns({c: r6(c) for c in ("pct", "imbalance_ratio")})


@query("""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, n, round((SELECT sum(n) FROM c) * 1.0 / ((SELECT count(*) FROM c) * n) * CASE event_type WHEN 'click' THEN 0.5 WHEN 'purchase' THEN 4.0 ELSE 1.0 END, 6) AS weight FROM c""")
def class_weights(spark, sf):
    out = profile.class_weights(table(spark, sf, "events"), "event_type", {"click": 0.5, "purchase": 4.0})
    return out.withColumn("weight", r6("weight"))


@query("""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT event_id, e.event_type, round((SELECT sum(n) FROM c) * 1.0 / ((SELECT count(*) FROM c) * c.n), 6) AS weight FROM events e JOIN c ON e.event_type = c.event_type""")
def row_weights(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return profile.with_class_weight(e, "event_type").select("event_id", "event_type", r6("weight").alias("weight"))


@query("""SELECT CAST(day(ts) AS INT) AS d, count(*) AS n FROM events GROUP BY 1""")
def daily_counts(spark, sf):
    return profile.ordered_counts(table(spark, sf, "events"), F.dayofmonth("ts"), "d")
