"""Registered queries: evaluation and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalogue.tables import r6, table
from kerbside.functions import columns as fc
from kerbside.operators import evaluate
from kerbside.streaming import scoring

QUERIES, SQL = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


# Truth and prediction made of lines: three classes each.
def _predicted(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") % 3).alias("y"), (F.col("l_quantity") * 2.6).alias("speed"), "l_discount", "l_tax",
        fc.speed_rule(F.col("l_quantity") * 2.6).alias("p"))


_P = """p AS (SELECT l_linenumber % 3 AS y, CASE WHEN l_quantity * 2.6 <= 50 THEN 0 WHEN l_quantity * 2.6 < 100 THEN 1 ELSE 2 END AS p FROM lineitem)"""
_CELLS = """cells AS (SELECT t.y AS truth, q.y AS pred, (SELECT count(*) FROM {src} WHERE {src}.y = t.y AND {src}.p = q.y) AS n FROM (VALUES (0),(1),(2)) t(y), (VALUES (0),(1),(2)) q(y))"""


@query(f"""WITH {_P}, {_CELLS.format(src='p')} SELECT truth, pred, n, round(n * 1.0 / sum(n) OVER (PARTITION BY truth), 6) AS share_of_truth,
 round(n * 1.0 / sum(n) OVER (PARTITION BY pred), 6) AS share_of_pred FROM cells""")
def confusion_matrix(spark, sf):
    out = evaluate.confusion_matrix(_predicted(spark, sf), "y", "p", [0, 1, 2])
    return out.withColumns({c: r6(c) for c in ("share_of_truth", "share_of_pred")})


def _report_ctes(src):
    return f"""{_CELLS.format(src=src)}, pc AS (SELECT l.y AS label, (SELECT sum(n) FROM cells WHERE truth = l.y AND pred = l.y)::DOUBLE AS tp,
 (SELECT sum(n) FROM cells WHERE pred = l.y)::DOUBLE AS predicted, (SELECT sum(n) FROM cells WHERE truth = l.y)::DOUBLE AS support FROM (VALUES (0),(1),(2)) l(y)),
m AS (SELECT label, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1, support FROM pc),
acc AS (SELECT sum(CASE WHEN truth = pred THEN n ELSE 0 END)::DOUBLE / sum(n)::DOUBLE AS a, sum(n)::BIGINT AS s FROM cells),
rep AS (SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support::BIGINT AS support FROM m UNION ALL SELECT 'accuracy', a, a, a, s FROM acc
 UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM m
 UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM m),
kap AS (SELECT 1 - sum(n * pow(truth - pred, 2)) / (SELECT sum(r.n * c.n * pow(r.truth - c.pred, 2)) / (SELECT sum(n) FROM cells) FROM
 (SELECT truth, sum(n) AS n FROM cells GROUP BY 1) r, (SELECT pred, sum(n) AS n FROM cells GROUP BY 1) c) AS kappa FROM cells)"""


_SCORES = """SELECT round(max(CASE WHEN label = 'accuracy' THEN f1 END), 6) AS accuracy, round(max(CASE WHEN label = 'macro avg' THEN f1 END), 6) AS macro_f1,
 round(max(CASE WHEN label = 'weighted avg' THEN f1 END), 6) AS weighted_f1, round((SELECT kappa FROM kap), 6) AS kappa FROM rep"""


@query(f"WITH {_P}, {_report_ctes('p')} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep")
def class_report(spark, sf):
    out = evaluate.class_report(_predicted(spark, sf), "y", "p", [0, 1, 2])
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query(f"WITH {_P}, {_report_ctes('p')} SELECT round(kappa, 6) AS kappa FROM kap")
def kappa(spark, sf):
    return evaluate.quadratic_kappa(_predicted(spark, sf), "y", "p", [0, 1, 2]).select(r6("kappa").alias("kappa"))


def _rounded(df):
    return df.select(*[r6(c).alias(c) for c in df.columns])


@query(f"WITH {_P}, {_report_ctes('p')} {_SCORES}")
def rule_baseline(spark, sf):
    return _rounded(evaluate.speed_rule_baseline(_predicted(spark, sf), "y", "speed", [0, 1, 2]))


@query(f"""WITH tr AS (SELECT l_linenumber % 3 AS y FROM lineitem WHERE l_quantity <= 25), mf AS (SELECT y FROM tr GROUP BY 1 ORDER BY count(*) DESC, y LIMIT 1),
p AS (SELECT l_linenumber % 3 AS y, (SELECT y FROM mf) AS p FROM lineitem WHERE l_quantity > 25), {_report_ctes('p')} {_SCORES}""")
def majority_baseline(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_linenumber") % 3).alias("y"), "l_quantity")
    return _rounded(evaluate.majority_baseline(rows.filter("l_quantity <= 25"), rows.filter("l_quantity > 25"), "y", [0, 1, 2]))


@query("""SELECT quality AS truth_quality, toxic, count(*) AS n FROM labels GROUP BY ALL""")
def label_agreement(spark, sf):
    out = evaluate.confusion_counts(table(spark, sf, "labels"), "quality", "toxic")
    return out.select(F.col("truth").alias("truth_quality"), F.col("pred").alias("toxic"), "n")


@query(f"WITH {_P} SELECT p AS pred, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share FROM p WHERE y = 2 GROUP BY p")
def severe_misses(spark, sf):
    return evaluate.false_negatives(_predicted(spark, sf), "y", "p", 2).withColumn("share", r6("share"))


@query(f"""WITH {_P}, q AS (SELECT l_linenumber % 3 AS y, 2 - (CAST(l_quantity AS INT) % 3) AS p FROM lineitem),
a AS (SELECT y, avg(CASE WHEN p = y THEN 1.0 ELSE 0.0 END) AS r FROM p GROUP BY 1), b AS (SELECT y, avg(CASE WHEN p = y THEN 1.0 ELSE 0.0 END) AS r FROM q GROUP BY 1)
SELECT CAST(a.y AS VARCHAR) AS label, round(a.r, 6) AS before, round(b.r, 6) AS after, round(b.r - a.r, 6) AS change FROM a JOIN b ON a.y = b.y""")
def recall_change(spark, sf):
    after = table(spark, sf, "lineitem").select((F.col("l_linenumber") % 3).alias("y"), (2 - F.col("l_quantity").cast("int") % 3).alias("p"))
    out = evaluate.recall_change(_predicted(spark, sf), after, "y", "p", [0, 1, 2])
    return out.select("label", *[r6(c).alias(c) for c in ("before", "after", "change")])


_PR = """pts AS (SELECT score, sum(n) OVER w AS predicted, sum(pos) OVER w AS tp, pos, (SELECT count(*) FROM events WHERE event_type = 'purchase') AS positives FROM (
 SELECT value AS score, count(*) AS n, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS pos FROM events GROUP BY 1) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _points(spark, sf):
    e = table(spark, sf, "events")
    return evaluate.pr_points(e, {"purchase": F.col("event_type") == "purchase"}, {"purchase": F.col("value")})


@query(f"""WITH {_PR} SELECT 'purchase' AS "class", score, tp::BIGINT AS tp, predicted::BIGINT AS predicted, round(tp * 1.0 / predicted, 6) AS precision, round(tp * 1.0 / positives, 6) AS recall FROM pts""")
def pr_curve(spark, sf):
    return _points(spark, sf).select("class", "score", "tp", "predicted", r6("precision").alias("precision"), r6("recall").alias("recall"))


_AP = """SELECT '{c}' AS "class", round(sum(pos * 1.0 / total * cum / m), 6) AS average_precision FROM (SELECT pos, sum(pos) OVER w AS cum, sum(n) OVER w AS m, sum(pos) OVER () AS total FROM (
 SELECT {s} AS score, count(*) AS n, sum(CASE WHEN l_linenumber % 3 = {c} THEN 1 ELSE 0 END) AS pos FROM lineitem GROUP BY 1) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(" UNION ALL ".join(_AP.format(c=c, s=s) for c, s in ((0, "l_extendedprice"), (1, "l_discount"), (2, "l_tax"))))
def avg_precision(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("y", F.col("l_linenumber") % 3)
    points = evaluate.class_pr(li, "y", {0: F.col("l_extendedprice"), 1: F.col("l_discount"), 2: F.col("l_tax")})
    return evaluate.average_precision(points).withColumn("average_precision", r6("average_precision"))


_G = [i / 100 for i in range(0, 100, 7)]
_GRID = f"""g1 AS (SELECT unnest({_G}) AS t1), g2 AS (SELECT unnest({_G}) AS t2), s AS (SELECT l_linenumber % 3 AS y, l_discount * 10 AS pi, l_tax * 12.5 AS ps FROM lineitem),
c AS (SELECT y, pi, ps, count(*) AS n FROM s GROUP BY ALL),
h AS (SELECT t1, t2, y, CASE WHEN pi < t1 THEN 0 WHEN ps >= t2 THEN 2 ELSE 1 END AS p, sum(n) AS n FROM c, g1, g2 GROUP BY ALL),
f AS (SELECT t1, t2, {', '.join(f"2.0 * sum(CASE WHEN y = {k} AND p = {k} THEN n ELSE 0 END) / (sum(CASE WHEN y = {k} THEN n ELSE 0 END) + sum(CASE WHEN p = {k} THEN n ELSE 0 END)) AS f{k}" for k in range(3))},
 sum(CASE WHEN y = 2 AND p = 2 THEN n ELSE 0 END) * 1.0 / sum(CASE WHEN y = 2 THEN n ELSE 0 END) AS r2 FROM h GROUP BY t1, t2)"""


def _grid(spark, sf):
    s = table(spark, sf, "lineitem").select((F.col("l_linenumber") % 3).alias("y"), (F.col("l_discount") * 10).alias("pi"),
                                            (F.col("l_tax") * 12.5).alias("ps"))
    return evaluate.threshold_grid(s, "y", "pi", "ps", _G, _G)


@query(f"WITH {_GRID} SELECT t1::DOUBLE AS t_injured, t2::DOUBLE AS t_severe, round(0.2 * f0 + 0.4 * f1 + 0.4 * f2, 6) AS score, round(r2, 6) AS recall_severe FROM f")
def threshold_grid(spark, sf):
    return _grid(spark, sf).select("t_injured", "t_severe", r6("score").alias("score"), r6("recall_severe").alias("recall_severe"))


@query(f"WITH {_GRID} SELECT t1::DOUBLE AS t_injured, t2::DOUBLE AS t_severe, round(0.2 * f0 + 0.4 * f1 + 0.4 * f2, 6) AS score, round(r2, 6) AS recall_severe FROM f WHERE r2 >= 0.5 ORDER BY 0.2 * f0 + 0.4 * f1 + 0.4 * f2 DESC, t1, t2 LIMIT 1")
def best_thresholds(spark, sf):
    return evaluate.best_thresholds(_grid(spark, sf)).select("t_injured", "t_severe", r6("score").alias("score"), r6("recall_severe").alias("recall_severe"))


_PROB = """pr AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount * 10 AS pi, l_tax * 12.5 AS ps FROM lineitem),
cl AS (SELECT *, greatest(0.0, least(1.0, 1.0 - pi)) AS a0, greatest(0.0, least(1.0, pi - pi * ps)) AS a1, greatest(0.0, least(1.0, pi * ps)) AS a2 FROM pr),
pb AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, a0 / (a0 + a1 + a2) AS p0, a1 / (a0 + a1 + a2) AS p1, a2 / (a0 + a1 + a2) AS p2 FROM cl)"""


def _probabilities(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", fc.two_stage_probabilities(
        F.col("l_discount") * 10, F.col("l_tax") * 12.5).alias("probability"))


_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(f"WITH {_PROB} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2 FROM pb")
def prob_combine(spark, sf):
    p = _probabilities(spark, sf)
    return p.select(*_KEY, *[r6(F.col("probability")[i]).alias(f"p{i}") for i in range(3)])


@query(f"""WITH {_PROB}, c AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS severity FROM pb)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, severity, round(p1 + 2 * p2, 6) AS expected_severity, round((p1 + 2 * p2) / 2, 6) AS gauge,
 CASE severity WHEN 0 THEN 'LOW RISK' WHEN 1 THEN 'MEDIUM RISK' ELSE 'HIGH RISK' END AS risk FROM c""")
def risk_label(spark, sf):
    out = scoring.with_severity(_probabilities(spark, sf))
    return out.select(*_KEY, "severity", r6("expected_severity").alias("expected_severity"), r6("gauge").alias("gauge"), "risk")


@query("""WITH t AS (SELECT DISTINCT l_linenumber, l_quantity, l_suppkey FROM lineitem)
SELECT l_linenumber, l_quantity, l_suppkey, 'Speed Limit' AS factor, round(l_quantity / 130.0, 6) AS intensity FROM t UNION ALL
SELECT l_linenumber, l_quantity, l_suppkey, 'Road Complexity', round(l_suppkey / 10.0, 6) FROM t UNION ALL
SELECT l_linenumber, l_quantity, l_suppkey, 'Weather Severity', round(l_linenumber / 4.0, 6) FROM t UNION ALL
SELECT l_linenumber, l_quantity, l_suppkey, 'Lighting Conditions', round(l_linenumber / 3.0, 6) FROM t""")
def risk_factors(spark, sf):
    t = table(spark, sf, "lineitem").select("l_linenumber", "l_quantity", "l_suppkey").distinct()
    t = t.withColumns({"speed_limit": F.col("l_quantity"), "road_complexity_index": F.col("l_suppkey"),
                       "weather_ordinal": F.col("l_linenumber"), "lighting_ordinal": F.col("l_linenumber")})
    return scoring.risk_factors(t, ["l_linenumber", "l_quantity", "l_suppkey"]).withColumn("intensity", r6("intensity"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS speed, CASE WHEN l_linenumber = 1 THEN -1 ELSE l_linenumber END AS code,
 0.0::DOUBLE AS absent_number, -1 AS absent_code FROM lineitem""")
def complete_report(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").alias("speed"),
                                             F.nullif("l_linenumber", F.lit(1)).alias("code"))
    return scoring.complete(li, ["speed", "code", "absent_number", "absent_code"], ["code", "absent_code"], keep=_KEY)


_SCEN = [("base", "l_quantity", "l_linenumber"), ("fast", "110.0", "l_linenumber"), ("fast_dark", "110.0", "3")]


@query(" UNION ALL ".join(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, '{n}' AS scenario, round({s}::DOUBLE / 130.0 + ({c}) / 3.0, 6) AS outcome,
 round({s}::DOUBLE / 130.0 + ({c}) / 3.0 - (l_quantity / 130.0 + l_linenumber / 3.0), 6) AS change FROM lineitem""" for n, s, c in _SCEN))
def what_if(spark, sf):
    li = table(spark, sf, "lineitem").select(*_KEY, F.col("l_quantity").alias("speed_limit"), F.col("l_linenumber").alias("lighting_ordinal"))

    def score(df):
        return df.withColumn("outcome", F.col("speed_limit") / 130.0 + F.col("lighting_ordinal") / 3.0)
    out = scoring.what_if(li, {"base": {}, "fast": {"speed_limit": 110.0}, "fast_dark": {"speed_limit": 110.0, "lighting_ordinal": 3}},
                          score, outcome="outcome")
    return out.select(*_KEY, "scenario", r6("outcome").alias("outcome"), r6("change").alias("change"))
