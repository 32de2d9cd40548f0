"""Registered queries: categories as target statistics, isolation trees, selection in a narrow range."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbside.catalogue.tables import table
from kerbside.ml import famd, isolation, models, target_stats
from kerbside.operators import evaluate, profile

QUERIES, SQL = {}, {}
_EVENTS = ["click", "error", "purchase"]          # other events are no class


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn
    return add


def _events(spark, sf):
    """A category of which one value holds a third of the rows, one of few values with gaps."""
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string")).alias("who"),
        F.when(F.col("event_id") % 5 != 0, F.hour("ts") % 4).alias("part"), F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event"))


_E = """e AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE user_id::VARCHAR END AS who, CASE WHEN event_id % 5 <> 0 THEN hour(ts) % 4 END AS part,
  CASE WHEN event_id % 11 <> 0 THEN event_type END AS event, md5(concat_ws('|', '42', event_id::VARCHAR)) AS h FROM events)"""
_P = [f"(SELECT count(*) FILTER (WHERE event = '{c}') / count(event)::DOUBLE FROM e)" for c in _EVENTS]


def _earlier(column):
    w = f"OVER (PARTITION BY {column} ORDER BY h, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return ", ".join(f"round((count(CASE WHEN event = '{c}' THEN 1 END) {w} + {p}) / (count(event) {w} + 1.0::DOUBLE), 9) AS {column}_share{i}"
                     for i, (c, p) in enumerate(zip(_EVENTS, _P)))


@query(f"WITH {_E} SELECT event_id, {_earlier('who')}, {_earlier('part')} FROM e")
def ordered_shares(spark, sf):
    """Shares among the earlier rows of a row's category; one category is hot."""
    out = target_stats.ordered_shares(_events(spark, sf), ["who", "part"], "event", _EVENTS, ["event_id"])
    return out.select("event_id", *[F.round(n, 9).alias(n) for c in ("who", "part") for n in target_stats.names(c, _EVENTS)])


@query(f"""WITH {_E}, l AS (SELECT 'who' AS c, who AS value, event FROM e UNION ALL SELECT 'part', part::VARCHAR, event FROM e)
SELECT c AS "column", value, count(event) AS rows, {', '.join(
    f"round((count(*) FILTER (WHERE event = '{c}') + {p}) / (count(event) + 1.0::DOUBLE), 9) AS share{i}" for i, (c, p) in enumerate(zip(_EVENTS, _P)))} FROM l GROUP BY c, value""")
def category_shares(spark, sf):
    out = target_stats.category_shares(_events(spark, sf), ["who", "part"], "event", _EVENTS)
    return out.select("column", "value", "rows", *[F.round(f"share{i}", 9).alias(f"share{i}") for i in range(3)])


@query(f"""WITH {_E}, s AS (SELECT who, count(event) AS n, {', '.join(f"count(*) FILTER (WHERE event = '{c}') AS n{i}" for i, c in enumerate(_EVENTS))} FROM e WHERE event_id % 4 <> 0 GROUP BY who),
p AS (SELECT {', '.join(f"count(*) FILTER (WHERE event = '{c}') / count(event)::DOUBLE AS p{i}" for i, c in enumerate(_EVENTS))} FROM e WHERE event_id % 4 <> 0)
SELECT event_id, {', '.join(f"round((coalesce(n{i}, 0) + p{i}) / (coalesce(n, 0) + 1.0::DOUBLE), 9) AS who_share{i}" for i in range(3))} FROM e, p LEFT JOIN s ON e.who = s.who""")
def joined_shares(spark, sf):
    """Shares learned on three quarters of the rows, joined to all of them."""
    e = _events(spark, sf)
    learn = e.filter("event_id % 4 <> 0")
    shares = target_stats.category_shares(learn, ["who"], "event", _EVENTS)
    out = target_stats.with_shares(e, shares, ["who"], target_stats.class_shares(learn, "event", _EVENTS))
    return out.select("event_id", *[F.round(n, 9).alias(n) for n in target_stats.names("who", _EVENTS)])


@query("SELECT o_orderkey, CAST((o_custkey * 7 + 3) % 50 % 3 AS INT) AS prediction FROM orders")
def boosted_categories(spark, sf):
    """Fifty categories, each of one class, and a number that says nothing: the trees need the shares."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("c"), F.col("o_custkey") % 50).alias("kind"), ((F.col("o_custkey") * 7 + 3) % 50 % 3).cast("int").alias("y"),
        array_to_vector(F.array((F.col("o_orderkey") * 37 % 101).cast("double"))).alias("features"))
    model = models.boosted(o, "y", [0, 1, 2], rounds=3, depth=2, categories=["kind"], keys=["o_orderkey"])
    return model.transform(o).select("o_orderkey", "prediction")


# ---- two isolation trees of three levels, grown and used in SQL ------------------------------
_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]
_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_SAMPLE, _LEVELS = 8, 3         # three levels below the root for a sample of eight
_UNIT = "('0x' || substr({d}, {at}, 13))::BIGINT / 4503599627370496.0::DOUBLE"


def _level(i):
    """Nodes of level i, and the rows that go on below them."""
    inner = f"len(o) > 0 AND n > 1 AND {i} < {_LEVELS}"
    spare = "CASE WHEN n <= 1 THEN 0.0::DOUBLE WHEN n = 2 THEN 1.0::DOUBLE ELSE 2 * (ln(n - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (n - 1.0::DOUBLE) / n END"
    spans = ", ".join(f"{{'f': {k}, 'low': min(x{k}), 'high': max(x{k})}}" for k in range(len(_FEATURES)))
    return f"""s{i} AS (SELECT tree, node, count(*)::DOUBLE AS n, list_filter([{spans}], lambda z: z.high > z.low) AS o, md5(concat_ws('|', '42', tree, node)) AS d FROM r{i} GROUP BY tree, node),
 k{i} AS (SELECT *, o[floor({_UNIT.format(d='d', at=20)} * len(o))::INT + 1] AS z, {_UNIT.format(d='d', at=1)} AS u FROM s{i}),
 n{i} AS MATERIALIZED (SELECT tree, node, CASE WHEN {inner} THEN z.f ELSE -1 END AS feature,
  CASE WHEN NOT ({inner}) THEN 0.0::DOUBLE WHEN least(z.high, z.low + (1 - u) * (z.high - z.low)) <= z.low THEN z.high ELSE least(z.high, z.low + (1 - u) * (z.high - z.low)) END AS threshold,
  CASE WHEN {inner} THEN 0.0::DOUBLE ELSE {i} + {spare} END AS path FROM k{i}),
 r{i + 1} AS MATERIALIZED (SELECT r.* REPLACE (2 * r.node + CASE WHEN [{', '.join(f'x{k}' for k in range(len(_FEATURES)))}][n.feature + 1] < n.threshold THEN 0 ELSE 1 END AS node)
  FROM r{i} r JOIN n{i} n ON r.tree = n.tree AND r.node = n.node WHERE n.feature >= 0)"""


_WANTED = 1.5 * _SAMPLE + 64
_GROWN = f"""x AS MATERIALIZED (SELECT {', '.join(_KEYS)}, {', '.join(f'{c}::DOUBLE AS x{k}' for k, c in enumerate(_FEATURES))}, md5(concat_ws('|', '42', {', '.join(_KEYS)})) AS h FROM lineitem),
 d AS (SELECT DISTINCT ON (tree, h) * FROM (SELECT x.*, floor({_UNIT.format(d="md5(concat_ws('|', h, '1'))", at=20)} * 2)::INT AS tree FROM x
   WHERE {_UNIT.format(d="md5(h || '1')", at=20)} < 2 * {_WANTED} / (SELECT count(*) FROM x)::DOUBLE / 1)),
 r0 AS MATERIALIZED (SELECT tree, x0, x1, x2, 1::BIGINT AS node FROM d QUALIFY row_number() OVER (PARTITION BY tree ORDER BY md5(concat_ws('|', h, tree)), h) <= {_SAMPLE}),
 {', '.join(_level(i) for i in range(_LEVELS + 1))}, nodes AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM n{i}' for i in range(_LEVELS + 1))})"""


def _two_trees(spark, sf):
    li = table(spark, sf, "lineitem")
    return li, isolation.fit(li, _FEATURES, _KEYS, trees=2, sample=_SAMPLE)


@query(f"WITH {_GROWN} SELECT tree, node, feature, round(threshold, 6) AS threshold, round(path, 6) AS path FROM nodes")
def isolation_trees(spark, sf):
    """The fit itself: two trees grown from the rows their digests draw."""
    _, model = _two_trees(spark, sf)
    return model.table.withColumns({c: F.round(c, 6) for c in ("threshold", "path")})


@query(f"""WITH RECURSIVE {_GROWN}, w AS (SELECT t.tree, x.*, 1::BIGINT AS node, n.feature, n.threshold, n.path FROM x, (VALUES (0), (1)) t(tree) JOIN nodes n ON n.tree = t.tree AND n.node = 1
 UNION ALL SELECT w.tree, w.* EXCLUDE (tree, node, feature, threshold, path), n.node, n.feature, n.threshold, n.path FROM w JOIN nodes n ON n.tree = w.tree AND w.feature >= 0
  AND n.node = 2 * w.node + CASE WHEN [x0, x1, x2][w.feature + 1] < w.threshold THEN 0 ELSE 1 END)
SELECT {', '.join(_KEYS)}, round(pow(2, -(sum(path) / 2) / (2 * (ln({_SAMPLE - 1}) + 0.5772156649015329::DOUBLE) - 2 * {_SAMPLE - 1}.0::DOUBLE / {_SAMPLE})), 6) AS score
FROM w WHERE feature < 0 GROUP BY {', '.join(_KEYS)}, h""")
def isolation_two_scores(spark, sf):
    """Scores of all rows by the two fitted trees."""
    li, model = _two_trees(spark, sf)
    return model.transform(li).select(*_KEYS, F.round("anomaly_score", 6).alias("score"))


# ---- nearly all values in one narrow range ----------------------------------------------------
_NARROW = "1.0::DOUBLE + l_partkey * pow(2.0::DOUBLE, -40) + CASE WHEN l_linenumber = 7 THEN l_quantity ELSE 0 END"


def _narrow():
    return 1.0 + F.col("l_partkey") * 2.0 ** -40 + F.when(F.col("l_linenumber") == 7, F.col("l_quantity").cast("double")).otherwise(0.0)


@query(f"""WITH v AS (SELECT list(x ORDER BY x) AS l FROM (SELECT ({_NARROW} - 1) * pow(2.0::DOUBLE, 40) AS x FROM lineitem)), q AS (SELECT unnest([0.01, 0.25, 0.5, 0.8, 0.99])::DOUBLE AS p)
SELECT p AS prob, l[floor((len(l) - 1) * p)::BIGINT + 1]::BIGINT AS low FROM q, v""")
def quantiles_narrow(spark, sf):
    """Ranks inside a range so narrow that its values share all leading bits."""
    df = table(spark, sf, "lineitem").select(_narrow().alias("v"))
    n = df.count()
    probs = [0.01, 0.25, 0.5, 0.8, 0.99]
    # the probabilities of whole ranks, so that nothing is interpolated
    whole = {int((n - 1) * p) / (n - 1): p for p in probs}
    out = profile.exact_quantiles(df, ["v"], list(whole))
    back = F.element_at(F.create_map(*[F.lit(x) for a, p in whole.items() for x in (a, p)]), F.col("prob"))
    return out.select(back.alias("prob"), ((F.col("quantile") - 1) * 2.0 ** 40).cast("bigint").alias("low"))


@query(f"""WITH s AS (SELECT {_NARROW} AS s, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS pos FROM lineitem GROUP BY 1)
SELECT ((s - 1) * pow(2.0::DOUBLE, 40))::BIGINT AS score, (sum(pos) OVER w)::BIGINT AS tp, (sum(n) OVER w)::BIGINT AS predicted FROM s WINDOW w AS (ORDER BY s DESC)""")
def pr_narrow(spark, sf):
    """Precision-recall points of such scores."""
    df = table(spark, sf, "lineitem").select(_narrow().alias("s"), (F.col("l_returnflag") == "R").alias("y"))
    points = evaluate.pr_points(df, {"r": F.col("y")}, {"r": F.col("s")})
    return points.select(((F.col("score") - 1) * 2.0 ** 40).cast("bigint").alias("score"), "tp", "predicted")


# ---- factor analysis of one number and one category of two values: a closed problem -------------
_MIXED = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::DOUBLE AS x, CASE WHEN l_quantity + l_linenumber * 4 > 40 THEN 'much' ELSE 'little' END AS s FROM lineitem"


def _mixed(spark, sf):
    return table(spark, sf, "lineitem").select(*_KEYS, F.col("l_quantity").cast("double").alias("x"), F.when(
        F.col("l_quantity") + F.col("l_linenumber") * 4 > 40, "much").otherwise("little").alias("s"))


@query(f"""WITH m AS ({_MIXED}), r AS (SELECT abs(corr(x, CASE WHEN s = 'much' THEN 1.0::DOUBLE ELSE 0 END)) AS r FROM m)
SELECT 0 AS component, round(1 + r, 6) AS eigenvalue, round(50 * (1 + r), 5) AS pct FROM r UNION ALL SELECT 1, round(1 - r, 6), round(50 * (1 - r), 5) FROM r""")
def famd_mixed(spark, sf):
    """The number and the category's one direction have a correlation; the components are their sum and difference."""
    model = famd.fit(_mixed(spark, sf), ["x"], ["s"], 2)
    return model.eigenvalues(spark).select("component", F.round("eigenvalue", 6).alias("eigenvalue"), F.round("pct", 5).alias("pct"))


@query(f"""WITH m AS ({_MIXED}), z AS (SELECT {', '.join(_KEYS)}, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS a, ((s = 'much')::INT - avg((s = 'much')::INT) OVER ()) / stddev_pop((s = 'much')::INT) OVER () AS b FROM m),
c AS (SELECT sign(corr(a, b)) AS c FROM z) SELECT {', '.join(_KEYS)}, round((a + c * b) / sqrt(2.0::DOUBLE), 5) AS f0, round((a - c * b) / sqrt(2.0::DOUBLE), 5) AS f1 FROM z, c""")
def famd_mixed_rows(spark, sf):
    m = _mixed(spark, sf)
    out = famd.fit(m, ["x"], ["s"], 2).rows(m)
    return out.select(*_KEYS, F.round("f0", 5).alias("f0"), F.round("f1", 5).alias("f1"))
