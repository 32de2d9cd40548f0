"""Registered queries: joins, first rows per key, sampling, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalogue.tables import r6, table
from kerbside.functions import columns as fc
from kerbside.operators import clean, compare, impute, joins, ordered
from kerbside.sources import raw

QUERIES, SQL = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


# A line is one row; this order makes every tie-break unambiguous.
_POS_SQL = "l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"
_POS = _POS_SQL.split(", ")


def _desc(names):
    return ", ".join(f"{n} DESC" for n in names.split(", "))


def _lines(spark, sf):
    return table(spark, sf, "lineitem").withColumn("_src_pos", F.struct(*_POS))


_USER_NO = """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
  concat(user_id, '_U', row_number() OVER (PARTITION BY user_id ORDER BY event_id)) AS id_user FROM events"""


@query(_USER_NO)
def group_row_key(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    bucket = F.floor(F.col("event_id") / 1000)      # any cut that follows the order
    out = ordered.row_number_in_group(e, ["user_id"], [F.col("event_id")], bucket, "rn")
    return ordered.synthetic_key(out, "user_id", [F.col("event_id")], bucket)


_BEST = f"""SELECT * EXCLUDE (rk) FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, score, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY score DESC, CASE WHEN l_tax > 0 THEN 1 ELSE 0 END DESC, CASE WHEN l_discount > 0 THEN 1 ELSE 0 END DESC, l_linenumber ASC, {_desc(_POS_SQL)}) AS rk
  FROM (SELECT *, CASE WHEN l_linenumber <> 1 THEN 2 ELSE 0 END + CASE WHEN l_tax > 0 THEN 2 ELSE 0 END
   + CASE WHEN l_discount > 0 THEN 1 ELSE 0 END + CASE WHEN l_quantity > 5 THEN 1 ELSE 0 END AS score FROM lineitem)) WHERE rk = 1"""


def _best_line(spark, sf):
    li = _lines(spark, sf)
    gaps = li.withColumns({"a": F.when(F.col("l_linenumber") == 1, -1).otherwise(F.col("l_linenumber")),
                           "b": F.nullif("l_tax", F.lit(0.0)), "c": F.nullif("l_discount", F.lit(0.0)),
                           "d": F.when(F.col("l_quantity") > 5, F.col("l_quantity"))})
    score = fc.filled_weight({"a": 2, "b": 2, "c": 1, "d": 1})
    gaps = gaps.withColumn("score", score)
    best = joins.best_location(gaps, ["l_orderkey"], F.col("score"), F.col("b").isNotNull(),
                               F.col("c").isNotNull(), F.col("l_linenumber"), F.col("_src_pos"))
    return best.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "score")


@query(_BEST)
def best_row_per_key(spark, sf):
    return _best_line(spark, sf)


_VEH = f"""veh AS (SELECT l_orderkey AS acc, l_suppkey AS veh, l_quantity AS score, l_returnflag AS flag, l_partkey AS part, l_linenumber AS no,
  row_number() OVER (ORDER BY {_POS_SQL}) AS pos FROM lineitem),
own AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY acc, veh ORDER BY pos DESC) AS rk FROM veh) WHERE rk = 1),
other AS (SELECT * EXCLUDE (rk) FROM (SELECT o.*, v.flag AS flag_other, v.part AS part_other, v.score AS score_other, v.veh AS veh_other,
  row_number() OVER (PARTITION BY o.acc, o.veh ORDER BY v.score DESC NULLS LAST, v.pos DESC) AS rk
  FROM own o LEFT JOIN veh v ON o.acc = v.acc AND o.veh <> v.veh) WHERE rk = 1)"""


def _opponents(spark, sf):
    li = _lines(spark, sf).select(
        F.col("l_orderkey").alias("acc"), F.col("l_suppkey").alias("veh"), F.col("l_quantity").alias("score"),
        F.col("l_returnflag").alias("flag"), F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("no"), "_src_pos")
    return joins.with_opponent(li, "acc", "veh", "score", F.col("_src_pos"),
                               ["veh", "score", "flag", "part"]).drop("_src_pos")


@query(f"WITH {_VEH} SELECT acc, veh, score, flag, part, no, veh_other, score_other, flag_other, part_other FROM other")
def antagonist(spark, sf):
    return _opponents(spark, sf)


@query(f"""WITH {_VEH} SELECT acc, no, CASE WHEN flag = 'R' THEN NULL ELSE veh END AS veh, CASE WHEN flag = 'R' THEN NULL ELSE part END AS part,
  CASE WHEN flag = 'R' THEN veh ELSE veh_other END AS veh_other, CASE WHEN flag = 'R' THEN part ELSE part_other END AS part_other, flag FROM other""")
def role_swap(spark, sf):
    out = joins.swap_roles(_opponents(spark, sf), F.col("flag") == "R", ["veh", "part"])
    return out.select("acc", "no", "veh", "part", "veh_other", "part_other", "flag")


@query("""SELECT l_orderkey, any_value(l_partkey) AS l_partkey, any_value(l_suppkey) AS l_suppkey, any_value(l_quantity) AS l_quantity
FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1""")
def lone_rows(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return ordered.single_row_groups(li, ["l_orderkey"])


_COUNTS = ", ".join(f"sum(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END)::BIGINT AS \"n_{t}\"" for t in
                    ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _type_counts(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey")
    return joins.category_counts(li, "l_orderkey", "p_type", _TYPES, "n_")


@query(f"SELECT l_orderkey, {_COUNTS} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey")
def category_counts(spark, sf):
    return _type_counts(spark, sf)


@query(f"""WITH best AS ({_BEST}), counts AS (SELECT l_orderkey, {_COUNTS} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT o_orderkey, o_custkey, o_orderstatus, b.l_partkey, b.l_linenumber, b.score, c.c_mktsegment, {", ".join(f'n."n_{t}"' for t in _TYPES)}
FROM orders o LEFT JOIN best b ON o.o_orderkey = b.l_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN counts n ON o.o_orderkey = n.l_orderkey""")
def star_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    best = _best_line(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber", "score")
    counts = _type_counts(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.star(o, [best, counts], "o_orderkey").join(customer, "o_custkey", "left")


@query("""WITH dim AS (SELECT k, max(c_mktsegment) AS seg FROM (SELECT nullif(c_custkey % 5, 0) AS k, c_mktsegment FROM customer) GROUP BY k)
SELECT o.o_orderkey, nullif(o.o_custkey % 5, 0) AS k, d.seg FROM orders o LEFT JOIN dim d ON nullif(o.o_custkey % 5, 0) IS NOT DISTINCT FROM d.k""")
def nullsafe_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.nullif(F.col("o_custkey") % 5, F.lit(0)).alias("k"))
    dim = (table(spark, sf, "customer").select(F.nullif(F.col("c_custkey") % 5, F.lit(0)).alias("k"), "c_mktsegment")
           .groupBy("k").agg(F.max("c_mktsegment").alias("seg")))
    return joins.left_null_safe(o, dim, ["k"], ["k"])


@query("""WITH t AS (SELECT p_brand, p_size, count(*) AS n, avg(p_retailprice) AS m FROM part GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY m DESC, p_size) AS rk FROM t) WHERE rk = 1),
top AS (SELECT p_brand, round(max(n) * 100.0 / sum(n), 6) AS largest_pct FROM t GROUP BY 1)
SELECT p_brand, p_size, n, round(m, 6) AS m, largest_pct FROM best JOIN top USING (p_brand)""")
def best_param(spark, sf):
    from kerbside.operators.evaluate import best_per_group
    t = table(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("m"))
    best = best_per_group(t, "p_brand", "m", [F.asc("p_size")])
    top = t.groupBy("p_brand").agg(r6(F.max("n") * 100.0 / F.sum("n")).alias("largest_pct"))
    return joins.small_inner(best, top, "p_brand").select("p_brand", "p_size", "n", r6("m").alias("m"), "largest_pct")


# ---- sampling --------------------------------------------------------------------------
_H = "md5(concat_ws('|', '42', CAST(event_id AS VARCHAR)))"


@query(f"SELECT event_id, user_id, event_type FROM events ORDER BY {_H}, event_id LIMIT 200")
def hash_sample(spark, sf):
    return ordered.hash_sample(table(spark, sf, "events").select("event_id", "user_id", "event_type"), 200, ["event_id"])


@query(f"""SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {_H}, event_id) AS rk FROM events)
WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_type))""")
def undersample(spark, sf):
    return ordered.undersample(table(spark, sf, "events").select("event_id", "event_type", "value"), "event_type", ["event_id"])


@query(f"""SELECT event_id, event_type, CAST((row_number() OVER (PARTITION BY event_type ORDER BY {_H}, event_id) - 1) % 3 AS INT) AS fold FROM events""")
def stratified_folds(spark, sf):
    return ordered.stratified_folds(table(spark, sf, "events").select("event_id", "event_type"), "event_type", ["event_id"], 3)


# ---- sets ------------------------------------------------------------------------------
@query("""SELECT l_returnflag, l_linestatus, l_linenumber, greatest(a - b, 0)::BIGINT AS only_left, greatest(b - a, 0)::BIGINT AS only_right FROM (
 SELECT l_returnflag, l_linestatus, l_linenumber, sum(CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN l_quantity < 40 THEN 1 ELSE 0 END) AS b
 FROM lineitem GROUP BY ALL) WHERE a <> b""")
def table_diff(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return compare.table_diff(li.filter("l_quantity > 10").select(cols), li.filter("l_quantity < 40").select(cols))


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders)
SELECT (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) = 0 AS equal, (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS only_left,
 (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a)) AS only_right""")
def table_equality(spark, sf):
    a = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    b = a.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 100 == 0, "X").otherwise(F.col("o_orderstatus")))
    return compare.diff_summary(a, b)


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CASE WHEN year(o_orderdate) = 2000 THEN 'test' ELSE 'train' END AS part, CASE WHEN year(o_orderdate) = 2000 THEN o_orderstatus END AS extra FROM orders""")
def union_years(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), "o_orderstatus")
    train, test = clean.split_by_year(o, "y", [2000])
    return joins.append(train.drop("o_orderstatus").withColumn("part", F.lit("train")),
                        test.withColumnRenamed("o_orderstatus", "extra").withColumn("part", F.lit("test")))


@query("""SELECT CAST(year(o_orderdate) AS INT) AS y, o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY ALL""")
def split_by_year(spark, sf):
    o = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    train, _ = clean.split_by_year(o, "y", [2000], train_years=[1997, 1998])
    return train.groupBy("y", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT k FROM (SELECT l_suppkey AS k FROM lineitem WHERE l_quantity > 49 UNION ALL SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""")
def key_union(spark, sf):
    a = table(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_suppkey").alias("k"))
    b = table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("k"))
    return compare.key_union(a, b, "k")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_quantity DESC, l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 40""")
def top_n(spark, sf):
    from kerbside.operators.profile import top_rows
    li = table(spark, sf, "lineitem")
    return top_rows(li, [F.desc("l_quantity"), F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_partkey"),
                         F.asc("l_suppkey"), F.asc("l_linenumber")], 40).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("""WITH c AS (SELECT table_name AS t, column_name AS c FROM duckdb_columns() WHERE table_name IN ('customer', 'supplier', 'nation'))
SELECT c AS "column", bool_or(t = 'customer') AS customer, bool_or(t = 'supplier') AS supplier, bool_or(t = 'nation') AS nation,
  count(*) <> 3 AS is_different FROM c GROUP BY c""")
def schema_compare(spark, sf):
    return raw.compare_schemas({n: table(spark, sf, n) for n in ("customer", "supplier", "nation")})


@query("""SELECT 'orders' AS "table", count(*) AS rows, 6::BIGINT AS columns FROM orders UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
UNION ALL SELECT 'part', count(*), 6 FROM part UNION ALL SELECT 'events', count(*), 6 FROM events""")
def file_shapes(spark, sf):
    return raw.table_shapes({n: table(spark, sf, n) for n in ("orders", "lineitem", "part", "events")})


@query("""SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_totalprice > 400000 THEN 'price above limit' ELSE 'no such day' END AS reason
FROM orders WHERE o_totalprice > 400000 OR day(o_orderdate) = 31""")
def reject_rows(spark, sf):
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return raw.rejects(o, "o_orderkey", {"price above limit": F.col("o_totalprice") <= 400000,
                                         "no such day": fc.valid_date(F.lit(2023), F.lit(4), F.dayofmonth("o_orderdate")).isNotNull()},
                       year="year")
