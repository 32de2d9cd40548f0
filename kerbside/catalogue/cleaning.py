"""Registered queries: cleaning, scalar functions, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalogue.tables import r6, table
from kerbside.functions import columns as fc
from kerbside.operators import clean, features, impute, joins, ordered

CLASS_CASE = """CASE WHEN {c} IS NULL THEN NULL WHEN {c} IN (1,80) THEN 'bicycle'
  WHEN {c} IN (2,30,31,32,33,34,41,42,43) THEN 'powered_2_3_wheeler' WHEN {c} IN (7,10) THEN 'light_motor_vehicle'
  WHEN {c} IN (13,14,15,16,17) THEN 'hgv_truck' WHEN {c} IN (37,38) THEN 'bus_coach' ELSE 'other' END"""
WEIGHT_CASE = """CASE {c} WHEN 'hgv_truck' THEN 6 WHEN 'bus_coach' THEN 5 WHEN 'light_motor_vehicle' THEN 4
  WHEN 'powered_2_3_wheeler' THEN 3 WHEN 'bicycle' THEN 2 ELSE 1 END"""

QUERIES, SQL = {}, {}


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


@query("""SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#', ' ') AS BIGINT) AS brand_id,
  TRY_CAST(regexp_replace(p_name, '\\s+', '', 'g') AS BIGINT) AS name_id,
  coalesce(TRY_CAST(CASE WHEN p_size % 5 = 0 THEN '#MULTI' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE), -1) AS lanes
FROM part""")
def clean_numeric_text(spark, sf):
    p = table(spark, sf, "part").withColumn("_b", F.regexp_replace("p_brand", "Brand#", "  "))
    size = F.when(F.col("p_size") % 5 == 0, "#MULTI").otherwise(F.col("p_size").cast("string"))
    return p.select("p_partkey", fc.blank_free_long("_b").alias("brand_id"),
                    fc.blank_free_long("p_name").alias("name_id"), fc.lane_count(size).alias("lanes"))


@query("""SELECT p_partkey, p_brand FROM part
WHERE TRY_CAST(CASE WHEN p_size < 25 THEN CAST(p_size AS VARCHAR) ELSE p_brand END AS DOUBLE) IS NULL""")
def non_numeric_text(spark, sf):
    p = table(spark, sf, "part").withColumn(
        "t", F.when(F.col("p_size") < 25, F.col("p_size").cast("string")).otherwise(F.col("p_brand")))
    return clean.keep_non_numeric(p, "t").select("p_partkey", "p_brand")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_quantity,
  CASE WHEN l_linenumber IN (1, 7) THEN NULL ELSE l_linenumber END AS l_linenumber,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def na_codes(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_linenumber", "l_returnflag")
    return clean.sentinels_to_null(li, {"l_linenumber": [1, 7], "l_returnflag": ["N"]})


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_tax FROM (SELECT l_orderkey, l_partkey, l_linenumber,
  nullif(l_tax, 0.0) AS l_tax FROM lineitem) WHERE (l_linenumber IS NULL OR l_linenumber <> 1) AND (l_tax IS NULL OR l_tax <> 0.05)""")
def sentinel_filter(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                             F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return clean.drop_sentinel_rows(clean.drop_sentinel_rows(li, ["l_linenumber"], 1), ["l_tax"], 0.05)


@query("""WITH t AS (SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber = 2 THEN -1 ELSE l_linenumber END AS code,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS INT) END AS manoeuvre,
  CASE WHEN l_returnflag = 'N' THEN '-1' ELSE l_returnflag END AS flag FROM lineitem)
SELECT l_orderkey, l_partkey, code, coalesce(manoeuvre, -1) AS manoeuvre, flag FROM t WHERE code <> -1 AND flag <> '-1'""")
def complete_rows(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(F.col("l_linenumber") == 2, -1).otherwise(F.col("l_linenumber")).alias("code"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("int")).alias("manoeuvre"),
        F.when(F.col("l_returnflag") == "N", "-1").otherwise(F.col("l_returnflag")).alias("flag"))
    return clean.complete_rows(li, ["manoeuvre"])


@query(f"""SELECT p_partkey, {CLASS_CASE.format(c='p_size')} AS vehicle_class FROM part""")
def category_simplify(spark, sf):
    return table(spark, sf, "part").select("p_partkey", fc.vehicle_class("p_size").alias("vehicle_class"))


@query(f"""WITH t AS (SELECT p_partkey, {CLASS_CASE.format(c='nullif(p_size, 7)')} AS own,
  {CLASS_CASE.format(c='nullif(p_size + 1, 8)')} AS other FROM part),
u AS (SELECT p_partkey, coalesce(own, 'unknown') AS own_simplified, coalesce(other, 'none') AS other_simplified FROM t)
SELECT *, {WEIGHT_CASE.format(c='own_simplified')} AS own_score, {WEIGHT_CASE.format(c='other_simplified')} AS other_score,
  ({WEIGHT_CASE.format(c='own_simplified')}) - ({WEIGHT_CASE.format(c='other_simplified')}) AS delta FROM u""")
def impact_weight(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", fc.vehicle_class(F.nullif("p_size", F.lit(7))).alias("vehicle_category"),
        fc.vehicle_class(F.nullif(F.col("p_size") + 1, F.lit(8))).alias("vehicle_category_other"))
    out = features.add_vehicle_scores(p)
    return out.select("p_partkey", F.col("vehicle_category_simplified").alias("own_simplified"),
                      F.col("vehicle_category_simplified_other").alias("other_simplified"),
                      F.col("impact_score").alias("own_score"), F.col("impact_score_other").alias("other_score"),
                      F.col("impact_delta").alias("delta"))


@query("""SELECT l_orderkey, l_partkey, nullif(l_tax, 0.0) AS l_tax FROM lineitem WHERE l_tax = 0.0 OR l_tax <= 0.05""")
def range_filter_keep_null(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return clean.keep_up_to(li, "l_tax", 0.05)


@query("""SELECT o_orderkey, year(d) AS y, month(d) AS m, day(d) AS dd FROM (SELECT o_orderkey,
  TRY_CAST(concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate) + 3) AS DATE) AS d FROM orders) WHERE d IS NOT NULL""")
def valid_date_filter(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("_y"),
                                          F.month("o_orderdate").alias("_m"),
                                          (F.dayofmonth("o_orderdate") + 3).alias("_d"))
    out = clean.keep_valid_dates(o, "_y", "_m", "_d", into="d")
    return out.select("o_orderkey", F.year("d").alias("y"), F.month("d").alias("m"), F.dayofmonth("d").alias("dd"))


@query("""SELECT o_orderkey AS accident, o_orderstatus AS grade FROM orders""")
def rename_columns(spark, sf):
    o = table(spark, sf, "orders")
    out = clean.rename(o, {"o_orderkey": "accident", "o_orderstatus": "grade", "absent": "x"})
    return clean.drop_present(out, ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "not_there"])


@query("""SELECT o_orderkey, CAST(o_custkey % 1000 AS SMALLINT) AS code, CAST(NULL AS SMALLINT) AS nothing FROM orders""")
def small_codes(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 1000).alias("code"),
                                          F.lit(None).cast("int").alias("nothing"))
    return clean.to_smallint(o, ["code", "nothing", "absent"])


@query("""SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1
  WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 END AS o_orderpriority_code FROM orders""")
def fixed_domain(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return clean.fixed_domains(o, {"o_orderpriority": ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]})


@query("""SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS o_orderstatus_label FROM orders""")
def codebook_decode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return clean.decode(o, {"o_orderstatus": {"F": "finished", "O": "open"}})


@query("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 7""")
def point_lookup(spark, sf):
    return clean.by_key(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey", 7)


@query("""SELECT round(avg(CASE WHEN l_returnflag = 'R' OR l_quantity > 40 THEN 1.0 ELSE 0.0 END), 6) AS share FROM lineitem""")
def predicate_share(spark, sf):
    li = table(spark, sf, "lineitem")
    out = clean.share_where(li, (F.col("l_returnflag") == "R") | (F.col("l_quantity") > 40))
    return out.select(r6("share").alias("share"))


@query("""SELECT event_id, round(sin(2*pi()*hour(ts)/24), 6) AS hour_sin, round(cos(2*pi()*hour(ts)/24), 6) AS hour_cos,
  round(sin(2*pi()*(isodow(ts)-1)/7), 6) AS day_of_week_sin, round(cos(2*pi()*(isodow(ts)-1)/7), 6) AS day_of_week_cos,
  round(sin(2*pi()*month(ts)/12), 6) AS month_sin, round(cos(2*pi()*month(ts)/12), 6) AS month_cos,
  round(sin(2*pi()*dayofyear(ts)/365.25), 6) AS day_of_year_sin, round(cos(2*pi()*dayofyear(ts)/365.25), 6) AS day_of_year_cos,
  CAST(isodow(ts)-1 AS INT) AS day_of_week FROM events""")
def cyclical_time(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", F.month("ts").alias("month"), F.hour("ts").alias("hour"))
    out = features.cyclic_pair(features.add_calendar(e, "ts"), "hour", "hour", 24)
    waves = [c for c in out.columns if c.endswith(("_sin", "_cos"))]
    return out.select("event_id", "day_of_week", *[r6(c).alias(c) for c in waves])


@query("""WITH t AS (SELECT event_id, strftime(ts, '%H:%M') AS hm, hour(ts) AS h, minute(ts) AS mi FROM events)
SELECT event_id, CAST(h AS INT) AS hour, CAST(mi AS INT) AS minute,
  CASE WHEN h < 6 OR h >= 20 THEN 'Night' WHEN h < 10 THEN 'Morning_Rush' WHEN h < 16 THEN 'Midday' ELSE 'Evening_Rush' END AS time_of_day,
  round(sin(2*pi()*h/24), 6) AS hour_sin, round(cos(2*pi()*h/24), 6) AS hour_cos FROM t""")
def time_buckets(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.date_format("ts", "HH:mm").alias("hour_minute"))
    out = features.add_time(e)
    return out.select("event_id", "hour", "minute", "time_of_day", r6("hour_sin").alias("hour_sin"),
                      r6("hour_cos").alias("hour_cos"))


@query("""SELECT event_id, CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'Morning' WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'Afternoon'
  WHEN hour(ts) >= 17 AND hour(ts) < 22 THEN 'Evening' ELSE 'Night' END AS day_period FROM events""")
def day_period(spark, sf):
    return table(spark, sf, "events").select("event_id", fc.day_period(F.hour("ts")).alias("day_period"))


@query("""WITH t AS (SELECT o.o_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
  year(l.l_shipdate) + CAST(l.l_quantity AS INT) * 2 - year(o.o_orderdate) AS age FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT o_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CAST(age AS INT) AS age,
  CASE WHEN age >= 0 AND age < 18 THEN 'child_teen' WHEN age >= 18 AND age < 25 THEN 'young_adult' WHEN age >= 25 AND age < 40 THEN 'adult'
  WHEN age >= 40 AND age < 65 THEN 'middle_aged' WHEN age >= 65 AND age < 100 THEN 'senior' END AS age_group FROM t""")
def join_year_age(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        (-(F.year("l_shipdate") + F.col("l_quantity").cast("int") * 2)).alias("born"))
    o = table(spark, sf, "orders").select("o_orderkey", (-F.year("o_orderdate")).alias("year"))
    out = joins.with_age(li, o, "o_orderkey", "year", "born")
    return out.select("o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "age",
                      fc.age_group("age").alias("age_group"))


_CODES = "l_linenumber, CAST(l_quantity AS INT) % 10, CAST(l_discount * 100 AS INT)"


def _has(values):
    return (f"CASE WHEN c1 IN ({values}) OR c2 IN ({values}) OR c3 IN ({values}) THEN 1 ELSE 0 END")


@query(f"""WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS c1, CAST(l_quantity AS INT) % 10 AS c2,
  CASE WHEN l_discount = 0 THEN NULL ELSE CAST(round(l_discount * 100) AS INT) END AS c3 FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, c1, c2, {_has('1')} AS used_belt, {_has('2')} AS used_helmet, {_has('3')} AS used_child_restraint,
 {_has('4')} AS used_reflective_vest, {_has('5,7')} AS used_airbag, {_has('6,7')} AS used_gloves, {_has('9')} AS used_other,
 {_has('1,2,3,4,5,6,7,9')} AS any_equipment, {_has('0')} AS no_equipment, {_has('-1')} AS equipment_not_reported,
 {_has('8')} AS equipment_not_determinable FROM t""")
def any_flag(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("c1"),
        (F.col("l_quantity").cast("int") % 10).alias("c2"),
        F.when(F.col("l_discount") != 0, F.round(F.col("l_discount") * 100).cast("int")).alias("c3"))
    cols = ["c1", "c2", "c3"]
    return features.add_equipment_summary(features.add_safety_flags(li, cols), cols).drop("c3")


@query("""WITH t AS (SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, year(o.o_orderdate) AS y,
  least(coalesce(CASE WHEN l.l_quantity > 45 THEN NULL ELSE l.l_quantity END, 1.0), 8.0)
  + coalesce(CASE l.l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 3 WHEN 5 THEN 6 WHEN 6 THEN 7 WHEN 7 THEN 8 END, 1)
  + CASE l.l_suppkey % 10 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 1 WHEN 6 THEN 3 WHEN 7 THEN 4 ELSE 1 END
  + CASE l.l_partkey % 6 - 1 WHEN 2 THEN 4 WHEN 3 THEN 2 WHEN 4 THEN 6 ELSE 1 END AS raw FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CAST(y AS INT) AS y,
  round(10.0 * (raw - min(raw) OVER (PARTITION BY y)) / (max(raw) OVER (PARTITION BY y) - min(raw) OVER (PARTITION BY y)), 6) AS complexity FROM t""")
def complexity_index(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("y"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    raw = fc.road_complexity_raw(
        F.when(F.col("l_quantity") > 45, "#MULTI").otherwise(F.col("l_quantity").cast("string")), "l_linenumber",
        (F.col("l_suppkey") % 10).cast("int"), (F.col("l_partkey") % 6 - 1).cast("int"))
    t = li.join(o, "l_orderkey").withColumn("complexity", raw)
    out = features.min_max_scaled(t, "complexity", "y")
    return out.withColumn("complexity", r6("complexity"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber = 1 AND nullif(l_tax, 0.0) IS NOT NULL AND CAST(round(l_tax * 100) AS INT) = 1
  THEN 1 ELSE 0 END AS surface_quality_indicator FROM lineitem""")
def binary_and_flag(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(F.col("l_tax") != 0, F.round(F.col("l_tax") * 100).cast("int")).alias("_p"))
    return features.add_surface(li, "l_linenumber", "_p").drop("_p")


@query("""WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS c FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, c, CASE c WHEN 1 THEN 'driver' WHEN 2 THEN 'passenger' WHEN 3 THEN 'pedestrian' ELSE 'other' END AS role,
 CASE c WHEN 5 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 3 ELSE 0 END AS lighting_ordinal,
 CASE c WHEN 2 THEN 2 WHEN 7 THEN 2 WHEN 6 THEN 3 WHEN 3 THEN 3 WHEN 5 THEN 4 WHEN 4 THEN 4 ELSE 0 END AS weather_ordinal FROM t""")
def ordinal_map(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("c"))
    return features.add_ordinals(features.add_role(li, "c"), "c", "c")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 0 WHEN 4 THEN 1 WHEN 3 THEN 2 WHEN 2 THEN 2 END AS injury_target FROM lineitem""")
def target_map(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return features.add_target(li, "l_linenumber")


_GAPS = """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity,
  CASE l_linenumber WHEN 1 THEN 'driver' WHEN 2 THEN 'passenger' WHEN 3 THEN 'pedestrian' ELSE 'other' END AS role,
  CASE WHEN l_quantity % 3 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS gap3,
  CASE WHEN l_quantity % 4 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS gap4,
  nullif(l_returnflag, 'N') AS category, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_suppkey END AS other_id FROM lineitem"""


def _gaps(spark, sf):
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("int")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                     fc.lookup("l_linenumber", {1: "driver", 2: "passenger", 3: "pedestrian"}, "other").alias("role"),
                     F.when(q % 3 != 0, q).alias("gap3"), F.when(q % 4 != 0, q).alias("gap4"),
                     F.nullif("l_returnflag", F.lit("N")).alias("category"),
                     F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("other_id"))


@query(f"""WITH t AS ({_GAPS}), u AS (SELECT *, coalesce(gap3, CASE WHEN role = 'pedestrian' THEN -1 END) AS g3,
  coalesce(category, CASE WHEN role = 'pedestrian' THEN 'none' END) AS cat,
  coalesce(gap4, CASE WHEN role IN ('pedestrian','passenger') THEN -1 ELSE 0 END) AS g4 FROM t)
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, role, g3 AS gap3, g4 AS gap4, cat AS category FROM u WHERE g3 IS NOT NULL AND cat IS NOT NULL""")
def conditional_impute(spark, sf):
    return impute.own_vehicle(_gaps(spark, sf), not_applicable=("gap3",), category="category",
                              by_activity=("gap4",)).drop("other_id")


@query(f"""WITH t AS ({_GAPS}), u AS (SELECT *, coalesce(gap3, CASE WHEN other_id IS NULL THEN -1 END) AS g3,
  coalesce(category, CASE WHEN other_id IS NULL THEN 'none' END) AS cat,
  coalesce(gap4, CASE WHEN other_id IS NULL THEN -1 ELSE 0 END) AS g4 FROM t)
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, role, g3 AS gap3, g4 AS gap4, cat AS category,
  CASE WHEN other_id IS NULL THEN 0 ELSE 1 END AS has_other FROM u WHERE g3 IS NOT NULL AND cat IS NOT NULL""")
def impute_other(spark, sf):
    t = impute.flag_present(_gaps(spark, sf), "other_id", "has_other")
    return impute.other_vehicle(t, presence="other_id", category="category", impact="gap3",
                                unknown_if_present=("gap4",)).drop("other_id")


@query(f"""WITH t AS ({_GAPS}) SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, role, coalesce(category, 'Unknown') AS category,
  coalesce(gap4, 0) AS age FROM t WHERE gap3 IS NOT NULL""")
def impute_rest(spark, sf):
    t = _gaps(spark, sf).dropna(subset=["gap3"])
    out = impute.fill_text(t).withColumnRenamed("gap4", "age").fillna(0, subset=["age"])
    return out.drop("gap3", "other_id")


@query(f"""WITH t AS ({_GAPS}),
m3 AS (SELECT gap3 AS v FROM t WHERE gap3 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
m4 AS (SELECT gap4 AS v FROM t WHERE gap4 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
mc AS (SELECT category AS v FROM t WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, coalesce(gap3, (SELECT v FROM m3)) AS gap3, coalesce(gap4, (SELECT v FROM m4)) AS gap4,
  coalesce(category, (SELECT v FROM mc)) AS category FROM t""")
def mode_impute(spark, sf):
    return impute.mode_impute(_gaps(spark, sf).drop("role", "other_id"), ["gap3", "gap4", "category"])


_MD5 = "md5(concat_ws('|', '42', CAST({k} AS VARCHAR)))"


@query(f"""WITH t AS (SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value, {_MD5.format(k='event_id')} AS h FROM events),
pool AS (SELECT value AS v, row_number() OVER (ORDER BY h, event_id) AS pos FROM t WHERE value IS NOT NULL), n AS (SELECT count(*) AS n FROM pool)
SELECT event_id, user_id, value FROM t WHERE value IS NOT NULL UNION ALL
SELECT event_id, user_id, v FROM (SELECT event_id, user_id, CAST(floor(CAST(('0x' || substr(h, 20, 13)) AS BIGINT) / 4503599627370496.0 * (SELECT n FROM n)) AS BIGINT) + 1 AS p FROM t WHERE value IS NULL) m
 JOIN pool ON m.p = pool.pos""")
def random_draw_impute(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id",
                                          F.when(F.col("event_type") != "click", F.col("value")).alias("value"))
    return ordered.random_draw_impute(e, "value", ["event_id"])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 = 0 OR l_quantity % 2 = 0 THEN 1 ELSE 0 END AS any_set,
 CAST(CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN l_quantity % 2 = 0 THEN 1 ELSE 0 END AS INT) AS n_set FROM lineitem""")
def row_reduce(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") % 3 == 0, 1).alias("a"),
        (F.col("l_quantity") % 2 == 0).cast("int").alias("b"))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", impute.any_positive(["a", "b"]).alias("any_set"),
                     impute.row_sum(["a", "b"]).cast("int").alias("n_set"))
