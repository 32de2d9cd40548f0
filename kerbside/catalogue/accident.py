"""Registered queries: the accident table from raw relations that Spark derives from the
driver's tables (an order stands for an accident, its lines for locations, vehicles and
users).  Everything is text with the gaps and odd values of the raw files."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalogue.cleaning import CLASS_CASE, WEIGHT_CASE
from kerbside.catalogue.tables import table
from kerbside.functions import codes
from kerbside.operators import clean, profile
from kerbside.plans import accidents, modelling
from kerbside.sources import raw as raw_source
from kerbside.streaming import scoring

QUERIES, SQL = {}, {}

# The same expressions are valid in Spark SQL and DuckDB.
_CIRC = {
    "Num_Acc": "o_orderkey", "jour": "day(o_orderdate) + 3", "mois": "month(o_orderdate)", "an": "year(o_orderdate)",
    "hrmn": "concat(cast(CAST(floor(o_totalprice) AS BIGINT) % 24 as varchar(2)), ':', lpad(cast(CAST(floor(o_totalprice / 24) AS BIGINT) % 60 as varchar(2)), 2, '0'))",
    "lum": "o_custkey % 7 - 1", "dep": "o_custkey % 95", "com": "o_custkey", "agg": "o_custkey % 2 + 1", "int": "o_custkey % 10",
    "atm": "o_custkey % 11 - 1", "col": "o_custkey % 9 - 1", "adr": "o_orderpriority",
    "lat": "concat('48,', cast(o_custkey % 100 as varchar(3)))", "long": "concat('2,', cast(o_custkey % 37 as varchar(3)))",
}
_LOC = {
    "Num_Acc": "l_orderkey", "catr": "nullif(l_suppkey % 10, 0)", "voie": "nullif(l_returnflag, 'N')", "v1": "NULL", "v2": "l_linestatus",
    "circ": "l_partkey % 6 - 1", "nbv": "CASE WHEN l_quantity > 45 THEN '#VALEURMULTI' ELSE cast(cast(l_quantity as int) % 12 as varchar(9)) END",
    "vosp": "l_linenumber % 5 - 1", "prof": "nullif(l_partkey % 5, 0)", "pr": "CASE WHEN l_tax > 0.04 THEN '1 234' END", "pr1": "CASE WHEN l_discount > 0.05 THEN '0' END",
    "plan": "l_suppkey % 6 - 1", "lartpc": "NULL", "larrout": "NULL", "surf": "nullif(l_linenumber % 4, 0)", "infra": "l_suppkey % 11 - 1", "situ": "l_partkey % 9 - 1",
    "vma": "CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_suppkey % 17 = 0 THEN 500 ELSE 30 + 10 * (l_suppkey % 11) END",
}
_VEH = {
    "Num_Acc": "l_orderkey", "id_vehicule": "concat('7 ', lpad(cast(l_suppkey as varchar(9)), 6, '0'))", "num_veh": "concat('A', cast(l_linenumber as varchar(2)))",
    "senc": "l_linenumber % 5 - 1", "catv": "l_partkey % 45 - 1", "obs": "l_suppkey % 19 - 1", "obsm": "l_partkey % 8 - 1", "choc": "l_partkey % 11 - 1",
    "manv": "l_suppkey % 28 - 1", "motor": "l_partkey % 8 - 1", "occutc": "NULL",
}
_USR = {
    "Num_Acc": "l_orderkey", "id_usager": "concat(cast(l_orderkey as varchar(20)), ' ', cast(l_partkey as varchar(20)), ' ', cast(l_linenumber as varchar(2)))",
    "id_vehicule": "concat('7', lpad(cast(l_suppkey as varchar(9)), 6, '0'))", "num_veh": "concat('A', cast(l_linenumber as varchar(2)))",
    "place": "l_linenumber", "catu": "l_partkey % 4", "grav": "CASE WHEN l_partkey % 23 = 0 THEN -1 ELSE l_suppkey % 4 + 1 END", "sexe": "l_partkey % 2 + 1",
    "an_nais": "CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE 1900 + l_partkey % 99 END", "trajet": "l_linenumber % 6", "secu1": "l_linenumber", "secu2": "l_suppkey % 11 - 1",
    "secu3": "-1", "locp": "l_partkey % 10", "actp": "CASE WHEN l_partkey % 3 = 0 THEN 'A' ELSE cast(l_partkey % 10 as varchar(2)) END", "etatp": "l_partkey % 4",
}
_POS = "l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus".split(", ")


def raw_tables(spark, sf):
    def text(df, columns, position):
        return df.select(*[F.expr(e).cast("string").alias(c) for c, e in columns.items()], F.struct(*position).alias("_src_pos"))
    lines = table(spark, sf, "lineitem")
    return {"circumstances": text(table(spark, sf, "orders"), _CIRC, ["o_orderkey"]), "locations": text(lines, _LOC, _POS),
            "vehicles": text(lines, _VEH, _POS), "users": text(lines, _USR, _POS)}


def _stages(spark, sf):
    return accidents.build(raw_tables(spark, sf), bucket=F.lit(0))


_KEEP = ["id_accident", "id_user", "id_vehicle", "id_vehicle_other", "year"]
_REAL = ["hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos", "day_of_year_sin", "day_of_year_cos", "road_complexity_index"]


def accident_table(spark, sf):
    """Raw relations to imputed modelling rows."""
    f = accidents.selected(_stages(spark, sf)["E_imputed"], keep=_KEEP)
    return f.withColumns({c: F.round(c, 6) for c in _REAL})


def accident_merge(spark, sf):
    """Accident, best location, user, own and other vehicle, counts: before features."""
    c = _stages(spark, sf)["C_merged"]
    return c.select("id_accident", "id_user", "speed_limit", "road_category", "number_of_traffic_lanes", "user_category",
                    *[x + s for x in codes.MIRRORED[:-1] for s in ("", "_other")],
                    *[f"vehicle_category_involved_{k}" for k in codes.SIX_CLASSES])


def _view(columns, source, extra=""):
    return f"SELECT {', '.join(f'{e} AS {c!r}'.replace(chr(39) + c + chr(39), chr(34) + c + chr(34)) for c, e in columns.items())}{extra} FROM {source}"


_N = lambda c: f"nullif({c}, -1)"
_MIR = ["id_vehicle", "number_vehicle", "direction_of_travel", "vehicle_category", "fixed_obstacle_struck", "mobile_obstacle_struck",
        "initial_point_of_impact", "main_maneuver_before_accident", "motor_type"]
_SCORE = " + ".join(f"CASE WHEN {c} IS NOT NULL AND {t} THEN {w} ELSE 0 END" for c, t, w in [
    ("catr", "catr <> -1", 2), ("voie", "true", 1), ("v2", "true", 1), ("circ", "circ <> -1", 1), ("lanes", "lanes <> -1", 1), ("vosp", "vosp <> -1", 1),
    ("prof", "prof <> -1", 1), ("pr", "true", 1), ("pr1", "true", 1), ("plan", "plan <> -1", 1), ("surf", "surf <> -1", 1), ("infra", "infra <> -1", 1),
    ("situ", "situ <> -1", 1), ("vma", "vma <> -1", 2)])
_MERGE = f"""ln AS (SELECT *, row_number() OVER (ORDER BY {', '.join(_POS)}) AS pos FROM lineitem),
c0 AS ({_view(_CIRC, 'orders')}), l0 AS ({_view(_LOC, 'ln', ', pos')}), v0 AS ({_view(_VEH, 'ln', ', pos')}), u0 AS ({_view(_USR, 'ln')}),
l1 AS (SELECT *, coalesce(TRY_CAST(nbv AS DOUBLE), -1) AS lanes FROM l0),
loc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "Num_Acc" ORDER BY {_SCORE} DESC, CASE WHEN vma IS NOT NULL THEN 1 ELSE 0 END DESC,
  CASE WHEN pr IS NOT NULL OR pr1 IS NOT NULL THEN 1 ELSE 0 END DESC, coalesce(catr, 99) ASC, pos DESC) AS rk FROM l1) WHERE rk = 1),
v1 AS (SELECT "Num_Acc" AS acc, CAST(replace(id_vehicule, ' ', '') AS BIGINT) AS id_vehicle, num_veh AS number_vehicle, {_N('senc')} AS direction_of_travel,
  {CLASS_CASE.format(c=_N('catv'))} AS vehicle_category, {_N('obs')} AS fixed_obstacle_struck, {_N('obsm')} AS mobile_obstacle_struck, {_N('choc')} AS initial_point_of_impact,
  {_N('manv')} AS main_maneuver_before_accident, {_N('motor')} AS motor_type, pos FROM v0),
v2 AS (SELECT *, {WEIGHT_CASE.format(c='vehicle_category')} AS score FROM v1),
own AS (SELECT * FROM v2 QUALIFY row_number() OVER (PARTITION BY acc, id_vehicle ORDER BY pos DESC) = 1),
veh AS (SELECT o.acc, {', '.join(f'o.{m}, x.{m} AS {m}_other' for m in _MIR)} FROM own o LEFT JOIN v2 x ON o.acc = x.acc AND o.id_vehicle <> x.id_vehicle
  QUALIFY row_number() OVER (PARTITION BY o.acc, o.id_vehicle ORDER BY x.score DESC NULLS LAST, x.pos DESC) = 1),
cnt AS (SELECT acc, {', '.join(f"sum(CASE WHEN vehicle_category = '{k}' THEN 1 ELSE 0 END)::BIGINT AS vehicle_category_involved_{k}" for k in codes.SIX_CLASSES)} FROM own GROUP BY acc),
usr AS (SELECT u."Num_Acc" AS acc, replace(u.id_usager, ' ', '') AS id_user, u.*, {', '.join(
    f"CASE WHEN u.catu = 3 THEN NULL ELSE v.{m} END AS {m}, CASE WHEN u.catu = 3 THEN v.{m} ELSE v.{m}_other END AS {m}_other" if m != 'id_vehicle' else
    "CASE WHEN u.catu = 3 THEN NULL ELSE CAST(u.id_vehicule AS BIGINT) END AS id_vehicle, CASE WHEN u.catu = 3 THEN CAST(u.id_vehicule AS BIGINT) ELSE v.id_vehicle_other END AS id_vehicle_other" for m in _MIR)}
  FROM u0 u LEFT JOIN veh v ON u."Num_Acc" = v.acc AND CAST(u.id_vehicule AS BIGINT) = v.id_vehicle),
acc AS (SELECT c0.*, loc.* EXCLUDE ("Num_Acc", pos, rk) FROM c0 LEFT JOIN loc ON c0."Num_Acc" = loc."Num_Acc" WHERE loc.vma IS NULL OR loc.vma <= 130),
m AS (SELECT a.*, u.* EXCLUDE (acc, "Num_Acc"), n.* EXCLUDE (acc) FROM acc a LEFT JOIN usr u ON a."Num_Acc" = u.acc LEFT JOIN cnt n ON a."Num_Acc" = n.acc)"""

SQL["accident_merge"] = f"""WITH {_MERGE} SELECT "Num_Acc" AS id_accident, id_user, vma AS speed_limit, catr AS road_category, lanes AS number_of_traffic_lanes, catu AS user_category,
 {', '.join(f'{m}, {m}_other' for m in _MIR)}, {', '.join(f'vehicle_category_involved_{k}' for k in codes.SIX_CLASSES)} FROM m"""


def _flag(values):
    return f"CASE WHEN secu1 IN ({values}) OR secu2 IN ({values}) OR secu3 IN ({values}) THEN 1 ELSE 0 END"


_F = f"""raw AS (SELECT *, TRY_CAST(concat(an, '-', mois, '-', jour) AS DATE) AS d,
  least(coalesce(lanes, 1.0), 8.0) + CASE "int" WHEN 1 THEN 0 WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 3 WHEN 5 THEN 6 WHEN 6 THEN 7 WHEN 7 THEN 8 WHEN 8 THEN 5 WHEN 9 THEN 2 ELSE 1 END
  + CASE catr WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 1 WHEN 6 THEN 3 WHEN 7 THEN 4 ELSE 1 END
  + CASE circ WHEN 2 THEN 4 WHEN 3 THEN 2 WHEN 4 THEN 6 ELSE 1 END AS cx FROM m),
d AS (SELECT *, an - an_nais AS age, CAST(split_part(hrmn, ':', 1) AS INT) AS h, 10.0 * (cx - min(cx) OVER y) / (max(cx) OVER y - min(cx) OVER y) AS idx,
  CASE catu WHEN 1 THEN 'driver' WHEN 2 THEN 'passenger' WHEN 3 THEN 'pedestrian' ELSE 'other' END AS role,
  coalesce(vehicle_category, 'unknown') AS vs, coalesce(vehicle_category_other, 'none') AS vso, CASE grav WHEN 1 THEN 0 WHEN 4 THEN 1 WHEN 3 THEN 2 WHEN 2 THEN 2 END AS injury_target
  FROM raw WHERE d IS NOT NULL WINDOW y AS (PARTITION BY an)),
e1 AS (SELECT * REPLACE ({', '.join(f"CASE WHEN {c} IS NULL AND role = 'pedestrian' THEN -1 ELSE {c} END AS {c}" for c in ("initial_point_of_impact", "fixed_obstacle_struck", "mobile_obstacle_struck"))},
  CASE WHEN vehicle_category IS NULL AND role = 'pedestrian' THEN 'none' ELSE vehicle_category END AS vehicle_category,
  {', '.join(f"coalesce({c}, CASE WHEN role IN ('pedestrian', 'passenger') THEN -1 ELSE 0 END) AS {c}" for c in ("main_maneuver_before_accident", "motor_type"))},
  {', '.join(f"coalesce({c}, CASE WHEN id_vehicle_other IS NULL THEN -1 ELSE 0 END) AS {c}" for c in ("main_maneuver_before_accident_other", "motor_type_other", "fixed_obstacle_struck_other", "mobile_obstacle_struck_other"))},
  coalesce(initial_point_of_impact_other, CASE WHEN id_vehicle_other IS NULL THEN -1 END) AS initial_point_of_impact_other,
  coalesce(vehicle_category_other, CASE WHEN id_vehicle_other IS NULL THEN 'none' END) AS vehicle_category_other) FROM d),
e AS (SELECT * FROM e1 WHERE initial_point_of_impact IS NOT NULL AND fixed_obstacle_struck IS NOT NULL AND mobile_obstacle_struck IS NOT NULL AND vehicle_category IS NOT NULL
  AND initial_point_of_impact_other IS NOT NULL AND vehicle_category_other IS NOT NULL AND injury_target IS NOT NULL)"""


def _wave(name, angle):
    return f"round(sin({angle}), 6) AS {name}_sin, round(cos({angle}), 6) AS {name}_cos"


_W = WEIGHT_CASE
SQL["accident_table"] = f"""WITH {_MERGE}, {_F} SELECT "Num_Acc" AS id_accident, id_user, id_vehicle, id_vehicle_other, an AS year, agg AS location, col AS type_of_collision,
 CAST(replace(lat, ',', '.') AS DOUBLE) AS latitude, CAST(replace("long", ',', '.') AS DOUBLE) AS longitude, vosp AS reserved_lane_present, plan AS horizontal_alignment, infra AS infrastructure,
 situ AS accident_situation, vma AS speed_limit, place AS position, sexe AS sex, locp AS pedestrian_location, coalesce(actp, 'Unknown') AS pedestrian_action,
 fixed_obstacle_struck, mobile_obstacle_struck, initial_point_of_impact, main_maneuver_before_accident, motor_type, fixed_obstacle_struck_other, mobile_obstacle_struck_other,
 initial_point_of_impact_other, main_maneuver_before_accident_other, motor_type_other, {', '.join(f'vehicle_category_involved_{k}' for k in codes.SIX_CLASSES)},
 {_wave('hour', '2*pi()*h/24')}, CASE WHEN h < 6 OR h >= 20 THEN 'Night' WHEN h < 10 THEN 'Morning_Rush' WHEN h < 16 THEN 'Midday' ELSE 'Evening_Rush' END AS time_of_day,
 isodow(d) - 1 AS day_of_week, {_wave('day_of_week', '2*pi()*(isodow(d)-1)/7')}, {_wave('month', '2*pi()*mois/12')}, {_wave('day_of_year', '2*pi()*dayofyear(d)/365.25')},
 coalesce(age, 0) AS age, CASE WHEN age >= 0 AND age < 18 THEN 'child_teen' WHEN age >= 18 AND age < 25 THEN 'young_adult' WHEN age >= 25 AND age < 40 THEN 'adult'
  WHEN age >= 40 AND age < 65 THEN 'middle_aged' WHEN age >= 65 AND age < 100 THEN 'senior' ELSE 'Unknown' END AS age_group,
 {_flag('1')} AS used_belt, {_flag('2')} AS used_helmet, {_flag('3')} AS used_child_restraint, {_flag('5,7')} AS used_airbag,
 vs AS vehicle_category_simplified, {_W.format(c='vs')} AS impact_score, vso AS vehicle_category_simplified_other, {_W.format(c='vso')} AS impact_score_other,
 ({_W.format(c='vs')}) - ({_W.format(c='vso')}) AS impact_delta, round(idx, 6) AS road_complexity_index, CASE WHEN surf = 1 AND prof = 1 THEN 1 ELSE 0 END AS surface_quality_indicator,
 role, CASE lum WHEN 5 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 3 ELSE 0 END AS lighting_ordinal,
 CASE atm WHEN 8 THEN 1 WHEN 2 THEN 2 WHEN 7 THEN 2 WHEN 6 THEN 3 WHEN 3 THEN 3 WHEN 5 THEN 4 WHEN 4 THEN 4 ELSE 0 END AS weather_ordinal, injury_target FROM e"""

_CODED = list(codes.ORDERED_DOMAINS)
_MODEL = ("location type_of_collision reserved_lane_present horizontal_alignment infrastructure accident_situation speed_limit position sex "
          "fixed_obstacle_struck mobile_obstacle_struck initial_point_of_impact main_maneuver_before_accident motor_type "
          "fixed_obstacle_struck_other mobile_obstacle_struck_other initial_point_of_impact_other main_maneuver_before_accident_other motor_type_other "
          + " ".join(f"vehicle_category_involved_{k}" for k in codes.SIX_CLASSES) +
          " time_of_day day_of_week age_group used_belt used_helmet used_child_restraint used_airbag vehicle_category_simplified impact_score "
          "vehicle_category_simplified_other impact_score_other impact_delta road_complexity_index surface_quality_indicator role lighting_ordinal "
          "weather_ordinal injury_target").split()


def modelling_rows(spark, sf):
    """Accident rows to model rows: columns left out, -1 unknown, complete, fixed domains."""
    f = accidents.selected(_stages(spark, sf)["E_imputed"], keep=_KEEP)
    out = modelling.prepared(f, keep=_KEEP)
    return out.withColumn("road_complexity_index", F.round("road_complexity_index", 6))


def _position(name, domain):
    return f"CASE {name} " + " ".join(f"WHEN {v!r} THEN {i}" for i, v in enumerate(domain)) + " END"


_FILLED = [f"coalesce(CAST({c} AS VARCHAR), '-1') AS {c}" if c.startswith("vehicle_category_s") else f"coalesce({c}, -1) AS {c}"
           if c in codes.MINUS_ONE_HAS_MEANING else c for c in _MODEL]
_WHOLE = " AND ".join(f"CAST({c} AS VARCHAR) NOT IN ('-1', '-1.0')" for c in _MODEL if c not in codes.MINUS_ONE_HAS_MEANING)
SQL["modelling_rows"] = f"""SELECT * FROM (SELECT {', '.join(_KEEP)}, {', '.join(_FILLED)}, {', '.join(f'{_position(c, codes.ORDERED_DOMAINS[c])} AS {c}_code' for c in _CODED)}
 FROM ({SQL['accident_table']}) t WHERE {_WHOLE}) WHERE {' AND '.join(f'{c}_code IS NOT NULL' for c in _CODED)}"""


def derived_report(spark, sf):
    """Model features of a report, by the definitions used in training."""
    k = F.col("o_custkey")
    reports = table(spark, sf, "orders").select("o_orderkey", (k % 24).alias("hour"), (k % 7).alias("day_of_week"), F.when(k % 9 > 0, k % 110).alias("age"))
    out = scoring.derive(reports)
    return out.select("o_orderkey", "time_of_day", "age_group", *[F.round(c, 6).alias(c) for c in ("hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos")])


SQL["derived_report"] = f"""WITH r AS (SELECT o_orderkey, o_custkey % 24 AS h, o_custkey % 7 AS w, CASE WHEN o_custkey % 9 > 0 THEN o_custkey % 110 END AS age FROM orders)
SELECT o_orderkey, CASE WHEN h < 6 OR h >= 20 THEN 'Night' WHEN h < 10 THEN 'Morning_Rush' WHEN h < 16 THEN 'Midday' ELSE 'Evening_Rush' END AS time_of_day,
 CASE WHEN age >= 0 AND age < 18 THEN 'child_teen' WHEN age >= 18 AND age < 25 THEN 'young_adult' WHEN age >= 25 AND age < 40 THEN 'adult'
  WHEN age >= 40 AND age < 65 THEN 'middle_aged' WHEN age >= 65 AND age < 100 THEN 'senior' ELSE 'Unknown' END AS age_group,
 {_wave('hour', '2*pi()*h/24')}, {_wave('day_of_week', '2*pi()*w/7')} FROM r"""

# ---- register codes as text, by the codebooks ---------------------------------------------
_BOOKED = {"locations": {"road_category": _LOC["catr"], "traffic_regime": _LOC["circ"], "reserved_lane_present": _LOC["vosp"],
                         "longitudinal_profile": _LOC["prof"], "horizontal_alignment": _LOC["plan"]},
           "users": {"injury_severity": _USR["grav"], "user_category": _USR["catu"], "sex": _USR["sexe"]}}


def codebook_labels(spark, sf):
    """How often each label of the codebooks stands in the raw tables; a code of no label is NULL."""
    raw = accidents.renamed(raw_tables(spark, sf))
    out = []
    for name, columns in _BOOKED.items():
        typed = raw_source.typed(raw[name].select(*columns))
        labels = clean.decode(typed, {c: codes.CODEBOOKS[c] for c in columns}, "")
        out.append(profile.value_table(labels, list(columns)).withColumnRenamed("value", "label"))
    return out[0].unionByName(out[1])


def _label(column, code):
    return f"CASE {code} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in codes.CODEBOOKS[column].items()) + " END"


SQL["codebook_labels"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {_label(c, e)} AS label, count(*) AS n FROM lineitem GROUP BY ALL""" for columns in _BOOKED.values() for c, e in columns.items())


# ---- clusters: two rounds of two starts a year, written out -------------------------------
_CNUM = ["speed_limit", "impact_score", "impact_delta", "lighting_ordinal", "weather_ordinal"]
_CCAT = ["role", "time_of_day", "location", "vehicle_category_simplified_other", "surface_quality_indicator"]
_GAMMA = 2.0


def accident_clusters(spark, sf):
    """The cluster column of the accident table, fitted per year."""
    f = accidents.selected(_stages(spark, sf)["E_imputed"], keep=_KEEP).select("id_user", "year", *_CNUM, *_CCAT)
    out = accidents.clustered(f, k=3, restarts=2, max_rounds=2, numeric=_CNUM, categorical=_CCAT, gamma=_GAMMA, keys=["id_user"])
    return out.select("id_user", "year", "cluster")


def _cluster_round(i):
    """Labels and costs by the prototypes of round i, then their means and modes."""
    far = " + ".join([f"coalesce(pow(t.{c}::DOUBLE - p.{c}, 2), 0)" for c in _CNUM]
                     + [f"CASE WHEN t.{c} IS NOT DISTINCT FROM p.{c} THEN 0.0::DOUBLE ELSE {_GAMMA}::DOUBLE END" for c in _CCAT])
    mode = ", ".join(f"""(SELECT v FROM (SELECT l.{c} AS v, count(*) AS n FROM l{i} l WHERE l.year = g.year AND l.start = g.start AND l.cluster = g.cluster GROUP BY 1)
      ORDER BY n DESC, CAST(v AS VARCHAR) LIMIT 1) AS {c}""" for c in _CCAT)
    return f"""l{i} AS MATERIALIZED (SELECT t.*, p.start, p.cluster, {far} AS far FROM t JOIN p{i} p USING (year)
   QUALIFY row_number() OVER (PARTITION BY t.rid, p.start ORDER BY far, p.cluster) = 1),
 g{i} AS MATERIALIZED (SELECT year, start, cluster, {', '.join(f'coalesce(avg({c}::DOUBLE), 0) AS {c}' for c in _CNUM)} FROM l{i} GROUP BY ALL),
 p{i + 1} AS MATERIALIZED (SELECT year, start, cluster, {', '.join(_CNUM)}, {mode} FROM g{i} g UNION ALL
   SELECT year, start, cluster, {', '.join(_CNUM + _CCAT)} FROM p{i} o WHERE NOT EXISTS (FROM g{i} g WHERE g.year = o.year AND g.start = o.start AND g.cluster = o.cluster))"""


SQL["accident_clusters"] = f"""WITH t AS MATERIALIZED (SELECT row_number() OVER () AS rid, id_user, year, {', '.join(_CNUM + _CCAT)} FROM ({SQL['accident_table']}) f),
 p0 AS MATERIALIZED (SELECT year, s AS start, CAST(row_number() OVER (PARTITION BY year, s ORDER BY md5(concat_ws('|', 42 + s, id_user))) - 1 AS INT) AS cluster,
   {', '.join(f'coalesce({c}, 0)::DOUBLE AS {c}' for c in _CNUM)}, {', '.join(_CCAT)} FROM t, (VALUES (0), (1)) v(s) QUALIFY cluster < 3),
 {_cluster_round(0)}, {_cluster_round(1)},
 best AS (SELECT year, start FROM (SELECT year, start, sum(far) AS cost FROM l1 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY year ORDER BY cost, start) = 1),
 last AS (SELECT t.id_user, t.year, p.cluster FROM t JOIN best USING (year) JOIN p2 p ON p.year = t.year AND p.start = best.start
   QUALIFY row_number() OVER (PARTITION BY t.rid ORDER BY {" + ".join([f"coalesce(pow(t.{c}::DOUBLE - p.{c}, 2), 0)" for c in _CNUM]
   + [f"CASE WHEN t.{c} IS NOT DISTINCT FROM p.{c} THEN 0.0::DOUBLE ELSE {_GAMMA}::DOUBLE END" for c in _CCAT])}, p.cluster) = 1)
 SELECT id_user, year, cluster::SMALLINT AS cluster FROM last"""

QUERIES |= {"codebook_labels": codebook_labels, "accident_clusters": accident_clusters, "accident_merge": accident_merge, "accident_table": accident_table, "modelling_rows": modelling_rows, "derived_report": derived_report}
