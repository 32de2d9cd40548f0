"""Placement of the accident star: how often rows are exchanged, and hot accidents."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.catalogue import accident, joining
from kerbside.operators import joins
from kerbside.plans import accidents

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plain_plans(spark):
    """Plans as first made: no adaptive stages, no broadcasts."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def plan_counts(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return Counter({"hash": text.count("Exchange hashpartitioning"), "reused": text.count("ReusedExchange"),
                    "scans": text.count("FileScan parquet")})


def test_accident_table_exchanges(spark, plain_plans):
    df = accident.accident_table(spark, SF)
    n = plan_counts(df)
    assert n["hash"] <= 6 and n["scans"] <= 4      # vehicles once, users, and the accident rows read back by the join and the range


def test_antagonist_exchanges(spark, plain_plans):
    df = joining.antagonist(spark, SF)
    n = plan_counts(df)
    assert n["hash"] <= 4 and n["scans"] <= 2      # by (group, slot) for either use, and by group for either side


def test_hot_group_is_spread_and_right(spark):
    """One accident holds most vehicles; its best two are found without gathering it."""
    rng = random.Random(6)
    rows = [(1 if i % 5 else i, i // 2, rng.choice([None, 1, 2, 3]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g long, m long, s int, p int").repartition(6)
    placed = joins.placed(df, "g", "m")
    assert placed.where("g = 1").select("_slot").distinct().count() > 900
    last, groups = {}, {}
    for g, m, s, p in rows:
        if (g, m) not in last or last[g, m][1] < p:
            last[g, m] = (s, p)
        groups.setdefault(g, []).append((s is not None, s or 0, p, m))      # any row of another member may be the best
    out = joins.with_opponent(df, "g", "m", "s", F.col("p"), ["m", "s"]).collect()
    assert len(out) == len(last)
    for r in out:
        other = max((x for x in groups[r.g] if x[3] != r.m), default=None)
        assert (r.m_other, r.s_other) == ((other[3], other[1] if other[0] else None) if other else (None, None))
        assert (r.s, r.p) == last[r.g, r.m]


def test_summary_counts(spark):
    df = spark.createDataFrame([(1, m, "ab"[m % 2], m) for m in range(7)] + [(2, None, "b", 1)], "g long, m long, c string, p int")
    ranked = joins.ranked_members(joins.placed(df.withColumn("s", F.lit(1)), "g", "m"), "g", "m", "s", F.col("p"))
    out = joins.group_summary(ranked, "g", "m", "s", F.col("p"), ["c"],
                              {k: F.when(F.col("c") == k, 1).otherwise(0) for k in "ab"})
    got = {r.g: (r.a, r.b, [t and t["_id"] for t in r._top]) for r in out.collect()}
    assert got == {1: (4, 3, [6, 5]), 2: (0, 1, [None, None])}


def test_vehicles_are_exchanged_once_by_adaptive_plans(spark):
    """Both uses of the vehicles, the join of the users' own and the two heaviest, read one exchange."""
    read = spark.sparkContext.accumulator(0)
    raw = accident.raw_tables(spark, SF)
    rows = raw["vehicles"].collect()

    def ticked(row):
        read.add(1)
        return row

    raw["vehicles"] = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).map(ticked), raw["vehicles"].schema)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert accidents.build(raw, bucket=F.lit(0))["C_merged"].collect()
        assert read.value == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_few_exchanges_of_accidents_that_are_not_hot(spark, plain_plans):
    """Vehicles and users are placed by accident alone: their joins and the summary of the vehicles go on from there."""
    df = accident.accident_merge(spark, SF)
    n = plan_counts(df)
    assert n["hash"] - n["reused"] <= 4 and n["scans"] <= 4


def test_accidents_are_written_once_for_clusters(spark, monkeypatch):
    """The fit and the result read the same written rows, not the whole plan twice."""
    names, real = [], accidents.written
    monkeypatch.setattr(accidents, "written", lambda df, name: names.append(name) or real(df, name))
    out = accident.accident_clusters(spark, SF)
    assert names == ["accidents", "selected"] and "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def star_rows(spark):
    """One accident holds most users and vehicles; vehicles without id, codes that fit no byte, accidents without users."""
    rng = random.Random(8)
    n = 600
    acc = [str(rng.choice([1, rng.randrange(2, 60)])) for _ in range(n)]
    vid = [rng.choice([None, *[f"7 {k}" for k in range(40)]]) for _ in range(n)]
    code = [[rng.choice([None, "-1", "1", "2", "7", "33", "127", "128", "-129", "70000"]) for _ in range(8)] for _ in range(n)]
    pos = "struct<p: int>"
    veh = spark.createDataFrame([(a, v, "A1", *c, (i,)) for i, (a, v, c) in enumerate(zip(acc, vid, code))],
                                "Num_Acc string, id_vehicule string, num_veh string, senc string, catv string, obs string, obsm string, choc string, "
                                f"manv string, motor string, occutc string, _src_pos {pos}")
    usr = spark.createDataFrame([(a, f"u{i}", v, "A1", str(i % 4), (i,)) for i, (a, v) in enumerate(zip(acc, reversed(vid)))] + [(None, "x", None, "A1", "1", (n,))],
                                f"Num_Acc string, id_usager string, id_vehicule string, num_veh string, catu string, _src_pos {pos}")
    circ = spark.createDataFrame([(str(a), "1", "1", "2020", (a,)) for a in range(1, 70)], f"Num_Acc string, jour string, mois string, an string, _src_pos {pos}")
    names = ["catr", "voie", "v1", "v2", "circ", "nbv", "vosp", "prof", "pr", "pr1", "plan", "lartpc", "larrout", "surf", "infra", "situ", "vma"]
    loc = spark.createDataFrame([(str(a), *[rng.choice([None, "1", "3", "300"]) for _ in names[:-1]], rng.choice([None, "50"]), (a,)) for a in [*range(1, 60)] * 3],
                                ", ".join(f"{c} string" for c in ["Num_Acc", *names]) + f", _src_pos {pos}")
    return {"circumstances": circ, "locations": loc, "vehicles": veh, "users": usr}


def test_hot_accidents_apart_give_the_same_rows(spark, monkeypatch):
    raw = star_rows(spark)
    b = accidents.renamed(raw)
    plain = accidents.merged(b)
    want = sorted(map(repr, plain.collect()))
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    hot, _ = joins.hot_groups(raw["users"].select(F.col("Num_Acc").cast("long").alias("g")), "g")
    assert hot == [1]
    apart = accidents.merged(b)
    assert apart._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
    assert sorted(map(repr, apart.collect())) == want and len(want) > 600
    values = {r[0] for r in plain.select("fixed_obstacle_struck").collect()}
    assert {127, 128, -129, 70000} <= values and {r[0] for r in plain.select("road_category").collect()} >= {300}
