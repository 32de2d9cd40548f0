"""Images of doubles, and selection and running sums on hot and narrow ranges."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import evaluate, ordered, profile


def bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_image(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), -float("inf"),
              1.0, np.nextafter(1, 2), np.nextafter(1, 0), 0.1, 2.0 ** 1023, 2.0 ** -1074 * 3, *[2.0 ** k for k in range(-1074, 1024, 37)]]
    values += [struct.unpack("<d", struct.pack("<q", rng.getrandbits(63)))[0] * rng.choice([1, -1]) for _ in range(3000)]
    values = [float(v) for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert all(r.i == bits(r.v) for r in df.select("v", ordered.image(F.col("v")).alias("i")).collect())
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(ordered.image(F.col("v"))).first()[0]
    assert nan == 2 ** 63 - 1


def narrow(n=4000):
    """Most values within a few thousand steps of one, some hot, some far."""
    rng = random.Random(2)
    step = 2.0 ** -48
    return [rng.choice([1 + rng.randrange(3000) * step, 1.5, -7.0, rng.lognormvariate(0, 3)]) for _ in range(n)]


@pytest.mark.parametrize("width", [12, 5])
def test_buckets_are_small_and_in_order(spark, width):
    values = narrow()
    df = spark.createDataFrame([("a" if i % 3 else None, v) for i, v in enumerate(values)], "g string, v double")
    out = ordered.with_value_bucket(df, ["g"], "v", bits=width, rows=100).collect()
    assert len(out) == len(values)
    for g in ("a", None):
        own = sorted((r.v, r._bucket) for r in out if r.g == g)
        assert all(a[1] <= b[1] for a, b in zip(own, own[1:]))
        held = {}
        for v, b in own:
            held.setdefault(b, []).append(v)
        assert max(len(vs) for vs in held.values() if len(set(vs)) > 1) <= 100


def test_quantiles_in_a_narrow_range(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 50)
    values = narrow()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0, 0.01, 0.3, 0.5, 0.77, 1]
    got = {r["prob"]: r["quantile"] for r in profile.exact_quantiles(df, ["x"], probs).collect()}
    assert all(got[p] == pytest.approx(np.quantile(values, p), rel=1e-15) for p in probs)


def test_pr_points_in_a_narrow_range(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 50)
    values = narrow()
    hits = [random.Random(i).random() < 0.3 for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, hits)), "s double, y boolean")
    points = {r["score"]: (r["tp"], r["predicted"]) for r in evaluate.pr_points(df, {"c": F.col("y")}, {"c": F.col("s")}).collect()}
    assert len(points) == len(set(values))
    for s, found in random.Random(3).sample(sorted(points.items()), 200):
        assert found == (sum(h for v, h in zip(values, hits) if v >= s), sum(v >= s for v in values))


def test_profile_reads_rows_twice(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("profile", "profile")
    rows = {r["column"]: r for r in profile.column_profile(df).collect()}
    spark.sparkContext.setJobGroup("", "")
    assert tracker.getJobIdsForGroup("profile")
    x = np.array([r[0] for r in df.select(F.col("l_quantity").cast("double")).collect()])
    assert rows["l_quantity"]["q25"] == pytest.approx(np.quantile(x, 0.25)) and rows["l_returnflag"]["mean"] is None
