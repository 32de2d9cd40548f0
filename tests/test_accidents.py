"""The golden fixture through every stage of the accident table."""

import pytest

from kerbside.plans import accidents
from kerbside.sources import raw
from pyspark.sql import functions as F
from tests import golden


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    golden.write(folder)
    golden.write_old_users(folder)
    out = accidents.build(raw.read_raw(spark, folder))
    return {k: (v.cache() if k[0] in "CDEF" else v) for k, v in out.items()} | {"folder": folder}


def one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_opponents(stages):
    d = stages["D_features"]
    car, truck = one(d, id_user="101"), one(d, id_user="102")
    assert (car["vehicle_category_simplified"], car["vehicle_category_simplified_other"],
            car["impact_delta"]) == ("light_motor_vehicle", "hgv_truck", -2)
    assert truck["impact_delta"] == 2
    assert car["vehicle_category_involved_light_motor_vehicle"] == 1
    assert car["vehicle_category_involved_hgv_truck"] == 1
    assert car["vehicle_category_involved_bicycle"] == 0
    assert car["day_of_week"] == 0
    c = stages["C_merged"]
    assert [one(c, id_user=u)["id_vehicle_other"] for u in ("401", "402", "403")] == [43, 43, 42]


def test_lone_vehicle(stages):
    c = one(stages["C_merged"], id_user="201")
    assert all(c[k] is None for k in c.asDict() if k.endswith("_other") and "involved" not in k)
    d = one(stages["D_features"], id_user="201")
    assert (d["vehicle_category_simplified_other"], d["impact_score_other"], d["impact_delta"]) == ("none", 1, 1)
    e = one(stages["E_imputed"], id_user="201")
    assert e["motor_type_other"] == -1 and e["initial_point_of_impact_other"] == -1


def test_pedestrian(stages):
    c = one(stages["C_merged"], id_user="302")
    assert c["id_vehicle"] is None and c["vehicle_category_other"] == "light_motor_vehicle"
    d = one(stages["D_features"], id_user="302")
    assert (d["vehicle_category_simplified"], d["impact_delta"]) == ("unknown", -3)
    e = one(stages["E_imputed"], id_user="302")
    assert (e["vehicle_category"], e["fixed_obstacle_struck"]) == ("none", -1)
    assert e["injury_target"] == 2


def test_locations(stages):
    c = stages["C_merged"]
    assert one(c, id_user="501")["speed_limit"] == 80
    assert one(c, id_user="601")["road_category"] == 2
    assert c.filter("id_accident = 7").count() == 0
    assert one(
        stages["E_imputed"], id_user="801")["speed_limit"] is None
    assert one(c, id_user="19001")["road_category"] is None


def test_dates_targets_ages(stages):
    d, e = stages["D_features"], stages["E_imputed"]
    assert d.filter("id_accident = 9").count() == 0
    assert one(d, id_user="10001")["injury_target"] is None
    assert e.filter("id_accident = 10").count() == 0
    old, unknown = one(e, id_user="11001"), one(e, id_user="11002")
    assert (old["age"], old["age_group"]) == (100, "Unknown")
    assert (unknown["age"], unknown["age_group"]) == (0, "Unknown")


def test_time_buckets(stages):
    got = [one(stages["D_features"], id_accident=120 + i)["time_of_day"] for i in range(8)]
    assert got == ["Night", "Morning_Rush", "Morning_Rush", "Midday", "Midday", "Evening_Rush",
                   "Evening_Rush", "Night"]


def test_flags_and_complexity(stages):
    d = stages["D_features"]
    r = one(d, id_user="13001")
    assert (r["used_airbag"], r["used_gloves"], r["used_belt"]) == (1, 1, 0)
    low, high = 3, 26      # accident 19 has no location: 1 + 0 + 1 + 1
    assert one(d, id_user="19001")["road_complexity_index"] == pytest.approx(0)
    assert one(d, id_user="14001")["road_complexity_index"] == pytest.approx(10 * (8 - low) / (high - low))
    assert one(d, id_user="15001")["road_complexity_index"] == pytest.approx(10)
    assert one(d, id_user="101")["road_complexity_index"] == pytest.approx(10 * (10 - low) / (high - low))


def test_ids(stages):
    c = stages["C_merged"]
    r = one(c, id_user="16001")
    assert r["id_vehicle"] == 138306524 and r["vehicle_category"] == "light_motor_vehicle"
    r = one(c, id_accident=17)
    assert r["id_vehicle"] is None and r["vehicle_category"] == "light_motor_vehicle"
    d = one(stages["D_features"], id_user="18001")
    assert (d["vehicle_category_simplified"], d["impact_score"]) == ("unknown", 1)
    assert stages["E_imputed"].filter("id_accident = 18").count() == 0
    assert one(c, id_accident=20)["id_user"] is None
    assert stages["E_imputed"].filter("id_accident = 20").count() == 0
    got = sorted(r["id_user"] for r in c.filter("id_accident = 900").collect())
    assert got == ["900_U1", "900_U2"]
    women = one(c.filter("id_accident = 900"), sex=2)
    assert women["id_user"] == "900_U2"


def test_final_columns(stages):
    f = stages["F_selected"]
    kinds = dict(f.dtypes)
    assert "id_accident" not in kinds and "direction_of_travel_other" not in kinds
    assert kinds["speed_limit"] == "smallint" and kinds["injury_target"] == "smallint"
    # 55 features (56 with cluster), target and the partition column
    assert len(f.columns) == 57
    e, f_count = stages["E_imputed"], f.count()
    assert e.count() == f_count


def test_cluster(stages):
    out = accidents.clustered(stages["F_selected"], k=3, restarts=1, max_rounds=2)
    assert out.count() == stages["F_selected"].count()
    assert dict(out.dtypes)["cluster"] == "smallint"


def test_missing_accident_key(spark):
    with pytest.raises(ValueError):
        accidents.with_user_ids(spark.createDataFrame([(1,)], "x int"))


def test_years(spark, stages):
    assert raw.years_in(spark, stages["folder"]) == [2019, 2023]
