"""The accident table: raw yearly relations to one modelling row per person.

Stages are lazy DataFrames over all years at once.  ``year`` stays as partition column
until modelling.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.clustering import grouped
from kerbside.clustering.grouped import GroupedKPrototypes
from kerbside.functions import codes
from kerbside.functions import columns as fc
from kerbside.operators import clean, features, impute, joins, ordered
from kerbside.sources import raw as raw_source
from kerbside.sources import schemas
from kerbside.session import durable, plan_settings, spread, written

KEYS = ["id_accident", "id_vehicle"]
USERS = ["users", "users_without_id"]
SAFETY = ["safety_equipment_1", "safety_equipment_2", "safety_equipment_3"]


def renamed(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage B: names of this package, text values as read."""
    return {t: clean.rename(df, schemas.RENAMES["users" if t.startswith("users") else t])
            for t, df in raw.items()}


def with_user_ids(users: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Give users of files without a user id the key ``<accident>_U<n>``."""
    if "id_accident" not in users.columns:
        raise ValueError("users have no accident key")
    if "id_user" in users.columns:
        return users
    bucket = F.struct("_src_pos.file", "_src_pos.block") if bucket is None else bucket
    return ordered.synthetic_key(users, "id_accident", [F.col("_src_pos")], bucket)


def keyed(df: DataFrame) -> DataFrame:
    """Rows with typed keys."""
    return df.withColumns({k: fc.blank_free_long(k) for k in KEYS})


def vehicle_rows(vehicles: DataFrame, place: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Placed rows, unknowns as NULL, the class instead of the code, and its weight; of an (accident,
    vehicle) the last row of the file and the heaviest one."""
    read = raw_source.typed(keyed(vehicles.select("id_accident", *codes.MIRRORED, "_src_pos")), KEYS)
    rows = place(clean.packed(read, list(clean.integers(read))))
    # what the joins of both uses ask for: with the same filters below it, both read one and the same exchange
    rows = rows.filter(F.col("id_accident").isNotNull() & F.col("_slot").isNotNull())
    v = clean.sentinels_to_null(clean.unpacked(rows, clean.integers(read)), codes.VEHICLE_SENTINELS)
    v = v.withColumn("vehicle_category", fc.vehicle_class("vehicle_category"))
    v = v.withColumn("_impact", fc.class_weight("vehicle_category"))
    # texts take part in the order, so that neither use leaves them out of that exchange
    whole = F.struct("_src_pos", *[c for c in codes.MIRRORED if c in schemas.TEXTS])
    return joins.ranked_members(v, *KEYS, "_impact", whole)


def vehicles_of_accidents(ranked: DataFrame) -> DataFrame:
    """Per accident: its two heaviest vehicles and how many there are of each class."""
    counts = {f"vehicle_category_involved_{c}": F.when(F.col("vehicle_category") == c, 1).otherwise(0)
              for c in codes.SIX_CLASSES}
    return joins.group_summary(ranked, *KEYS, "_impact", F.col("_src_pos"), codes.MIRRORED, counts)


def by_accident(df: DataFrame) -> DataFrame:
    """Rows with a typed accident key; a table of few splits is dealt out by it before the work per row."""
    return spread(df.withColumn("id_accident", fc.blank_free_long("id_accident")), "id_accident")


def best_locations(locations: DataFrame) -> DataFrame:
    """The most telling location row of each accident."""
    loc = raw_source.typed(by_accident(locations), ["id_accident"]).drop("file_year")
    has_marker = (F.col("nearest_reference_marker").isNotNull()
                  | F.col("nearest_reference_marker_distance").isNotNull())
    order = {"_score": fc.filled_weight(codes.LOCATION_SCORE), "_speed": F.col("speed_limit").isNotNull(), "_marker": has_marker,
             "_road": F.coalesce(F.col("road_category").cast("double"), F.lit(99.0))}
    small = clean.packed(loc.withColumns(order), list(clean.integers(loc)))
    best = joins.best_location(small, ["id_accident"], *[F.col(c) for c in order], F.col("_src_pos"))
    return clean.unpacked(best.drop("_src_pos", *order), clean.integers(loc))


def accident_rows(b: dict[str, DataFrame]) -> DataFrame:
    """Circumstances with their best location, impossible speed limits removed.

    The speed filter needs the joined location: filtering locations first would keep the
    accident with an unknown limit.
    """
    c = raw_source.typed(by_accident(b["circumstances"].drop("_src_pos", "file_year")), ["id_accident"])
    joined = joins.star(c, [best_locations(b["locations"])], "id_accident")
    return clean.keep_up_to(joined, "speed_limit", codes.SPEED_LIMIT_MAX)


def user_rows(b: dict[str, DataFrame], ranked: DataFrame, place: Callable[[DataFrame], DataFrame],
              bucket: Column | None = None) -> DataFrame:
    """Users with their own vehicle; ``_own`` is NULL for a user without one."""
    parts = [with_user_ids(b[t], bucket) for t in USERS if t in b]
    u = raw_source.typed(joins.append(*parts).drop("number_vehicle", "_src_pos", "file_year"), KEYS)
    u = place(keyed(u.withColumn("id_user", fc.strip_blanks("id_user"))))
    vehicles = ranked.filter("_last").drop("_impact", "_src_pos", "_last", "_best").withColumn("_own", F.lit(True))
    return joins.left_null_safe(u, vehicles, ["id_accident", "_slot", "id_vehicle"], ["id_vehicle"]).drop("_slot")


def merged(b: dict[str, DataFrame], accidents: DataFrame | None = None,
           bucket: Column | None = None) -> DataFrame:
    """Stage C: accident, location, class counts, user, own and other vehicle.

    Vehicles and users are exchanged once each, by accident. Accidents of very many users come apart:
    their vehicles and users are exchanged by shares of the vehicles, and once more where they are joined.
    A pedestrian's vehicle is the other one.
    """
    accidents = accident_rows(b) if accidents is None else accidents
    ids = joins.append(*[b[t].select("id_accident") for t in USERS if t in b])
    hot, tasks = joins.hot_groups(ids.select(fc.blank_free_long("id_accident").alias("id_accident")), "id_accident")
    among = F.coalesce(F.col("id_accident").isin(hot), F.lit(False)) if hot else F.lit(False)

    def joined_rows(accidents: DataFrame, few: Column | None, whole: bool) -> DataFrame:
        def place(df: DataFrame) -> DataFrame:
            return joins.placed(df if few is None else df.filter(few), *KEYS, whole, tasks)
        ranked = vehicle_rows(b["vehicles"], place)
        return joins.star(accidents if few is None else accidents.filter(few),
                          [vehicles_of_accidents(ranked), user_rows(b, ranked, place, bucket)], "id_accident")

    joined = (joined_rows(accidents, ~among, True).unionByName(joined_rows(accidents, among, False)) if hot
              else joined_rows(accidents, None, True))
    other = F.when(F.col("_own"), joins.opponent("id_vehicle"))
    paired = joined.withColumn("_other", other).withColumns(
        {f"{c}_other": F.col(f"_other.{c}") for c in codes.MIRRORED}).drop("_own", "_top", "_other")
    return joins.swap_roles(paired, F.col("user_category") == 3, codes.MIRRORED)


def _complexity() -> Column:
    return fc.road_complexity_raw("number_of_traffic_lanes", "intersection", "road_category",
                                  "traffic_regime")


def engineered(c: DataFrame, accidents: DataFrame, by: str | None = "year") -> DataFrame:
    """Stage D: dates checked, features added.

    Road complexity is scaled per year (or over all rows with ``by=None``).  Its range
    depends on accident columns only and is taken from the accident rows, before users
    are joined.
    """
    dated = clean.keep_valid_dates(c, "year", "month", "day", into="_date")
    out = features.add_calendar(features.add_time(dated), "_date").drop("_date")
    out = features.add_age(out)
    out = features.add_safety_flags(out, SAFETY)
    out = features.add_vehicle_scores(out)
    span = features.range_per_group(clean.keep_valid_dates(accidents, "year", "month", "day"),
                                    _complexity(), by)
    out = features.min_max_scaled(out.withColumn("road_complexity_index", _complexity()),
                                  "road_complexity_index", by, ranges=span)
    out = features.add_surface(out)
    out = features.add_role(out)
    out = features.add_ordinals(out)
    return features.add_target(out)


def selected(e: DataFrame, keep: list[str] = ("year",)) -> DataFrame:
    """Stage F without cluster: modelling columns (and ``keep``), 16-bit codes."""
    drops = [c for c in codes.NOT_FOR_MODEL if c not in keep]
    return clean.to_smallint(clean.drop_present(e, drops), codes.SMALLINT_COLUMNS)


def clustered(f: DataFrame, k: int = 3, restarts: int = 5, by: str | None = "year", seed: int = 42,
              max_rounds: int | None = None, numeric: list[str] | None = None, categorical: list[str] | None = None,
              gamma: float | None = None, keys: list[str] | None = None) -> DataFrame:
    """Add ``cluster`` by k-prototypes, fitted per year by default, all years in the same rounds.

    The rows are written first, as the fit and the result both read them.
    """
    f = written(f, "selected")
    numbers = numeric or [c for c in codes.CLUSTER_NUMERIC + codes.CLUSTER_ORDINAL if c in f.columns]
    other = categorical or [c for c in f.columns if c not in numbers and c not in ("injury_target", by)]
    model = GroupedKPrototypes(k=k, numeric=numbers, categorical=other, by=by, gamma=gamma, restarts=restarts,
                               seed=seed, max_rounds=max_rounds, keys=keys)
    return clean.to_smallint(grouped.assign(f, model.fit(f), by), ["cluster"])


def build(raw: dict[str, DataFrame], scale_by: str | None = "year",
          bucket: Column | None = None, once: bool = False) -> dict[str, DataFrame]:
    """All stages up to the selected columns, by name.

    ``once`` keeps each stage in the shared folder as it is made: right before writing all
    of them, as later stages and writers then read it instead of computing it again.
    """
    made = durable if once else lambda df: df
    b = renamed(raw)
    plan_settings(next(iter(b.values())).sparkSession)
    accidents = written(accident_rows(b), "accidents")      # read twice: by the join and for the complexity range
    c = made(merged(b, accidents, bucket))
    d = made(engineered(c, accidents, scale_by))
    e = made(impute.impute_all(d))
    return {**{f"B_{n}": df for n, df in b.items()}, "C_merged": c, "D_features": d,
            "E_imputed": e, "F_selected": selected(e)}
