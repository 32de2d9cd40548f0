"""Joins of the accident star and their parts, by column name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.operators.ordered import best_row, first_per_key
from kerbside.session import pin_small

SLOTS = 4096        # shares of a group that may lie in different tasks
HOT_ROWS = 1 << 17  # rows from which on a group is dealt out in shares
TASK_ROWS = 1 << 18  # rows wanted in a task
MOST_TASKS = 200    # up to so many, writers of an exchange hold no rows and spill nothing
BINS = 1 << 16      # what groups are counted by at first


def star(fact: DataFrame, dimensions: list[DataFrame], key: str | list[str]) -> DataFrame:
    """Left joins on one key.

    All joins share the key, so the fact side is exchanged once and keeps its
    partitioning through the whole chain; a hot key is split by adaptive execution.
    """
    out = fact
    for dim in dimensions:
        out = out.join(dim, key, "left")
    return out


def best_location(df: DataFrame, key: list[str], score: Column, has_speed: Column,
                  has_marker: Column, road_rank: Column, last: Column) -> DataFrame:
    """Most complete row per key, then with speed, with marker, of the more major road;
    the last row of the file among equals."""
    return best_row(df, key, score, [has_speed.desc(), has_marker.desc(), road_rank.asc(),
                                     last.desc()])


def slot(member: str) -> Column:
    """Which of SLOTS shares of its group a row belongs to; all rows of a member share one."""
    return F.pmod(F.xxhash64(member), F.lit(SLOTS)).cast("int")


def placed(df: DataFrame, group: str, member: str, whole: bool = False, tasks: int | None = None) -> DataFrame:
    """``df`` exchanged once by (group, ``_slot``).

    Windows and joins on (group, ``_slot``, member) then need no exchange of their own, and a
    hot group is spread over SLOTS tasks by its members. Joins make use of it with
    ``session.plan_settings``; without, Spark exchanges again. ``whole`` groups have one slot
    each, so that what is made per group and joined by it needs no exchange either.
    """
    keys = [group] if whole else [group, "_slot"]
    return df.withColumn("_slot", F.lit(0) if whole else slot(member)).repartition(*[tasks] * (tasks is not None), *keys)


def hot_groups(df: DataFrame, group: str, most: int | None = None) -> tuple[list, int | None]:
    """Groups of more than ``most`` rows (HOT_ROWS, or a thousandth of all rows if that is more), and
    how many tasks the rows are worth if that is more than the session's own number.

    Rows are counted by BINS bins first, and by group only in bins that hold so many.
    """
    keys = df.select(group).filter(F.col(group).isNotNull())
    place = F.pmod(F.xxhash64(group), F.lit(BINS)).cast("int")
    counted = keys.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    sums = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("most"), F.collect_list(F.struct("n", "bin")).alias("bins")).first()
    rows = sums["rows"] or 0
    most = max(HOT_ROWS, rows // 1000) if most is None else most
    bins = [b["bin"] for b in sums["bins"] if b["n"] > most]       # of the BINS
    hot = keys.filter(place.isin(bins)).groupBy(group).count().filter(F.col("count") > most).collect() if bins else []
    wanted = min(-(-rows // TASK_ROWS), MOST_TASKS)
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [r[group] for r in hot], wanted if wanted > own else None


def ranked_members(rows: DataFrame, group: str, member: str, score: str, position: Column) -> DataFrame:
    """Placed rows of which a member may have several: those that are its last (``_last``) or its best (``_best``)."""
    key = W.partitionBy(group, "_slot", member)
    last = F.row_number().over(key.orderBy(position.desc())) == 1
    best = F.row_number().over(key.orderBy(F.col(score).desc_nulls_last(), position.desc())) == 1
    return rows.withColumns({"_last": last, "_best": best}).filter("_last OR _best")


def group_summary(ranked: DataFrame, group: str, member: str, score: str, position: Column, mirrored: list[str],
                  counts: dict[str, Column] | None = None) -> DataFrame:
    """Per group: ``_top``, the best rows of its two best members (the last position among equals), and
    sums over the last rows of its members.

    Each slot of a group sends two rows at most, with its sums on the first, so a hot group is
    reduced where it lies before it is exchanged.
    """
    counts = counts or {}
    order = [F.col("_best").desc(), F.col(score).desc_nulls_last(), F.col("_at").desc()]
    tagged = ranked.withColumns({"_at": position} | {n: F.when(F.col("_last"), c) for n, c in counts.items()})
    inside = W.partitionBy(group, "_slot")
    local = tagged.select(group, "_best", score, "_at", F.struct(*[F.col(c) for c in mirrored], F.col(member).alias("_id")).alias("_row"),
                          F.row_number().over(inside.orderBy(*order)).alias("_place"),
                          *[F.sum(n).over(inside).alias(n) for n in counts]).filter("_place <= 2")
    sums = [F.when(F.col("_place") == 1, F.col(n)).alias(n) for n in counts]
    among = local.select(group, F.when(F.col("_best"), F.col("_row")).alias("_row"), *sums,
                         F.row_number().over(W.partitionBy(group).orderBy(*order)).alias("_place"))
    first, second = (F.max(F.when(F.col("_place") == k, F.col("_row"))) for k in (1, 2))
    return among.groupBy(group).agg(F.array(first, second).alias("_top"), *[F.sum(n).cast("bigint").alias(n) for n in counts])


def opponent(member: str) -> Column:
    """The best other member of a row's group, by its ``_top``: the runner-up if the best is the row's own."""
    return F.when(F.get("_top", F.lit(0))["_id"].eqNullSafe(F.col(member)), F.get("_top", F.lit(1))).otherwise(
        F.get("_top", F.lit(0)))


def with_opponent(df: DataFrame, group: str, member: str, score: str, position: Column,
                  mirrored: list[str], suffix: str = "_other") -> DataFrame:
    """One row per (group, member) with the columns of the highest-scoring other member.

    Two candidates per group are enough, so nothing is paired up inside a group. Equal scores
    go to the last position. A group with one member gives NULL.
    """
    ranked = ranked_members(placed(df.withColumn("_pos", position), group, member), group, member, score, F.col("_pos"))
    # all columns of the data take part in the order, so that both uses read one and the same exchange
    whole = F.struct("_pos", *[c for c in df.columns if c not in (group, member, score) and c[0] != "_"])
    top = group_summary(ranked, group, member, score, whole, mirrored).withColumnRenamed(group, "_group")
    own = ranked.filter("_last").drop("_pos", "_slot", "_last", "_best")
    joined = own.join(top, F.col(group) == F.col("_group"), "left")
    return (joined.withColumn("_other", opponent(member))
            .select(*df.columns, *[F.col(f"_other.{c}").alias(c + suffix) for c in mirrored]))


def left_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   null_keys: list[str]) -> DataFrame:
    """Left join in which NULL meets NULL on ``null_keys``; one copy of the keys stays."""
    right = right.withColumnsRenamed({k: "_r_" + k for k in keys})
    on = F.lit(True)
    for k in keys:
        test = F.col(k).eqNullSafe(F.col("_r_" + k)) if k in null_keys else F.col(k) == F.col("_r_" + k)
        on = on & test
    return left.join(right, on, "left").drop(*["_r_" + k for k in keys])


def swap_roles(df: DataFrame, mask: Column, columns: list[str],
               suffix: str = "_other") -> DataFrame:
    """Where ``mask`` holds, move the own columns to the other side and blank them."""
    hit = F.coalesce(mask, F.lit(False))
    moved = {}
    for c in columns:
        moved[c + suffix] = F.when(hit, F.col(c)).otherwise(F.col(c + suffix))
        moved[c] = F.when(~hit, F.col(c))
    return df.withColumns(moved)


def with_age(users: DataFrame, accidents: DataFrame, key: str, year: str, born: str,
             into: str = "age") -> DataFrame:
    """Add the age at the accident; accidents are joined by key."""
    return (users.join(accidents.select(key, year), key, "left")
            .withColumn(into, F.col(year) - F.col(born)))


def small_inner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join with a result table whose size is checked before broadcasting."""
    return left.join(pin_small(right), key)


def category_counts(df: DataFrame, key: str, category: str, domain: list[str],
                    prefix: str, flags: bool = False) -> DataFrame:
    """One row per key, one count column per category of a fixed domain.

    Conditional sums in one aggregation: no scan to find the categories, NULL counts
    nowhere.  ``flags`` gives 0/1 instead of counts.
    """
    def one(c):
        hit = F.sum(F.when(F.col(category) == c, 1).otherwise(0))
        return (F.least(hit, F.lit(1)) if flags else hit).cast("bigint").alias(f"{prefix}{c}")
    return df.groupBy(key).agg(*[one(c) for c in domain])


def append(*tables: DataFrame) -> DataFrame:
    """Rows of all tables by column name; absent columns become NULL."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
