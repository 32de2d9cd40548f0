"""Order-dependent operators that do not pull a group into one task.

A plain window over a handful of groups (three classes, five years, no group at all)
sends each group to one task.  Here the order is cut into ranges first: counts per
(group, range) are aggregated map-side, their prefix sums give each range its offset,
and only rows inside one range are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.session import durable, match_null_safe, pin_small

RANGE_ROWS = 20_000     # rows of one group that a range of digests or values should hold at most
RANGE_DIGITS = 4        # hex digits of a digest that cut a choice into ranges: 65,536
PREFIX_BITS = 12        # bits by which a range of values is narrowed at a time: sign and exponent first


# ---- the shared helper ------------------------------------------------------------
def range_offsets(df: DataFrame, by: list[str], bucket: str,
                  sums: dict[str, Column], keep: bool = False) -> DataFrame:
    """Per (group, bucket): the sums over all earlier buckets of the group, ``<name>_before``
    (and, with ``keep``, the bucket's own sums)."""
    per = df.groupBy(*by, bucket).agg(*[c.alias(n) for n, c in sums.items()])
    w = W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return per.select(*by, bucket, *(sums if keep else []), *[
        F.coalesce(F.sum(n).over(w), F.lit(0)).alias(n + "_before") for n in sums])


def numbered(df: DataFrame, by: list[str], order: list[Column], bucket: Column,
             name: str = "rn", pin: bool = True) -> DataFrame:
    """Running number 1.. inside each group.

    ``bucket`` must not decrease along ``order``.  ``pin=False`` joins the offsets by a
    shuffle on (group, bucket), which the final window reuses: right for groups with as
    many keys as rows, such as accidents.
    """
    tagged = df.withColumn("_bucket", bucket)
    offsets = range_offsets(tagged, by, "_bucket", {"n": F.count(F.lit(1))})
    joined = match_null_safe(tagged, pin_small(offsets) if pin else offsets, [*by, "_bucket"])
    local = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*order))
    return (joined.withColumn(name, (local + F.col("n_before")).cast("bigint"))
            .drop("_bucket", "n_before"))


def hash_digits(rows: int) -> int:
    """Hex digits that cut ``rows`` into ranges of RANGE_ROWS or fewer; three at least."""
    digits = 3
    while rows > RANGE_ROWS * 16 ** digits:
        digits += 1
    return digits


def hash_bucket(key: str, digits: int = 3) -> Column:
    return F.substring(F.col(key), 1, digits)


# ---- first row per key ------------------------------------------------------------
def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1,
                  rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key.

    The rank filter is applied inside every task before the shuffle as well (window
    group limit), so at most ``n`` rows per key and task move, however hot the key.
    """
    name = rank or "_rank"
    ranked = (df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
              .filter(F.col(name) <= n))
    return ranked if rank else ranked.drop(name)


def best_row(df: DataFrame, key: list[str], score: Column, ties: list[Column]) -> DataFrame:
    """Row with the highest score per key; ``ties`` order the equals."""
    return first_per_key(df, key, [score.desc(), *ties])


def single_row_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once.  One aggregate, no window over the group."""
    others = [c for c in df.columns if c not in keys]
    grouped = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                     F.any_value(F.struct(*others)).alias("_row"))
               .filter("_n = 1"))
    return grouped.select(*keys, "_row.*").select(*df.columns)


def row_number_in_group(df: DataFrame, keys: list[str], order: list[Column], bucket: Column,
                        name: str = "rn") -> DataFrame:
    """Running number inside each key where keys are many and may be hot."""
    return numbered(df, keys, order, bucket, name, pin=False)


def synthetic_key(df: DataFrame, key: str, order: list[Column], bucket: Column,
                  into: str = "id_user", marker: str = "_U") -> DataFrame:
    """``<key>_U<n>`` with n the running number inside the key."""
    if key not in df.columns:
        raise ValueError(f"key column {key!r} is missing")
    out = row_number_in_group(df, [key], order, bucket, "_n")
    return out.withColumn(into, F.concat_ws(marker, F.col(key).cast("string"),
                                            F.col("_n").cast("string"))).drop("_n")


# ---- sampling by hash -------------------------------------------------------------
def hash_sample(df: DataFrame, n: int, keys: list[str], seed=42) -> DataFrame:
    """``n`` rows, the same on any layout (the n smallest digests)."""
    return (df.withColumn("_h", fc.shuffle_key(keys, seed)).orderBy("_h", *keys).limit(n)
            .drop("_h"))


def range_counts(df: DataFrame, by: str, keys: list[str], seed=42, digits: int = RANGE_DIGITS) -> DataFrame:
    """(by, _bucket, _n): rows of each group per digest range; the one pass that a choice by digest needs."""
    return df.groupBy(by, hash_bucket_of(keys, seed, digits).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))


def hash_bucket_of(keys: list[str], seed, digits: int) -> Column:
    return F.substring(fc.shuffle_key(keys, seed), 1, digits)


def first_by_hash(df: DataFrame, by: str, keys: list[str], need: DataFrame, seed=42,
                  digits: int = RANGE_DIGITS, per: DataFrame | None = None) -> DataFrame:
    """Per group the ``need`` rows with the smallest digests, exactly.

    ``need`` has one row per group: (by, need).  Only the one digest range per group in
    which the cut falls is ranked; all other rows are kept or left by comparison.  ``per``
    are the ``range_counts`` of the same rows, if the caller has them already.
    """
    per = range_counts(df, by, keys, seed, digits) if per is None else per
    tagged = df.withColumn("_h", fc.shuffle_key(keys, seed)).withColumn("_bucket", hash_bucket("_h", digits))
    w = W.partitionBy(by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    need = need.withColumnRenamed(by, "_by")
    cut = (per.withColumns({"_upto": F.sum("_n").over(w),
                            "_all": F.sum("_n").over(W.partitionBy(by))})
           .join(need, F.col(by).eqNullSafe(F.col("_by")))
           .withColumn("need", F.least("need", "_all"))
           .filter((F.col("_upto") >= F.col("need")) & (F.col("_upto") - F.col("_n") < F.col("need")))
           .select("_by", F.col("_bucket").alias("_cut"),
                   (F.col("need") - F.col("_upto") + F.col("_n")).alias("_rest")))
    joined = tagged.join(pin_small(cut), F.col(by).eqNullSafe(F.col("_by")))
    below = joined.filter(F.col("_bucket") < F.col("_cut"))
    at = joined.filter(F.col("_bucket") == F.col("_cut")).withColumn(
        "_rn", F.row_number().over(W.partitionBy(by).orderBy("_h", *keys)))
    at = at.filter(F.col("_rn") <= F.col("_rest"))
    return below.select(df.columns).unionByName(at.select(df.columns))


def undersample(df: DataFrame, target: str, keys: list[str], seed=42) -> DataFrame:
    """As many rows of every class as the rarest class has (exact).

    One pass counts the rows of each class by digest range: the class sizes, the rarest and
    the range with the cut all come from that small table.
    """
    per = durable(range_counts(df, target, keys, seed))
    counts = per.groupBy(target).agg(F.sum("_n").alias("n"))
    smallest = counts.agg(F.min("n").alias("m")).scalar()
    need = counts.select(target, smallest.alias("need"))
    return first_by_hash(df, target, keys, need, seed, per=per)


def stratified_folds(df: DataFrame, target: str, keys: list[str], k: int = 3, seed=42,
                     name: str = "fold") -> DataFrame:
    """Fold number 0..k-1, spread evenly inside every class in digest order.

    Give the grouping key as ``keys`` and a column constant inside the group as
    ``target`` to keep groups together.
    """
    tagged = df.withColumn("_h", fc.shuffle_key(keys, seed))
    out = numbered(tagged, [target], [F.col("_h"), *[F.col(c) for c in keys]],
                   hash_bucket("_h", hash_digits(df.count())), "_rn")
    return out.withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn", "_h")


def random_draw_impute(df: DataFrame, column: str, keys: list[str], seed=42) -> DataFrame:
    """Fill NULL with a value drawn from the observed ones, by digest of the row key."""
    tagged = df.withColumn("_h", fc.shuffle_key(keys, seed))
    observed = tagged.filter(F.col(column).isNotNull()).withColumn("_g", F.lit(1))
    pool = numbered(observed.select("_g", "_h", *keys, F.col(column).alias("_drawn")), ["_g"],
                    [F.col("_h"), *[F.col(c) for c in keys]], hash_bucket("_h", hash_digits(df.count())), "_pos")
    pool = pool.select("_pos", "_drawn")
    n = observed.agg(F.count(F.lit(1)).alias("n")).scalar()
    missing = tagged.filter(F.col(column).isNull()).withColumn(
        "_pos", (F.floor(fc.hash_unit(F.col("_h")) * n) + 1).cast("bigint"))
    filled = missing.join(pool, "_pos", "left").withColumn(column, F.col("_drawn"))
    return (tagged.filter(F.col(column).isNotNull()).select(df.columns)
            .unionByName(filled.select(df.columns)))


# ---- running sums over an ordered value --------------------------------------------
def image(value: Column) -> Column:
    """The bits of a double as a bigint in the order of the doubles; both zeros are 0, NaN is the last.

    Exponent and fraction are taken apart with powers of two, which are exact.
    """
    x = value.cast("double")
    a = F.abs(x)
    guess = F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1022))      # the logarithm may be one off
    ratio = a / F.pow(F.lit(2.0), guess)
    exponent = F.when(ratio >= 2, guess + 1).when((ratio < 1) & (guess > -1022), guess - 1).otherwise(guess)
    fraction = a / F.pow(F.lit(2.0), exponent)
    whole = 2.0 ** 52
    bits = F.when(fraction >= 1, (exponent + 1023) * F.lit(1 << 52) + ((fraction - 1) * whole).cast("bigint")).otherwise(
        (fraction * whole).cast("bigint"))
    bits = F.when(a == 0, F.lit(0)).when(a == float("inf"), F.lit(2047 << 52)).otherwise(bits)
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -bits).otherwise(bits)


def with_value_bucket(df: DataFrame, by: list[str], value: str, bits: int | None = None,
                      rows: int | None = None) -> DataFrame:
    """Add ``_bucket``, which never falls as the value grows: at most ``rows`` rows of a group, or one value.

    Rows are counted by the leading ``bits`` bits of the value's image; only prefixes that hold more
    than ``rows`` rows are counted on by the next bits. Equal values share a bucket, and however
    narrow the range most rows lie in, no bucket is large.
    """
    bits = PREFIX_BITS if bits is None else bits
    rows = RANGE_ROWS if rows is None else rows
    tagged = df.withColumn("_image", image(F.col(value)))
    shift, inside, refined = 64 - bits, tagged, []
    while shift > 0:
        prefix = F.shiftright("_image", shift)
        large = durable(inside.groupBy(*by, prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
                        .filter(F.col("_n") > rows).drop("_n"))
        if not large.limit(1).count():
            break
        large = pin_small(large.withColumn("_large", F.lit(True)))
        refined.append((shift, large))
        inside = match_null_safe(tagged.withColumn("_prefix", prefix), large, [*by, "_prefix"]).drop("_prefix", "_large")
        shift = max(0, shift - bits)
    out = tagged.withColumn("_bucket", _first_of("_image", 64 - bits))
    for at, large in refined:
        # a row inside a large prefix has the bucket of its next bits
        marked = match_null_safe(out.withColumn("_prefix", F.shiftright("_image", at)), large, [*by, "_prefix"], "left")
        out = marked.withColumn("_bucket", F.when(F.col("_large"), _first_of("_image", max(0, at - bits))).otherwise(
            F.col("_bucket"))).drop("_prefix", "_large")
    return out.drop("_image")


def _first_of(column: str, shift: int) -> Column:
    """The smallest image with the same leading bits."""
    return F.shiftleft(F.shiftright(column, shift), shift)


def running_sums(df: DataFrame, by: list[str], value: str, sums: list[str],
                 descending: bool = False, bits: int | None = None) -> DataFrame:
    """Running sums in order of a value that is distinct inside each group (``bits``: see with_value_bucket).

    Adds ``<name>_cum`` for each summed column; the current row is included.
    """
    tagged = with_value_bucket(df, by, value, bits)
    if descending:
        tagged = tagged.withColumn("_bucket", F.bitwise_not("_bucket"))      # minus one minus it: never overflows
    offsets = pin_small(range_offsets(tagged, by, "_bucket", {s: F.sum(s) for s in sums}))
    order = F.col(value).desc() if descending else F.col(value).asc()
    w = W.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    joined = match_null_safe(tagged, offsets, [*by, "_bucket"])
    out = joined.withColumns({
        s + "_cum": F.sum(s).over(w) + F.col(s + "_before") for s in sums})
    return out.drop("_bucket", *[s + "_before" for s in sums])
