"""Column expressions shared by batch preparation and scoring.

Everything here is a built-in expression: it stays in generated JVM code and works
the same on batch and streaming DataFrames.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions import codes

# White space that may sit inside digits, the no-break spaces included.
BLANKS = " \t\n\r\f\u000b\u00a0\u202f"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text to number ---------------------------------------------------------------
def strip_blanks(c) -> Column:
    return F.translate(_col(c).cast("string"), BLANKS, "")


def _double(text: Column) -> Column:
    # Text that cannot start a number is left out first: failing casts are slow.
    return F.when(text.rlike(r"^[-+]?\.?\d"), text).try_cast("double")


def blank_free_long(c) -> Column:
    """Identifier with blanks inside -> bigint, NULL if it is not a number."""
    return strip_blanks(c).try_cast("bigint")


def blank_free_double(c) -> Column:
    return _double(F.translate(strip_blanks(c), ",", "."))


def decimal_comma(c) -> Column:
    return _double(F.translate(F.trim(_col(c)), ",", "."))


def code(c) -> Column:
    """Register code as int; tolerates blanks around it and a trailing ``.0``."""
    return F.regexp_replace(F.trim(_col(c).cast("string")), r"\.0$", "").try_cast("int")


def lane_count(c) -> Column:
    """Number of lanes; text such as a multi-value marker becomes -1."""
    return F.coalesce(_double(strip_blanks(c)), F.lit(-1.0))


def is_not_number(c) -> Column:
    return _col(c).try_cast("double").isNull()


# ---- lookups ----------------------------------------------------------------------
def lookup(c, table: dict, default=None) -> Column:
    """Value of ``c`` in a literal map; absent and NULL keys give ``default``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    value = F.create_map(*pairs)[_col(c)]
    return value if default is None else F.coalesce(value, F.lit(default))


def ordinal_code(c, domain: list) -> Column:
    """Position of ``c`` in a fixed domain; NULL outside of it."""
    return lookup(c, {value: i for i, value in enumerate(domain)})


def decode(c, book: dict) -> Column:
    return lookup(c, book)


def in_codes(c, values: list) -> Column:
    """Membership that is false, not NULL, for NULL."""
    return F.coalesce(_col(c).isin(values), F.lit(False))


def sentinel_to_null(c, values: list) -> Column:
    col = _col(c)
    return F.when(~col.isin(values), col)


def grouped_class(c, classes: dict[str, list], other: str = "other") -> Column:
    """Class whose code list holds ``c``; NULL stays NULL, the rest is ``other``."""
    col = _col(c)
    chain = F.when(col.isNull(), F.lit(None).cast("string"))
    for name, members in classes.items():
        chain = chain.when(col.isin(members), F.lit(name))
    return chain.otherwise(F.lit(other))


def vehicle_class(c) -> Column:
    return grouped_class(c, codes.VEHICLE_CLASSES)


def class_weight(c, weights: dict | None = None) -> Column:
    return lookup(c, codes.OPPONENT_WEIGHTS if weights is None else weights, 1)


def interval_label(c, cuts: list[tuple], default: str | None = None) -> Column:
    """Label of the half-open interval [from, to) that holds ``c``."""
    col = _col(c)
    chain = None
    for low, high, label in cuts:
        test = (col >= low) & (col < high)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain if default is None else chain.otherwise(F.lit(default))


# ---- time -------------------------------------------------------------------------
def clock(c) -> Column:
    """``HH:MM`` text -> timestamp of which hour and minute are used; NULL if bad."""
    return F.try_to_timestamp(F.trim(_col(c)), F.lit("H:mm"))


def cyclic(c, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of the given length."""
    angle = _col(c) * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def valid_date(year, month, day) -> Column:
    """Date from three numbers; NULL where the calendar has no such day."""
    text = F.concat_ws("-", _col(year).cast("string"), _col(month).cast("string"),
                       _col(day).cast("string"))
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d")))


def time_of_day(hour) -> Column:
    return interval_label(hour, codes.TIME_OF_DAY)


def day_period(hour) -> Column:
    return interval_label(hour, codes.DAY_PERIOD, "Night")


def age_group(age) -> Column:
    return interval_label(age, codes.AGE_GROUPS)


# ---- flags ------------------------------------------------------------------------
def any_code(columns: list, values: list) -> Column:
    """1 if any of the columns holds one of the codes, else 0."""
    tests = [in_codes(code(c), values) for c in columns]
    return reduce(lambda a, b: a | b, tests).cast("int")


def both_equal(a, b, value=1) -> Column:
    return F.coalesce((_col(a) == value) & (_col(b) == value), F.lit(False)).cast("int")


def filled_weight(weights: dict, missing: int = -1) -> Column:
    """Sum of the weights of columns that are neither NULL nor the missing code."""
    def filled(names):
        cells = F.array_compact(F.array(*[F.col(n).cast("string") for n in names]))
        return F.size(F.array_remove(F.array_remove(cells, str(missing)), f"{missing}.0"))
    return reduce(lambda a, b: a + b, [
        filled([n for n, v in weights.items() if v == w]) * F.lit(w) for w in sorted(set(weights.values()))])


# ---- vehicles and roads -----------------------------------------------------------
def simplified_class(c, default: str) -> Column:
    return F.trim(F.coalesce(_col(c), F.lit(default)))


def impact_score(simplified, none_weight: int | None = None) -> Column:
    """Impact weight of a simplified class, 1 for classes without an entry.

    ``none_weight`` sets the score of "none" (no opponent); by default it has no entry.
    """
    weights = dict(codes.IMPACT_WEIGHTS)
    if none_weight is not None:
        weights["none"] = none_weight
    return lookup(simplified, weights, 1)


def road_complexity_raw(lanes, intersection, road_category, traffic_regime) -> Column:
    lanes_score = F.least(F.coalesce(_col(lanes).try_cast("double"), F.lit(1.0)),
                          F.lit(float(codes.MAX_LANES_SCORE)))
    return (lanes_score
            + lookup(intersection, codes.INTERSECTION_WEIGHTS, 1)
            + lookup(road_category, codes.ROAD_CATEGORY_WEIGHTS, 1)
            + lookup(traffic_regime, codes.TRAFFIC_REGIME_WEIGHTS, 1))


def scaled(value, low, high, top: float = 10.0) -> Column:
    """Min-max position of ``value`` times ``top``; 0 where the range is empty."""
    span = _col(high) - _col(low)
    return F.when(_col(value).isNull(), None).when(span == 0, F.lit(0.0)).otherwise(
        (_col(value) - _col(low)) / F.nullif(span, F.lit(0.0)) * top)


# ---- probabilities ----------------------------------------------------------------
def unit_sum(probabilities: Column) -> Column:
    """Clip an array of probabilities to 0..1 and make it sum to 1."""
    clipped = F.transform(probabilities, lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
    total = F.aggregate(clipped, F.lit(0.0), lambda acc, p: acc + p)
    return F.transform(clipped, lambda p: p / F.nullif(total, F.lit(0.0)))


def arg_max(values: Column) -> Column:
    """Position of the first largest element, counted from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def expected_class(probabilities: Column) -> Column:
    """Sum of position times probability."""
    weighted = F.transform(probabilities, lambda p, i: p * i)
    return F.aggregate(weighted, F.lit(0.0), lambda acc, p: acc + p)


def two_stage_probabilities(p_injured, p_severe_if_injured) -> Column:
    p_inj, p_sev = _col(p_injured), _col(p_severe_if_injured)
    severe = p_inj * p_sev
    return unit_sum(F.array(1.0 - p_inj, p_inj - severe, severe))


def speed_rule(speed, low: float = 50, high: float = 100) -> Column:
    """0 up to ``low``, 1 below ``high``, else (unknown speed too) 2."""
    return (F.when(_col(speed) <= low, F.lit(0)).when(_col(speed) < high, F.lit(1))
            .otherwise(F.lit(2)))


# ---- ordering by hash -------------------------------------------------------------
def shuffle_key(columns: list, seed=42) -> Column:
    """Hex digest that orders rows as good as at random, the same on any layout."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_col(c).cast("string") for c in columns]))


def hash_unit(key: Column) -> Column:
    """Number in [0, 1) from the last thirteen digits of a hex digest: 52 bits, all a double holds."""
    return F.conv(F.substring(key, 20, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
