"""Gower distances of mixed rows.

The mean distance of a row to a whole group needs no pairs: for a category it is one
minus the value's share in the group, and for a number it follows from how many of the
group's values lie below and what they sum to.  Both come from counts per distinct value
and running sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.ordered import running_sums
from kerbside.operators.profile import long_form
from kerbside.session import match_null_safe

EXACT = "decimal(28,6)"


def ranges(df: DataFrame, numeric: list[str]) -> dict[str, float]:
    row = df.agg(*[(F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double"))).alias(c)
                   for c in numeric]).first()
    return {c: row[c] or 0.0 for c in numeric}


def distance(left: str, right: str, numeric: dict[str, float], categorical: list[str]) -> Column:
    """Gower distance of two structs of one row: mean over the columns of the scaled
    difference (numbers) or of inequality (categories; NULL is one of them).  A number
    unknown on either side takes no part; NULL if no column does."""
    def l(c): return F.col(f"{left}.{c}")
    def r(c): return F.col(f"{right}.{c}")
    parts = [F.abs(l(c).cast("double") - r(c).cast("double")) / F.lit(span or 1.0) for c, span in numeric.items()]
    parts += [F.when(l(c).eqNullSafe(r(c)), 0.0).otherwise(1.0) for c in categorical]
    known = reduce(lambda a, b: a + b, [F.when(p.isNull(), 0.0).otherwise(1.0) for p in parts])
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts]) / F.nullif(known, F.lit(0.0))


def to_groups(df: DataFrame, key: str, group: str, groups: list, numeric: list[str],
              categorical: list[str]) -> DataFrame:
    """Mean Gower distance of every row to every group: (key, own, group, distance).

    ``groups`` lists the group values.  Inside its own group a row is not compared with
    itself.  A number's mean distance is over the group's known values; columns whose
    number the row or the whole group lacks take no part in the row's mean.  Every row
    stays; its distance is NULL if no column takes part.  Sums of whole and decimal numbers
    (to six places) are exact, and divided once.
    """
    span = ranges(df, numeric)
    exact = all(k.startswith("decimal") or k in ("tinyint", "smallint", "int", "bigint") for c, k in df.dtypes if c in numeric)
    kind = EXACT if exact else "double"
    k = range(len(groups))
    hits = [F.sum(F.when(F.col(group) == g, 1).otherwise(0)).alias(f"n{i}") for i, g in enumerate(groups)]
    sizes = df.filter(F.col(group).isin(groups)).groupBy().agg(*hits).first()
    size = [sizes[i] or 0 for i in k]

    parts = []
    if numeric:
        cells = long_form(df, numeric, kind, [key, group]).filter(F.col("value").isNotNull())
        per = cells.groupBy("column", "value").agg(*hits)
        per = per.withColumns({f"s{i}": (F.col(f"n{i}") * F.col("value")).cast("decimal(38,6)" if exact else "double") for i in k})
        run = running_sums(per, ["column"], "value", [f"{x}{i}" for x in "ns" for i in k])
        totals = F.broadcast(per.groupBy("column").agg(*[F.sum(f"s{i}").alias(f"t{i}") for i in k],
                                                       *[F.sum(f"n{i}").alias(f"k{i}") for i in k]))
        scale = F.element_at(F.create_map(*[F.lit(x) for c in numeric for x in (c, span[c] or 1.0)]), F.col("column"))
        sums = run.join(totals, "column").select("column", "value", scale.alias("scale"), *[
            (F.col("value") * (2 * F.col(f"n{i}_cum") - F.col(f"k{i}")) + F.col(f"t{i}") - 2 * F.col(f"s{i}_cum")
             ).cast("double").alias(f"d{i}") for i in k], *[f"k{i}" for i in k])
        parts.append(cells.join(sums, ["column", "value"]).select(key, "column", *_means(groups, group)))
    if categorical:
        cells = long_form(df, categorical, "string", [key, group])
        per = cells.groupBy("column", "value").agg(*hits)
        misses = per.select("column", "value", F.lit(1.0).alias("scale"), *[(F.lit(size[i]) - F.col(f"n{i}")).alias(f"d{i}") for i in k],
                            *[F.lit(size[i]).alias(f"k{i}") for i in k])
        parts.append(match_null_safe(cells, misses, ["column", "value"]).select(key, "column", *_means(groups, group)))
    # one value per column and group, added in the order of the columns: the sum of doubles is always the same
    columns = [*numeric, *categorical]
    summed = reduce(lambda a, b: a.unionByName(b), parts).groupBy(key).agg(
        *[F.max(F.when(F.col("column") == c, F.col(f"d{i}"))).alias(f"d{i}_{j}") for i in k for j, c in enumerate(columns)])
    joined = df.select(key, F.col(group).alias("own")).join(summed, key, "left")
    cells = F.array(*[F.struct(F.lit(g).alias("group"), _mean([F.col(f"d{i}_{j}") for j in range(len(columns))]).alias("distance"))
                      for i, g in enumerate(groups)])
    return joined.select(key, "own", F.inline(cells))


def _mean(parts: list[Column]) -> Column:
    """Mean of the known values, added from left to right; NULL without any."""
    known = reduce(lambda a, b: a + b, [F.when(p.isNull(), 0.0).otherwise(1.0) for p in parts])
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts]) / F.nullif(known, F.lit(0.0))


def _means(groups: list, group: str) -> list[Column]:
    """Sum over a group's known values to their mean, the row itself left out; NULL if the group knows none."""
    return [F.when(F.col(f"k{i}") > 0, F.col(f"d{i}") / (F.col("scale") * F.greatest(F.lit(1), F.col(f"k{i}") - F.when(
        F.col(group) == g, 1).otherwise(0)))).alias(f"d{i}") for i, g in enumerate(groups)]


def group_linkage(distances: DataFrame) -> DataFrame:
    """Average linkage: mean distance between the rows of two groups."""
    return (distances.filter(F.col("own") != F.col("group")).groupBy("own", "group")
            .agg(F.avg("distance").alias("distance")))


