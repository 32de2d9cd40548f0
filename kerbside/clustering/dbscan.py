"""Density clustering of points in the plane, exact and without listing all near pairs.

The plane is cut into cells whose diagonal is at most eps.  Points of one cell are within
eps of each other, so

* a cell with ``min_samples`` points makes all of them core: nothing is counted there;
* only points of thinner cells are compared with the cells around them, and such a cell
  has fewer than ``min_samples`` points: comparisons grow linearly with the points;
* core points of one cell belong together, so clusters are components of cells.

Whether two neighbouring cells hold core points within eps is decided on bounding boxes
of sub-cells: farthest corners within eps says yes, nearest sides beyond eps says no, and
only undecided boxes are cut finer, until boxes are single places.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import durable

CELL = ["cx", "cy"]


def _side(eps: float) -> float:
    return eps / math.sqrt(2) * (1 - 1e-9)


def _with_cells(df: DataFrame, key: str, x: str, y: str, eps: float) -> DataFrame:
    s = _side(eps)
    return df.select(F.col(key).alias("id"), F.col(x).cast("double").alias("x"),
                     F.col(y).cast("double").alias("y")).withColumns(
        {"cx": F.floor(F.col("x") / s), "cy": F.floor(F.col("y") / s)})


def _around(df: DataFrame, half: bool = False) -> DataFrame:
    """Each row once per neighbouring cell (nx, ny); ``half`` gives every pair of cells once."""
    steps = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if not half or (i, j) > (0, 0)]
    offsets = F.array(*[F.struct((F.col("cx") + i).alias("nx"), (F.col("cy") + j).alias("ny"))
                        for i, j in steps])
    return df.select(*df.columns, F.inline(offsets))


def _near(eps: float):
    return F.pow(F.col("x") - F.col("px"), 2) + F.pow(F.col("y") - F.col("py"), 2) <= eps * eps


def _marked_core(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """points with ``core``."""
    dense = points.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
    tagged = points.join(dense, CELL)
    thin = _around(tagged.filter(F.col("_n") < min_samples).select("id", "x", "y", *CELL))
    other = points.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("x").alias("px"),
                          F.col("y").alias("py"))
    found = (thin.join(other, ["nx", "ny"]).filter(_near(eps)).groupBy("id")
             .agg(F.count(F.lit(1)).alias("_near")).filter(F.col("_near") >= min_samples)
             .select("id", F.lit(True).alias("_hit")))
    return tagged.join(found, "id", "left").select(
        "id", "x", "y", *CELL, ((F.col("_n") >= min_samples) | F.coalesce("_hit", F.lit(False))).alias("core"))


def core_points(df: DataFrame, key: str, x: str, y: str, eps: float, min_samples: int) -> DataFrame:
    """(key, core): has the point at least ``min_samples`` points, itself included, within eps?"""
    out = _marked_core(_with_cells(df, key, x, y, eps), eps, min_samples)
    return out.select(F.col("id").alias(key), "core")


def _boxes(core: DataFrame, side: float, level: int) -> DataFrame:
    """Bounding boxes of core points per sub-cell; a level cuts every side into four."""
    step = side / 4 ** level
    sub = {"si": F.floor((F.col("x") - F.col("cx") * side) / step),
           "sj": F.floor((F.col("y") - F.col("cy") * side) / step)}
    return core.withColumns(sub).groupBy(*CELL, "si", "sj").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def _box_distances(pairs: DataFrame) -> DataFrame:
    def gap(a0, a1, b0, b1):
        return F.greatest(F.lit(0.0), F.col(b0) - F.col(a1), F.col(a0) - F.col(b1))

    def reach(a0, a1, b0, b1):
        return F.greatest(F.abs(F.col(b1) - F.col(a0)), F.abs(F.col(a1) - F.col(b0)))
    x, y = ("a_x0", "a_x1", "b_x0", "b_x1"), ("a_y0", "a_y1", "b_y0", "b_y1")
    return pairs.withColumns({"low": F.pow(gap(*x), 2) + F.pow(gap(*y), 2),
                              "high": F.pow(reach(*x), 2) + F.pow(reach(*y), 2)})


def _point_links(core: DataFrame, pairs: DataFrame, side: float, level: int, eps: float) -> DataFrame:
    """Pairs of cells among ``pairs`` of boxes that hold two points within eps."""
    step = side / 4 ** level
    points = core.select("x", "y", *CELL, F.floor((F.col("x") - F.col("cx") * side) / step).alias("si"),
                         F.floor((F.col("y") - F.col("cy") * side) / step).alias("sj")).distinct()
    a = points.toDF("x", "y", "ax", "ay", "a_i", "a_j")
    b = points.toDF("px", "py", "bx", "by", "b_i", "b_j")
    return (pairs.join(a, ["ax", "ay", "a_i", "a_j"]).join(b, ["bx", "by", "b_i", "b_j"]).filter(_near(eps))
            .select("ax", "ay", "bx", "by").distinct())


def _cell_links(core: DataFrame, eps: float, max_level: int = 26) -> DataFrame:
    """Pairs of neighbouring cells (ax, ay, bx, by) with core points within eps."""
    side, limit = _side(eps), eps * eps
    pair = ["ax", "ay", "bx", "by"]

    def side_of(boxes, letter):
        names = {"cx": f"{letter}x", "cy": f"{letter}y", "si": f"{letter}_i", "sj": f"{letter}_j"}
        return boxes.withColumnsRenamed(names | {c: f"{letter}_{c}" for c in ("x0", "x1", "y0", "y1")})
    cells = _boxes(core, side, 0)
    a = _around(cells.select(*CELL), half=True).select(
        F.col("cx").alias("ax"), F.col("cy").alias("ay"), F.col("nx").alias("bx"), F.col("ny").alias("by"))
    active = (a.join(side_of(cells, "a"), ["ax", "ay"]).join(side_of(cells, "b"), ["bx", "by"]))
    links = None
    for level in range(max_level):
        judged = durable(_box_distances(active).filter(F.col("low") <= limit))
        yes = judged.filter(F.col("high") <= limit).select(*pair).distinct()
        links = yes if links is None else links.unionByName(yes)
        open_ = judged.filter(F.col("high") > limit).join(yes, pair, "left_anti")
        if open_.isEmpty():
            break
        finer = _boxes(core, side, level + 1)
        children = finer.withColumns({"pi": F.floor(F.col("si") / 4), "pj": F.floor(F.col("sj") / 4)})
        left = side_of(children, "a").withColumnsRenamed({"pi": "a_pi", "pj": "a_pj"})
        right = side_of(children, "b").withColumnsRenamed({"pi": "b_pi", "pj": "b_pj"})
        parents = open_.select(*pair, F.col("a_i").alias("a_pi"), F.col("a_j").alias("a_pj"),
                               F.col("b_i").alias("b_pi"), F.col("b_j").alias("b_pj"))
        active = (parents.join(left, ["ax", "ay", "a_pi", "a_pj"]).join(right, ["bx", "by", "b_pi", "b_pj"])
                  .drop("a_pi", "a_pj", "b_pi", "b_pj"))
    else:
        # Boxes of a few units in the last place: decide by the distinct points in them.
        links = links.unionByName(_point_links(core, judged, side, max_level - 1, eps))
    return durable(links.distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of undirected edges (u, v); the component is its
    smallest node.

    Alternates two steps until nothing changes: larger neighbours move to the smallest
    neighbour, then smaller ones do.  The number of rounds grows with the logarithm of the
    longest path.
    """
    current = durable(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
                      .filter("u <> v").distinct())
    size, done = -1, False
    while not done:
        both = current.unionByName(current.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        before, current = current, durable(small)
        size, last = current.count(), size
        done = size == last and current.join(before, ["u", "v"], "left_anti").isEmpty()
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def dbscan(df: DataFrame, key: str, x: str, y: str, eps: float, min_samples: int,
           label: str = "cluster") -> DataFrame:
    """(key, label): the cluster, named by the smallest key of its core points; -1 is noise.

    A point on the border of several clusters goes to the one with the smallest name.
    """
    points = durable(_marked_core(_with_cells(df, key, x, y, eps), eps, min_samples))
    core = points.filter("core")
    cell = F.struct(*CELL)
    links = _cell_links(core, eps).select(F.struct(F.col("ax").alias("cx"), F.col("ay").alias("cy")).alias("u"),
                                          F.struct(F.col("bx").alias("cx"), F.col("by").alias("cy")).alias("v"))
    linked = components(links)
    cells = (core.groupBy(*CELL).agg(F.min("id").alias("first")).withColumn("node", cell)
             .join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
    names = cells.groupBy("component").agg(F.min("first").alias("name"))
    named = cells.join(names, "component").select(*CELL, "name")
    core_named = core.join(named, CELL).select("id", "x", "y", *CELL, "name")
    edge = _around(points.filter("not core").select("id", "x", "y", *CELL))
    other = core_named.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("x").alias("px"),
                              F.col("y").alias("py"), "name")
    border = (edge.join(other, ["nx", "ny"]).filter(_near(eps)).groupBy("id").agg(F.min("name").alias("name")))
    out = points.filter("not core").select("id").join(border, "id", "left").unionByName(
        core_named.select("id", "name"))
    return out.select(F.col("id").alias(key), F.coalesce("name", F.lit(-1)).alias(label))
