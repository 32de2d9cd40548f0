"""K-prototypes for many groups and restarts at once: every model of a round in one pass.

Prototypes are a small table by (group, start, cluster). A round reads the rows once: a task measures
its rows against the prototypes of their group for all starts together, and adds up, per model, rows,
cost, sums of numbers and counts of categories. Those totals merge by addition, so a task passes on one
line per total, not per row, and the number of jobs of a round depends neither on the groups nor on the
starts. Models that have converged are left out of the next rounds.

Categories travel as 64-bit hashes; their texts come from a table of the distinct values, which also
decides ties between modes (the smallest value). Rows are written to the shared folder once.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.operators.ordered import first_per_key
from kerbside.operators.profile import value_table
from kerbside.session import durable, pin_small, written

COST = -1               # number of the column that holds a model's rows and cost
HELD = 200_000          # totals a task holds before it passes them on


def _flat(column: pa.Array, rows: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1) if rows else np.zeros((0, 0), kind)


def encoded(df: DataFrame, by: str | None, numeric: list[str], categorical: list[str]) -> DataFrame:
    """``df`` with ``_group`` (text), ``_x`` (numbers, NaN for unknown) and ``_c`` (hashes of the categories)."""
    number = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]).cast("array<double>")
    hashes = F.array(*[_hash(F.col(c).cast("string")) for c in categorical]).cast("array<bigint>")
    group = F.col(by).cast("string") if by else F.lit("")
    return df.withColumns({"_group": group, "_x": number, "_c": hashes})


def _hash(value: Column) -> Column:
    # NULL has a hash of its own, whatever the values are
    return F.when(value.isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(1), value))


def distances(x: np.ndarray, c: np.ndarray, px: np.ndarray, pc: np.ndarray, gamma: float) -> np.ndarray:
    """rows x prototypes: squared distance of the known numbers plus gamma per category that differs."""
    out = np.zeros((x.shape[0] if px.shape[1] else c.shape[0], len(px)))
    for j in range(px.shape[1]):
        d = (x[:, j, None] - px[None, :, j]) ** 2
        out += np.where(np.isnan(d), 0.0, d)
    for j in range(pc.shape[1]):
        out += np.where(c[:, j, None] == pc[None, :, j], 0.0, gamma)
    return out


@dataclass
class Models:
    """Prototypes by (group, start): numbers, category hashes and category values."""

    k: int
    numeric: list[str]
    categorical: list[str]
    gamma: dict[str | None, float]
    numbers: dict[tuple, np.ndarray]
    hashes: dict[tuple, np.ndarray]
    values: dict[tuple, list[list]]
    cost: dict[tuple, float] = field(default_factory=dict)
    rounds: dict[tuple, int] = field(default_factory=dict)
    converged: set = field(default_factory=set)

    def starts(self, group: str | None) -> list[tuple]:
        return sorted((m for m in self.numbers if m[0] == group), key=lambda m: m[1])

    def best(self, group: str | None) -> tuple:
        """The start of least cost, the first among equals."""
        return min(self.starts(group), key=lambda m: (self.cost.get(m, math.inf), m[1]))

    def chosen(self) -> Models:
        """One model a group."""
        keep = [self.best(g) for g in {m[0] for m in self.numbers}]
        return Models(self.k, self.numeric, self.categorical, self.gamma, *[
            {m: part[m] for m in keep} for part in (self.numbers, self.hashes, self.values)],
            {m: self.cost[m] for m in keep if m in self.cost}, {m: self.rounds[m] for m in keep if m in self.rounds},
            {m for m in keep if m in self.converged})

    def prototypes(self) -> list[dict]:
        """Rows (group, start, cluster, columns...) for looking at."""
        return [{"group": m[0], "start": m[1], "cluster": j} | dict(zip(self.numeric, self.numbers[m][j]))
                | dict(zip(self.categorical, self.values[m][j])) for m in sorted(self.numbers, key=repr) for j in range(len(self.numbers[m]))]


def totals(rows: DataFrame, models: Models, names: list[tuple]) -> DataFrame:
    """(group, start, cluster, column, code, n, total) of the named models over encoded rows.

    Numbers: known rows and their sum, ``code`` NULL. Categories: rows per hash. COST: rows and cost.
    """
    p, q = len(models.numeric), len(models.categorical)
    by_group: dict = defaultdict(list)
    for m in names:
        by_group[m[0]].append((m[1], models.numbers[m], models.hashes[m]))
    gamma = models.gamma

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: [0, 0.0])

        def flush() -> pa.RecordBatch:
            keys = list(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), *[pa.array([k[i] for k in keys], pa.int32()) for i in (1, 2, 3)],
                 pa.array([k[4] for k in keys], pa.int64()), pa.array([int(held[k][0]) for k in keys], pa.int64()),
                 pa.array([float(held[k][1]) for k in keys], pa.float64())],
                names=["group", "start", "cluster", "column", "code", "n", "total"])
            held.clear()
            return out

        def add(key: tuple, n: int, total: float) -> None:
            at = held[key]
            at[0] += n
            at[1] += total

        for batch in batches:
            n = batch.num_rows
            group = np.array(batch.column(0).to_pylist(), object)
            x, c = _flat(batch.column(1), n, float), _flat(batch.column(2), n, np.int64)
            for g in set(group.tolist()):
                own = np.flatnonzero(group == g) if g is not None else np.flatnonzero([v is None for v in group])
                gx, gc = x[own], c[own]
                coded = [np.unique(gc[:, j], return_inverse=True) for j in range(q)]
                for start, px, pc in by_group.get(g, []):
                    k = len(px)
                    d = distances(gx, gc, px, pc, gamma[g])
                    label = d.argmin(1)
                    least = d[np.arange(len(d)), label]
                    size = np.bincount(label, minlength=k)
                    for j, (m, s) in enumerate(zip(size, np.bincount(label, least, k))):
                        if m:
                            add((g, start, j, COST, None), m, s)
                    for i in range(p):
                        known = ~np.isnan(gx[:, i])
                        m, s = np.bincount(label[known], minlength=k), np.bincount(label[known], gx[known, i], k)
                        for j in np.flatnonzero(m):
                            add((g, start, int(j), i, None), m[j], s[j])
                    for i, (codes, at) in enumerate(coded):
                        counts = np.bincount(label * len(codes) + at, minlength=k * len(codes)).reshape(k, -1)
                        for j, v in zip(*np.nonzero(counts)):
                            add((g, start, int(j), p + i, int(codes[v])), counts[j, v], 0.0)
            if len(held) > HELD:
                yield flush()
        yield flush()

    parts = rows.select("_group", "_x", "_c").mapInArrow(
        run, "group string, start int, cluster int, column int, code long, n long, total double")
    keys = ["group", "start", "cluster", "column", "code"]
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@dataclass
class GroupedKPrototypes:
    k: int = 3
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    by: str | None = None
    gamma: float | None = None         # None: half the mean standard deviation of the numbers, per group
    restarts: int = 5
    seed: int = 42
    max_rounds: int | None = None      # None: until the cost falls no more
    keys: list[str] | None = None      # columns whose digest draws the starts; None: all of the model

    def _starts(self, df: DataFrame) -> tuple[dict, dict, dict]:
        """k different rows per group and start, those of the smallest digests; one job for all."""
        cols = self.keys or self.numeric + self.categorical
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols]
        drawn = F.array(*[F.struct(F.lit(r).alias("start"), fc.shuffle_key(texts, self.seed + r).alias("h"))
                          for r in range(self.restarts)])
        rows = df.select("_group", "_x", "_c", F.array(*[F.col(c).cast("string") for c in self.categorical]).cast(
            "array<string>").alias("values"), F.inline(drawn))
        # equal digests are equal rows: the first k digests, one row each
        w = W.partitionBy("_group", "start").orderBy("h")
        ranked = rows.withColumn("place", F.dense_rank().over(w)).filter(F.col("place") <= self.k)
        picked = ranked.groupBy("_group", "start", "place").agg(F.min(F.struct("_x", "_c", "values")).alias("row")).collect()
        numbers, hashes, values = {}, {}, {}
        for r in sorted(picked, key=lambda r: r["place"]):
            m = (r["_group"], r["start"])
            numbers.setdefault(m, []).append([0.0 if math.isnan(v) else v for v in r["row"]["_x"]])
            hashes.setdefault(m, []).append(list(r["row"]["_c"]))
            values.setdefault(m, []).append(list(r["row"]["values"]))
        return ({m: np.array(v, float).reshape(len(v), -1) for m, v in numbers.items()},
                {m: np.array(v, np.int64).reshape(len(v), -1) for m, v in hashes.items()}, values)

    def _gammas(self, df: DataFrame, groups: set) -> dict:
        if self.gamma is not None:
            return dict.fromkeys(groups, self.gamma)
        rows = df.groupBy("_group").agg(*[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(self.numeric)])
        out = {}
        for r in rows.collect():
            known = [r[f"s{i}"] or 0.0 for i in range(len(self.numeric))]
            out[r["_group"]] = 0.5 * sum(known) / len(known) if known else 1.0
        return out

    def _domain(self, df: DataFrame) -> DataFrame:
        """(column, code, value): the texts behind the hashes."""
        number = {c: len(self.numeric) + i for i, c in enumerate(self.categorical)}
        known = value_table(df, self.categorical)
        return known.select(fc.lookup("column", number).cast("int").alias("column"), _hash(F.col("value")).alias("code"), "value")

    def fit(self, df: DataFrame) -> Models:
        """All models, each at its last round; ``chosen`` leaves the best of a group."""
        columns = [*dict.fromkeys([*([self.by] if self.by else []), *self.numeric, *self.categorical, *(self.keys or [])])]
        rows = written(encoded(df.select(*columns), self.by, self.numeric, self.categorical), "encoded")
        models = Models(self.k, self.numeric, self.categorical, {}, *self._starts(rows))
        models.gamma = self._gammas(rows, {m[0] for m in models.numbers})
        domain = durable(self._domain(rows)) if self.categorical else None
        done = 0
        while self.max_rounds is None or done < self.max_rounds:
            open_models = [m for m in models.numbers if m not in models.converged]
            if not open_models:
                break
            done += 1
            self._round(rows, models, open_models, domain, done)
        return models

    def _round(self, rows: DataFrame, models: Models, names: list[tuple], domain: DataFrame | None, number: int) -> None:
        """Move the prototypes of the open models to the means and modes of their rows."""
        p = len(self.numeric)
        summed = totals(rows, models, names)
        if domain is not None:
            named = summed.join(pin_small(domain), ["column", "code"], "left")
            # numbers and costs have one line each; of a category the most frequent value, the smallest among equals
            summed = first_per_key(named, ["group", "start", "cluster", "column"], [F.desc("n"), F.asc_nulls_last("value")])
        else:
            summed = summed.withColumn("value", F.lit(None).cast("string"))
        new = {m: (models.numbers[m].copy(), models.hashes[m].copy(), [list(v) for v in models.values[m]]) for m in names}
        cost = dict.fromkeys(names, 0.0)
        lines = summed.collect()
        for r in lines:
            if r["column"] == COST:
                cost[r["group"], r["start"]] += r["total"]
                # a cluster has means of its own rows; a column it knows no number of is 0
                new[r["group"], r["start"]][0][r["cluster"]] = 0.0
        for r in lines:
            m, j, i = (r["group"], r["start"]), r["cluster"], r["column"]
            if 0 <= i < p:
                new[m][0][j, i] = r["total"] / r["n"]
            elif i >= p:
                new[m][1][j, i - p], new[m][2][j][i - p] = r["code"], r["value"]
        for m in names:
            models.rounds[m] = number
            same = (new[m][0] == models.numbers[m]).all() and (new[m][1] == models.hashes[m]).all()
            if same or cost[m] >= models.cost.get(m, math.inf):
                models.cost[m] = min(cost[m], models.cost.get(m, math.inf))
                models.converged.add(m)
            else:
                models.numbers[m], models.hashes[m], models.values[m] = new[m]
                models.cost[m] = cost[m]


def assign(df: DataFrame, models: Models, by: str | None, label: str = "cluster") -> DataFrame:
    """``df`` with the nearest prototype of its group's best model (the first among equals)."""
    best = models.chosen()
    table = {m[0]: (best.numbers[m], best.hashes[m], best.gamma[m[0]]) for m in best.numbers}

    @F.arrow_udf("int")
    def nearest(group: pa.Array, x: pa.Array, c: pa.Array) -> pa.Array:
        groups = np.array(group.to_pylist(), object)
        x, c = _flat(x, len(groups), float), _flat(c, len(groups), np.int64)
        out = np.full(len(groups), -1, np.int32)
        for g in set(groups.tolist()):
            own = np.flatnonzero(groups == g) if g is not None else np.flatnonzero([v is None for v in groups])
            if g in table:
                out[own] = distances(x[own], c[own], *table[g]).argmin(1)
        return pa.array(out, mask=out < 0)

    return encoded(df, by, best.numeric, best.categorical).withColumn(label, nearest("_group", "_x", "_c")).drop("_group", "_x", "_c")
