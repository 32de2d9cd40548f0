"""K-prototypes (Huang 1998) on mixed columns as repeated aggregations.

A row's distance to a prototype is the squared distance of its numeric columns plus
gamma times the number of differing categories.  Prototypes are k short rows of
literals, so assigning is a column expression; an update is one aggregation for the
means and one long count for the modes.  Every round starts again from the input, so
no lineage grows and nothing but the prototypes reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.operators.ordered import first_per_key


def mixed_distance(numeric: dict[str, float], categorical: dict[str, str], gamma: float) -> Column:
    """Distance of a row to one prototype; unknown numbers count 0, unknown text differs
    from every value but unknown."""
    parts = [F.coalesce(F.pow(F.col(c).cast("double") - F.lit(float(v)), 2), F.lit(0.0))
             for c, v in numeric.items()]
    parts += [F.when(F.col(c).cast("string").eqNullSafe(F.lit(v).cast("string")), 0.0).otherwise(float(gamma))
              for c, v in categorical.items()]
    return reduce(lambda a, b: a + b, parts)


def assign(df: DataFrame, prototypes: list[dict], numeric: list[str], categorical: list[str],
           gamma: float, label: str = "cluster", cost: str | None = None) -> DataFrame:
    """Nearest prototype (the first among equals) and, if asked, its distance."""
    distances = F.array(*[mixed_distance({c: p[c] for c in numeric}, {c: p[c] for c in categorical}, gamma)
                          for p in prototypes])
    out = df.withColumn("_d", distances).withColumn(label, fc.arg_max(F.transform("_d", lambda d: -d)))
    if cost:
        out = out.withColumn(cost, F.array_min("_d"))
    return out.drop("_d")


def means(df: DataFrame, numeric: list[str], label: str = "cluster") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                 *[F.avg(F.col(c).cast("double")).alias(c) for c in numeric])


def modes(df: DataFrame, categorical: list[str], label: str = "cluster") -> DataFrame:
    """Most frequent value per (cluster, column), the smallest among equals: long form."""
    from kerbside.operators.profile import value_table
    counts = value_table(df, categorical, "string", [label])
    return first_per_key(counts, [label, "column"], [F.desc("n"), F.asc_nulls_last("value")])


def default_gamma(df: DataFrame, numeric: list[str]) -> float:
    """Half the mean standard deviation of the numeric columns."""
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in numeric]).first()
    known = [row[c] or 0.0 for c in numeric]
    return 0.5 * sum(known) / len(known) if known else 1.0


@dataclass
class KPrototypesModel:
    prototypes: list[dict]
    numeric: list[str]
    categorical: list[str]
    gamma: float
    cost: float
    rounds: int
    converged: bool

    def transform(self, df: DataFrame, label: str = "cluster") -> DataFrame:
        return assign(df, self.prototypes, self.numeric, self.categorical, self.gamma, label)


@dataclass
class KPrototypes:
    k: int = 3
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    gamma: float | None = None
    restarts: int = 5
    seed: int = 42
    max_rounds: int | None = None      # None: until the cost falls no more

    def _start(self, rows: DataFrame, seed: int) -> list[dict]:
        """k different rows: the smallest digests of the row values, one aggregate each."""
        cols = self.numeric + self.categorical
        hashed = rows.withColumn("_h", fc.shuffle_key(
            [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols], seed))
        found, last = [], ""
        for _ in range(self.k):
            row = (hashed.filter(F.col("_h") > last)
                   .agg(F.min_by(F.struct(*cols), "_h").alias("r"), F.min("_h").alias("h")).first())
            if row["h"] is None:
                break
            last = row["h"]
            found.append({c: float(row["r"][c] or 0.0) for c in self.numeric}
                         | {c: row["r"][c] for c in self.categorical})
        return found

    def fit(self, df: DataFrame) -> KPrototypesModel:
        rows = df.select(*[F.col(c).cast("double").alias(c) for c in self.numeric],
                         *[F.col(c).cast("string").alias(c) for c in self.categorical])
        gamma = default_gamma(rows, self.numeric) if self.gamma is None else self.gamma
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            runs = [self._run(rows, self._start(rows, self.seed + r), gamma)
                    for r in range(self.restarts)]
            return min(runs, key=lambda m: m.cost)
        finally:
            rows.unpersist()

    def _run(self, rows: DataFrame, prototypes: list[dict], gamma: float) -> KPrototypesModel:
        cost, round_no, converged = float("inf"), 0, False
        while not converged and (self.max_rounds is None or round_no < self.max_rounds):
            round_no += 1
            labelled = assign(rows, prototypes, self.numeric, self.categorical, gamma, cost="_cost")
            updated, new_cost = self._update(labelled, prototypes)
            if updated == prototypes or new_cost >= cost:
                cost, converged = min(cost, new_cost), True
            else:
                prototypes, cost = updated, new_cost
        return KPrototypesModel(prototypes, self.numeric, self.categorical, gamma, cost, round_no, converged)

    def _update(self, labelled: DataFrame, old: list[dict]) -> tuple[list[dict], float]:
        """Means and modes per cluster, and the cost of the old prototypes.

        Only k rows per column come back.  An empty cluster keeps its prototype.
        """
        new = [dict(p) for p in old]
        total = 0.0
        sums = labelled.groupBy("cluster").agg(
            F.sum("_cost").alias("_cost"), *[F.avg(c).alias(c) for c in self.numeric])
        for r in sums.collect():
            total += r["_cost"]
            for c in self.numeric:
                new[r["cluster"]][c] = r[c] if r[c] is not None else 0.0
        if self.categorical:
            for r in modes(labelled, self.categorical).collect():
                new[r["cluster"]][r["column"]] = r["value"]
        return new, total
