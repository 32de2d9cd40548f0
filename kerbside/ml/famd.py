"""Factor analysis of mixed data.

The analysis is the principal components of standardised numbers and of category
indicators divided by the root of their share.  Their covariance follows from one
distributed correlation of the plain columns; only that square matrix, whose size is
the number of columns and categories, is decomposed on the driver.  Row coordinates are
sums of numbers and literal lookups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.operators.profile import value_table

MAX_SLOTS = 4096


@dataclass
class FamdModel:
    numeric: dict[str, tuple[float, float]]     # mean, population deviation
    categories: dict[str, dict[str, float]]     # value -> share
    values: np.ndarray                          # eigenvalues
    vectors: np.ndarray                         # slots x components
    inertia: float

    def _slots(self) -> list[tuple[str, str | None]]:
        return [(c, None) for c in self.numeric] + [(c, v) for c, d in self.categories.items() for v in d]

    def eigenvalues(self, spark) -> DataFrame:
        share = self.values / self.inertia * 100
        rows = [(i, float(v), float(p), float(c)) for i, (v, p, c) in enumerate(zip(self.values, share, np.cumsum(share)))]
        return spark.createDataFrame(rows, "component int, eigenvalue double, pct double, cumulative_pct double")

    def columns(self, spark) -> DataFrame:
        """(variable, component, coordinate, contribution): the coordinate is the squared
        correlation with the component (numbers) or the correlation ratio (categories)."""
        sums: dict[str, np.ndarray] = {}
        for (name, _), row in zip(self._slots(), self.vectors):
            sums[name] = sums.get(name, 0) + row ** 2
        rows = [(name, i, float(self.values[i] * s), float(s)) for name, sq in sums.items() for i, s in enumerate(sq)]
        return spark.createDataFrame(rows, "variable string, component int, coordinate double, contribution double")

    def rows(self, df: DataFrame, prefix: str = "f") -> DataFrame:
        """Add one coordinate column per component."""
        out = {}
        for k in range(self.vectors.shape[1]):
            weight = dict(zip(self._slots(), self.vectors[:, k]))
            total = F.lit(0.0)
            for c, (m, s) in self.numeric.items():
                if s:
                    total = total + (F.col(c).cast("double") - F.lit(m)) * F.lit(float(weight[(c, None)]) / s)
            for c, shares in self.categories.items():
                # Centre of the column: each indicator's mean over its root share is that root.
                centre = sum(float(weight[(c, v)]) * p ** 0.5 for v, p in shares.items())
                table = {v: float(weight[(c, v)]) / p ** 0.5 - centre for v, p in shares.items()}
                total = total + fc.lookup(F.col(c).cast("string"), table, -centre)
            out[f"{prefix}{k}"] = total
        return df.withColumns(out)


def fit(df: DataFrame, numeric: list[str], categorical: list[str], components: int = 10) -> FamdModel:
    rows = df.dropna("any", subset=[*numeric, *categorical])
    stats = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in numeric]).first()
    n = stats["_n"]
    numbers = {c: (float(stats[c]["m"]), float(stats[c]["s"])) for c in numeric}
    shares: dict[str, dict[str, float]] = {c: {} for c in categorical}
    if categorical:
        counts = value_table(rows, categorical).limit(MAX_SLOTS + 1).collect()
        if len(counts) + len(numeric) > MAX_SLOTS:
            raise ValueError("too many categories for a factor analysis")
        for r in sorted(counts, key=lambda r: (r["column"], r["value"])):
            shares[r["column"]][r["value"]] = r["n"] / n
    cells = [F.col(c).cast("double") for c in numeric]
    cells += [F.when(F.col(c).cast("string") == v, 1.0).otherwise(0.0) for c in categorical for v in shares[c]]
    matrix = Correlation.corr(rows.select(array_to_vector(F.array(*cells)).alias("v")), "v").first()[0].toArray()
    matrix = np.nan_to_num(np.array(matrix))      # a constant column is uncorrelated
    spread = [1.0 if numbers[c][1] else 0.0 for c in numeric]
    spread += [max(1.0 - p, 0.0) ** 0.5 for c in categorical for p in shares[c].values()]
    spread = np.array(spread)
    values, vectors = np.linalg.eigh(matrix * np.outer(spread, spread))
    order = np.argsort(values)[::-1][:components]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return FamdModel(numbers, shares, np.maximum(values[order], 0), vectors * signs, float((spread ** 2).sum()))
