"""From accident rows to a fitted, saveable scorer.

Preparation: columns left out, -1 as unknown where it says nothing, complete rows, fixed
domains. Training: outliers pruned by an isolation forest, classes balanced by undersampling,
columns encoded, a model fitted. The scorer keeps encoder, model and column lists together and
scores a table or a stream of reports from raw report to risk label.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import codes
from kerbside.ml import isolation, prepare
from kerbside.ml.models import SeverityModel
from kerbside.operators import clean, ordered
from kerbside.sources import sinks
from kerbside.streaming import scoring

TARGET = "injury_target"
NUMERIC = ["speed_limit"]


def prepared(rows: DataFrame, drops: list[str] | None = None, meaningful: list[str] | None = None,
             domains: dict[str, list] | None = None, keep: list[str] = ()) -> DataFrame:
    """Complete rows with ``<column>_code`` for the columns of a fixed domain.

    ``keep`` columns pass through untouched and never make a row incomplete. A value
    outside its domain makes the row incomplete.
    """
    drops = codes.MODEL_DROPS if drops is None else drops
    meaningful = codes.MINUS_ONE_HAS_MEANING if meaningful is None else meaningful
    domains = codes.ORDERED_DOMAINS if domains is None else domains
    left = clean.drop_present(rows, [c for c in drops if c not in keep])
    judged = [(n, k) for n, k in left.dtypes if n not in keep]
    filled = left.withColumns({n: F.coalesce(F.col(n), F.lit(-1).cast(k)) for n, k in judged if n in meaningful})
    for name, kind in judged:
        if name not in meaningful:
            filled = filled.filter(F.col(name) != (F.lit("-1") if kind == "string" else F.lit(-1)))    # drops NULL too
    coded = clean.fixed_domains(filled, {c: d for c, d in domains.items() if c not in keep})
    return coded.dropna("any", subset=[c for c in coded.columns if c.endswith("_code") and c not in filled.columns])


@dataclass
class Scorer:
    """Encoder, model and columns of a severity model, saved and loaded as one."""

    encoder: PipelineModel
    model: SeverityModel
    columns: list[str]          # what a report is completed to, in order
    categorical: list[str]

    def save(self, folder: str) -> None:
        sinks.save_model(PipelineModel([*self.encoder.stages, *self.model.stages()]), {
            "encoder_stages": len(self.encoder.stages), "parts": len(self.model.pipeline.stages), **self.model.metadata(),
            "columns": self.columns, "categorical": self.categorical}, folder)

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Scorer:
        pipeline, meta = sinks.load_model(spark, folder)
        n = meta["encoder_stages"]
        model = SeverityModel.of_stages(pipeline.stages[n:], meta["kind"], meta["classes"], meta.get("parts"))
        return Scorer(PipelineModel(pipeline.stages[:n]), model, meta["columns"], meta["categorical"])

    def score(self, reports: DataFrame, keep: list[str] = ()) -> DataFrame:
        """A report to its severity and risk label; projections only, so a stream will do."""
        whole = scoring.complete(scoring.derive(reports), self.columns, self.categorical, keep)
        scored = self.model.transform(self.encoder.transform(whole))
        return scoring.with_severity(scored).select(
            *keep, "prediction", "probability", "severity", "expected_severity", "gauge", "risk")


def train(rows: DataFrame, keys: list[str], one_hots: list[str], ordinals: list[str] | dict, fit: Callable[..., SeverityModel],
          numeric: list[str] = NUMERIC, target: str = TARGET, trees: int = 1000, classes: list[int] = (0, 1, 2),
          outlier: float = 0.5, seed: int = 42, categories: list[str] = ()) -> Scorer:
    """Prune outliers, balance the classes, encode and fit.

    Rows with an anomaly score above ``outlier`` are left out. ``rows`` are prepared rows; ``keys`` name a row for the seeded draws; ``fit`` is one of
    ``ml.models`` and takes (encoded rows, target, classes). ``categories`` are columns that the
    model encodes itself (target statistics of boosted trees).
    """
    codes_ = prepare.fit_encoder(rows, ordinals=[*one_hots, *ordinals], numeric=numeric, vector="_all")
    flat = codes_.transform(rows)
    features = [c for c in flat.columns if c.endswith("_ord")] + list(numeric)
    inliers = isolation.fit(flat, features, keys, trees=trees, seed=seed).inliers(flat, outlier).select(rows.columns)
    balanced = ordered.undersample(inliers, target, keys, seed)
    encoder = prepare.fit_encoder(balanced, one_hots=one_hots, ordinals=ordinals, numeric=numeric)
    model = fit(encoder.transform(balanced), target, list(classes))
    return Scorer(encoder, model, [*one_hots, *ordinals, *categories, *numeric], [*one_hots, *ordinals, *categories])
