"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its distinct words, hashed, together of length one, and one bucket per
statistic (length, shares of kinds of signs, repeated lines and words, line shape, the stored
length). The score is the logistic of w0 + sum w_i x_i + pairwise terms <v_i, v_j> x_i x_j; the
pairwise sum is half of (sum v_i x_i)^2 - sum (v_i x_i)^2 per factor, linear in the features.

The model is fitted by AdaGrad in mini-batches on a bounded sample of labelled rows outside the
held-out fold; language, source and id are no features. Documents are scored where they are.

Null and empty texts have buckets of zero and no words, and get a score like any other; repeated
rows score alike; texts are read whole; an empty table gives no rows; extra columns pass through
(one named ``quality_score`` is replaced). Without labels every document scores one half.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import labelled, slices, with_columns_from

SAMPLE_ROWS = 20_000     # labelled rows the model is fitted to, at most
THRESHOLD = 0.7
WORDS = 1 << 16          # hash buckets of words
BUCKETS = 16             # of each statistic
FACTORS = 8
EPOCHS = 8
BATCH = 256
SEED = 42
_KINDS = {"upper": re.compile("[A-ZÀ-ÖØ-Þ]"), "digit": re.compile("[0-9]"), "space": re.compile(r"\s"),
          "stop": re.compile("[.,;:]"), "mark": re.compile("[!?]"), "sign": re.compile(r"[#$%&*|@<>{}\[\]\\^~=+_/]")}
STATISTICS = ["chars", "stored", "words", "lines", "word_length", "line_words", "distinct", "repeated_lines", *_KINDS]


class Buckets(dict):
    """Hash bucket of each word; forgotten as a whole past a size."""

    LIMIT = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) > self.LIMIT:
            self.clear()
        self[word] = b = xxhash.xxh64_intdigest(word) % WORDS
        return b


def _log_bucket(v: float, per: float) -> int:
    return min(BUCKETS - 1, int(math.log1p(v) * per))


def _share_bucket(v: float) -> int:
    """Zero has a bucket of its own; the rest by square roots, finer near zero."""
    return 0 if v <= 0 else min(BUCKETS - 1, 1 + int(math.sqrt(v) * (BUCKETS - 1)))


def features(text: str, stored_chars: int | None, buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values) of a document."""
    words = text.lower().split()
    distinct = set(words)
    lines = [x for x in text.split("\n") if x.strip()]
    n, w = max(1, len(text)), max(1, len(words))
    # signs by the length left when they are deleted: no list of matches
    shares = [(len(text) - len(k.sub("", text))) / n for k in _KINDS.values()]
    spread = [_log_bucket(len(text), 1.3), _log_bucket(len(text) if stored_chars is None else max(0, stored_chars), 1.3),
              _log_bucket(len(words), 1.6), _log_bucket(len(lines), 2.5), min(BUCKETS - 1, int(n / w)),
              _log_bucket(len(words) / max(1, len(lines)), 2.5), _share_bucket(len(distinct) / w),
              _share_bucket(1 - len(set(lines)) / max(1, len(lines))), *map(_share_bucket, shares)]
    hashed = np.unique(np.fromiter((buckets[x] for x in distinct), np.int64, len(distinct)))
    first = WORDS + BUCKETS * np.arange(len(spread))
    ids = np.concatenate([hashed, first + np.array(spread)])
    values = np.ones(len(ids))
    values[:len(hashed)] = 1 / math.sqrt(max(1, len(hashed)))
    return ids, values


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray      # one per feature
    factors: np.ndarray      # features x FACTORS

    def margin(self, ids: np.ndarray, x: np.ndarray) -> float:
        vx = self.factors[ids] * x[:, None]
        s = vx.sum(0)
        return self.bias + float(self.weights[ids] @ x) + 0.5 * float((s * s - (vx * vx).sum(0)).sum())


SIZE = WORDS + BUCKETS * len(STATISTICS)


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, l2: float = 1e-4, rate: float = 0.1) -> Model:
    """AdaGrad on the logistic loss; zero factors' symmetry is broken by small random ones."""
    rng = np.random.default_rng(SEED)
    w, v = np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, FACTORS))
    if not len(y):
        return Model(0.0, w, np.zeros_like(v))
    mean = np.clip(y.mean(), 0.01, 0.99)
    bias, gw, gv, gb = math.log(mean / (1 - mean)), np.full(SIZE, 1e-6), np.full((SIZE, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(order), BATCH):
            some = order[a:a + BATCH]
            ids = np.concatenate([rows[i][0] for i in some])
            x = np.concatenate([rows[i][1] for i in some])
            row = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
            starts = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
            vx = v[ids] * x[:, None]
            s = np.add.reduceat(vx, starts)
            z = bias + np.add.reduceat(w[ids] * x, starts) + 0.5 * (s * s - np.add.reduceat(vx * vx, starts)).sum(1)
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            used, where = np.unique(ids, return_inverse=True)
            dx = d[row] * x
            g = np.bincount(where, dx, len(used)) + l2 * w[used]
            gw[used] += g * g
            w[used] -= rate * g / np.sqrt(gw[used])
            for f in range(FACTORS):
                g = np.bincount(where, dx * (s[row, f] - vx[:, f]), len(used)) + l2 * v[used, f]
                gv[used, f] += g * g
                v[used, f] -= 0.3 * rate * g / np.sqrt(gv[used, f])
            gb += d.sum() ** 2
            bias -= rate * d.sum() / math.sqrt(gb)
    return Model(float(bias), w, v)


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most ``sample_rows`` labelled rows outside the held-out fold; their features reach the driver."""
    picked = labelled(labels, "quality", modulus, held, sample_rows)
    sample = docs.select("doc_id", "text", _stored(docs)).join(F.broadcast(picked), "doc_id")

    def run(batches):
        buckets = Buckets()
        for batch in slices(batches):
            found = [features(t or "", n, buckets)
                     for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3),
                 pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                 pa.array([len(i) - len(STATISTICS) for i, _ in found], pa.int32())],
                names=["doc_id", "quality", "ids", "hashed"])

    got = (sample.mapInArrow(run, "doc_id long, quality int, ids array<int>, hashed int")
           .orderBy("doc_id", "ids").toArrow())
    rows = []
    for ids, n in zip(got.column("ids").to_numpy(), got.column("hashed").to_numpy()):
        x = np.ones(len(ids))
        x[:n] = 1 / math.sqrt(max(1, n))
        rows.append((np.asarray(ids, np.int64), x))
    return train(rows, got.column("quality").to_numpy().astype(float))


def _stored(docs: DataFrame):
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("long").alias("n_chars")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with quality_score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32)))      # 2.4 MB
    if "n_chars" not in docs.columns:
        docs = docs.withColumn("n_chars", F.lit(None).cast("long"))

    def make():
        bias, w, v = shared.value
        m, buckets = Model(bias, w, v), Buckets()

        def compute(batch):
            z = [m.margin(*features(t or "", n, buckets))
                 for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
            return [pa.array(1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30))), pa.float64())]
        return compute

    return with_columns_from(docs, [T.StructField("quality_score", T.DoubleType())], make)
