"""Evaluation of ordinal classifiers.

All metrics come from one aggregation of (truth, prediction) counts; only that table,
whose size is the square of the number of classes, is used afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions import columns as fc
from kerbside.operators.ordered import running_sums


def confusion_counts(df: DataFrame, truth: str, pred: str) -> DataFrame:
    known = df.filter(F.col(truth).isNotNull() & F.col(pred).isNotNull())
    return known.groupBy(F.col(truth).cast("int").alias("truth"),
                         F.col(pred).cast("int").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, pred: str, labels: list[int]) -> DataFrame:
    """Every (truth, prediction) pair of the labels: count, share of the truth's rows,
    share of the prediction's rows.  Pairs that never occur are there with 0."""
    counts = confusion_counts(df, truth, pred)
    cells = [F.struct(F.lit(t).alias("truth"), F.lit(p).alias("pred"), F.coalesce(F.sum(
        F.when((F.col("truth") == t) & (F.col("pred") == p), F.col("n"))), F.lit(0)).alias("n"))
        for t in labels for p in labels]
    grid = counts.agg(F.array(*cells).alias("_g")).select(F.inline("_g"))
    by_truth = F.sum("n").over(W.partitionBy("truth"))
    by_pred = F.sum("n").over(W.partitionBy("pred"))
    return grid.withColumns({
        "share_of_truth": F.col("n") / F.nullif(by_truth, F.lit(0)),
        "share_of_pred": F.col("n") / F.nullif(by_pred, F.lit(0))})


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / F.nullif(b, F.lit(0)))


def _sum_where(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("double")


def class_report(df: DataFrame, truth: str, pred: str, labels: list[int]) -> DataFrame:
    """Per label precision, recall, F1, support; then accuracy, macro and weighted rows.

    Divisions by zero give 0.
    """
    counts = confusion_counts(df, truth, pred)
    rows = [F.struct(
        F.lit(str(c)).alias("label"),
        _sum_where((F.col("truth") == c) & (F.col("pred") == c)).alias("tp"),
        _sum_where(F.col("pred") == c).alias("predicted"),
        _sum_where(F.col("truth") == c).alias("support")) for c in labels]
    per = counts.agg(F.array(*rows).alias("_r"), _sum_where(F.col("truth") == F.col("pred")).alias("hits"),
                     F.sum("n").cast("double").alias("all"))
    scored = per.select("hits", "all", F.transform("_r", lambda r: F.struct(
        r["label"].alias("label"), _ratio(r["tp"], r["predicted"]).alias("precision"),
        _ratio(r["tp"], r["support"]).alias("recall"),
        _ratio(2 * r["tp"], r["predicted"] + r["support"]).alias("f1"),
        r["support"].alias("support"))).alias("_r"))

    def mean(field, weighted):
        total = F.aggregate("_r", F.lit(0.0), lambda acc, r: acc + r["support"])
        value = F.aggregate("_r", F.lit(0.0), lambda acc, r: acc + (
            r[field] * r["support"] if weighted else r[field]))
        return _ratio(value, total) if weighted else value / len(labels)
    support = F.aggregate("_r", F.lit(0.0), lambda acc, r: acc + r["support"])
    accuracy = _ratio(F.col("hits"), F.col("all"))

    def summary(name, values):
        return F.struct(F.lit(name).alias("label"), *[
            v.alias(k) for k, v in zip(("precision", "recall", "f1"), values)],
            support.alias("support"))
    extra = F.array(summary("accuracy", [accuracy] * 3),
                    summary("macro avg", [mean(f, False) for f in ("precision", "recall", "f1")]),
                    summary("weighted avg", [mean(f, True) for f in ("precision", "recall", "f1")]))
    return (scored.select(F.inline(F.concat("_r", extra)))
            .withColumn("support", F.col("support").cast("bigint")))


def quadratic_kappa(df: DataFrame, truth: str, pred: str, labels: list[int]) -> DataFrame:
    """Cohen's kappa with squared weights.

    With squared weights the expected disagreement needs only sums and sums of squares of
    the two label positions, so one global aggregation is enough.
    """
    counts = confusion_counts(df, truth, pred)
    t = fc.ordinal_code("truth", labels).cast("double")
    p = fc.ordinal_code("pred", labels).cast("double")
    n = F.col("n")
    s = counts.agg(F.sum(n).cast("double").alias("n"), F.sum(n * (t - p) * (t - p)).alias("d"),
                   F.sum(n * t).alias("t"), F.sum(n * p).alias("p"),
                   F.sum(n * t * t).alias("tt"), F.sum(n * p * p).alias("pp"))
    expected = F.col("tt") + F.col("pp") - 2 * F.col("t") * F.col("p") / F.col("n")
    return s.select((1 - F.col("d") / F.nullif(expected, F.lit(0.0))).alias("kappa"))


def scores(df: DataFrame, truth: str, pred: str, labels: list[int]) -> DataFrame:
    """One row: accuracy, macro F1, weighted F1, quadratic kappa."""
    report = class_report(df, truth, pred, labels)
    kappa = quadratic_kappa(df, truth, pred, labels).scalar()
    pick = lambda name: F.max(F.when(F.col("label") == name, F.col("f1")))
    return report.agg(pick("accuracy").alias("accuracy"), pick("macro avg").alias("macro_f1"),
                      pick("weighted avg").alias("weighted_f1")).withColumn("kappa", kappa)


def majority_prediction(train: DataFrame, test: DataFrame, truth: str, into: str = "pred") -> DataFrame:
    """Predict the most frequent class of ``train`` (the smallest among equals) everywhere."""
    counts = train.groupBy(truth).agg(F.count(F.lit(1)).alias("n")).filter(F.col(truth).isNotNull())
    top = counts.agg(F.max(F.struct("n", (-F.col(truth)).alias("neg"))).alias("m"))
    return test.withColumn(into, (-top.select("m.neg").scalar()).cast("int"))


def majority_baseline(train: DataFrame, test: DataFrame, truth: str, labels: list[int]) -> DataFrame:
    return scores(majority_prediction(train, test, truth), truth, "pred", labels)


def speed_rule_baseline(df: DataFrame, truth: str, speed: str, labels: list[int]) -> DataFrame:
    return scores(df.withColumn("pred", fc.speed_rule(speed)), truth, "pred", labels)


def false_negatives(df: DataFrame, truth: str, pred: str, severe: int) -> DataFrame:
    """Rows of the severe class by predicted class, with the share of all severe rows."""
    counts = confusion_counts(df, truth, pred).filter(F.col("truth") == severe)
    return counts.select("pred", "n", (F.col("n") / F.sum("n").over(W.partitionBy("truth"))).alias("share"))


def recall_change(before: DataFrame, after: DataFrame, truth: str, pred: str,
                  labels: list[int]) -> DataFrame:
    """Recall per label of two predictions and the difference."""
    a = class_report(before, truth, pred, labels).select("label", F.col("recall").alias("before"))
    b = class_report(after, truth, pred, labels).select("label", F.col("recall").alias("after"))
    keep = [str(c) for c in labels]
    return (a.join(b, "label").filter(F.col("label").isin(keep))
            .withColumn("change", F.col("after") - F.col("before")))


# ---- precision-recall ----------------------------------------------------------------
def _score_counts(df: DataFrame, positives: dict[str, Column], score: dict[str, Column]) -> DataFrame:
    """(class, score, n, pos): rows per distinct score, one-vs-rest."""
    parts = F.array(*[F.struct(F.lit(k).alias("class"), score[k].cast("double").alias("score"),
                               F.coalesce(positives[k], F.lit(False)).cast("int").alias("hit"))
                      for k in positives])
    cells = df.select(F.inline(parts)).filter(F.col("score").isNotNull())
    return cells.groupBy("class", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("pos"))


def pr_points(df: DataFrame, positives: dict[str, Column], score: dict[str, Column]) -> DataFrame:
    """Precision and recall at every distinct score, per class.

    Equal scores are one point.  Running sums go over score ranges with offsets, not
    over one sorted list.
    """
    counts = _score_counts(df, positives, score)
    totals = counts.groupBy("class").agg(F.sum("pos").alias("_p"))
    run = running_sums(counts, ["class"], "score", ["n", "pos"], descending=True)
    run = run.join(F.broadcast(totals), "class")   # one row per class
    return run.select("class", "score", F.col("pos_cum").cast("bigint").alias("tp"),
                      F.col("n_cum").cast("bigint").alias("predicted"), "pos",
                      (F.col("pos_cum") / F.col("n_cum")).alias("precision"),
                      (F.col("pos_cum") / F.nullif("_p", F.lit(0))).alias("recall"), F.col("_p").alias("positives"))


def average_precision(points: DataFrame) -> DataFrame:
    """Sum over the points of the recall step times the precision."""
    step = F.col("pos") / F.nullif(F.col("positives"), F.lit(0))
    return points.groupBy("class").agg(F.coalesce(F.sum(step * F.col("precision")), F.lit(0.0))
                                       .alias("average_precision"))


def class_pr(df: DataFrame, truth: str, class_scores: dict[int, Column]) -> DataFrame:
    """One-vs-rest points for classes whose scores may be probabilities or decision values."""
    return pr_points(df, {str(c): F.col(truth) == c for c in class_scores},
                     {str(c): s for c, s in class_scores.items()})


# ---- threshold pairs -------------------------------------------------------------------
def threshold_grid(df: DataFrame, truth: str, p_injured: str, p_severe: str,
                   grid_injured: list[float], grid_severe: list[float],
                   weights: tuple[float, float, float] = (0.2, 0.4, 0.4)) -> DataFrame:
    """Weighted per-class F1 and severe recall for every pair of thresholds.

    A row matters only through how many thresholds each score reaches, so rows are
    counted by that pair of numbers; the pairs of thresholds then follow by running sums
    over the small count table.  No row meets a grid point.
    """
    g1, g2 = sorted(grid_injured), sorted(grid_severe)

    def reached(score, grid):
        return F.size(F.filter(F.array(*[F.lit(float(g)) for g in grid]), lambda t: t <= F.col(score)))
    counts = (df.filter(F.col(truth).isNotNull())
              .groupBy(F.col(truth).cast("int").alias("y"), reached(p_injured, g1).alias("a"),
                       reached(p_severe, g2).alias("b")).agg(F.count(F.lit(1)).alias("n")))
    # Complete the grid so that every pair of thresholds has a row to read from.
    empty = (counts.sparkSession.range(1)
             .select(F.explode(F.sequence(F.lit(0), F.lit(len(g1)))).alias("a"))
             .select("a", F.explode(F.sequence(F.lit(0), F.lit(len(g2)))).alias("b"))
             .select(F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("y"), "a", "b",
                     F.lit(0).cast("bigint").alias("n")))
    full = counts.unionByName(empty).groupBy("y", "a", "b").agg(F.sum("n").alias("n"))
    down_b = W.partitionBy("y", "a").orderBy(F.desc("b")).rowsBetween(W.unboundedPreceding, 0)
    down_a = W.partitionBy("y", "b").orderBy(F.desc("a")).rowsBetween(W.unboundedPreceding, 0)
    full = full.withColumn("_row", F.sum("n").over(down_b))        # b reached, this a
    full = full.withColumn("both", F.sum("_row").over(down_a))     # a and b reached
    full = full.withColumn("_col", F.sum("n").over(W.partitionBy("y", "a")))
    full = full.withColumn("injured", F.sum("_col").over(down_a))  # a reached
    full = full.withColumn("total", F.sum("n").over(W.partitionBy("y")))

    def of(y, name):
        return F.coalesce(F.max(F.when(F.col("y") == y, F.col(name))), F.lit(0)).alias(f"{name}{y}")
    t = (full.filter((F.col("a") > 0) & (F.col("b") > 0)).groupBy("a", "b")
         .agg(*[of(y, k) for y in range(3) for k in ("both", "injured", "total")]))
    tp = {0: F.col("total0") - F.col("injured0"), 1: F.col("injured1") - F.col("both1"),
          2: F.col("both2")}
    said = {0: sum((F.col(f"total{y}") - F.col(f"injured{y}") for y in range(3)), F.lit(0)),
            1: sum((F.col(f"injured{y}") - F.col(f"both{y}") for y in range(3)), F.lit(0)),
            2: sum((F.col(f"both{y}") for y in range(3)), F.lit(0))}
    f1 = [_ratio(2.0 * tp[y], said[y] + F.col(f"total{y}")) for y in range(3)]
    score = reduce(lambda x, y: x + y, [F.lit(w) * v for w, v in zip(weights, f1)])
    at = lambda grid, c: F.element_at(F.array(*[F.lit(float(g)) for g in grid]), F.col(c))
    return t.select(at(g1, "a").alias("t_injured"), at(g2, "b").alias("t_severe"),
                    score.alias("score"), _ratio(1.0 * tp[2], F.col("total2")).alias("recall_severe"))


def best_thresholds(grid: DataFrame, min_recall: float = 0.5) -> DataFrame:
    """First best pair of the grid with enough severe recall."""
    return (grid.filter(F.col("recall_severe") >= min_recall)
            .orderBy(F.desc("score"), "t_injured", "t_severe").limit(1))


def best_per_group(df: DataFrame, group: str, score: str, ties: list[Column]) -> DataFrame:
    from kerbside.operators.ordered import first_per_key
    return first_per_key(df, [group], [F.col(score).desc_nulls_last(), *ties])


def evaluate_model(scored: DataFrame, train: DataFrame, truth: str, labels: list[int],
                   probability: str | None = "probability", pred: str = "prediction") -> dict[str, DataFrame]:
    """Baseline, scores, report, confusion matrix and, with probabilities, PR curves.

    ``scored`` is cached by the caller: every table is one pass over it.
    """
    out = {
        "baseline": majority_baseline(train, scored.drop("pred"), truth, labels),
        "scores": scores(scored, truth, pred, labels),
        "report": class_report(scored, truth, pred, labels),
        "confusion": confusion_matrix(scored, truth, pred, labels),
    }
    if probability:
        from pyspark.ml.functions import vector_to_array
        kind = dict(scored.dtypes)[probability]
        p = vector_to_array(probability) if kind == "vector" else F.col(probability)
        points = class_pr(scored, truth, {c: p[i] for i, c in enumerate(labels)})
        out |= {"pr_points": points, "average_precision": average_precision(points)}
    return out


def as_long(parts: dict[str, DataFrame]) -> DataFrame:
    """The tables of ``evaluate_model`` as one: (part, row, col, value).

    Curve points are named by the number of rows predicted at them.
    """
    def cells(part: str, df: DataFrame, row: Column, col: Column | None, values: list[str]) -> DataFrame:
        made = F.array(*[F.struct((F.lit(v) if col is None else col.cast("string")).alias("col"), F.col(v).cast("double").alias("value"))
                         for v in values])
        return df.select(F.lit(part).alias("part"), row.cast("string").alias("row"), F.inline(made))

    out = []
    for part, df in parts.items():
        if part in ("baseline", "scores"):
            out.append(cells(part, df, F.lit("all"), None, ["accuracy", "macro_f1", "weighted_f1", "kappa"]))
        elif part == "report":
            out.append(cells(part, df, F.col("label"), None, ["precision", "recall", "f1", "support"]))
        elif part == "confusion":
            out += [cells(f"confusion_{v}", df, F.col("truth"), F.col("pred"), [v]) for v in ("n", "share_of_truth", "share_of_pred")]
        elif part == "pr_points":
            out += [cells(v, df, F.col("class"), F.col("predicted"), [v]) for v in ("precision", "recall")]
        else:
            out.append(cells(part, df, F.col("class"), None, ["average_precision"]))
    return reduce(lambda a, b: a.unionByName(b), out)
