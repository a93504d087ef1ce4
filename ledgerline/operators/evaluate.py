"""Scores of a binary model, computed from the histogram of its scores.

``score`` is the predicted probability (or any number that rises with it), ``label`` is 0/1.
Rows without a score or label are left out. ``by`` evaluates several models or splits in the
same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.ordering import BUCKET, ROWS_PER_BUCKET, range_splits, running_sums, with_range_bucket
from ledgerline.operators.ranking import stack_tables
from ledgerline.session import stored

COUNTS = ("tp", "fp", "fn", "tn")


def scored(df: DataFrame, score: str, label: str) -> DataFrame:
    """The rows that count: with a label, and a score that is neither NULL nor NaN. Infinite scores count."""
    return df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())


def score_histogram(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., threshold, pos, neg)``: one row per distinct score."""
    y = F.col(label).cast("bigint")
    return (
        scored(df, score, label)
        .groupBy(*by, F.col(score).cast("double").alias("threshold"))
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )


def score_splits(df: DataFrame, score: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    return range_splits(df.select(F.col(score).cast("double").alias("threshold")), "threshold", rows_per_bucket)


def score_curve(
    df: DataFrame,
    score: str,
    label: str,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    splits: Sequence[float] | None = None,
) -> DataFrame:
    """The histogram with counts of positives and negatives at or above each score, and class totals."""
    return running_sums(
        score_histogram(df, score, label, by),
        "threshold",
        {"tp": "pos", "fp": "neg"},
        score_splits(df, score, rows_per_bucket) if splits is None else splits,
        descending=True,
        by=by,
        totals={"n_pos": "pos", "n_neg": "neg"},
    )


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _tpr() -> Column:
    return _div(F.col("tp"), F.col("n_pos"))


def _fpr() -> Column:
    return _div(F.col("fp"), F.col("n_neg"))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Metrics of a confusion table; 0 where a denominator is 0."""
    zero = F.lit(0.0)
    return {
        "accuracy": _div(tp + tn, tp + fp + fn + tn),
        "precision": F.coalesce(_div(tp, tp + fp), zero),
        "recall": F.coalesce(_div(tp, tp + fn), zero),
        "f1": F.coalesce(_div(2 * tp, 2 * tp + fp + fn), zero),
    }


def _add_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(_rates(*[F.col(c) for c in COUNTS]))


def ranking_metrics(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """AUC-ROC (ties count half), average precision and KS; NULL where one class is absent."""
    return _ranking(score_curve(df, score, label, by, rows_per_bucket), by)


def counted_ranking(
    df: DataFrame, score: str, pos: str, neg: str, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``ranking_metrics`` of rows that stand for ``pos`` positives and ``neg`` negatives of one score each."""
    held = df.where(F.col(pos) + F.col(neg) > 0).groupBy(*by, F.col(score).cast("double").alias("threshold"))
    counts = stored(held.agg(F.sum(pos).alias("pos"), F.sum(neg).alias("neg")), "scores")
    splits = range_splits(counts, "threshold", rows_per_bucket)
    sums, totals = {"tp": "pos", "fp": "neg"}, {"n_pos": "pos", "n_neg": "neg"}
    return _ranking(running_sums(counts, "threshold", sums, splits, descending=True, by=by, totals=totals), by)


def _ranking(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    step = F.sum(F.col("pos") * _div(F.col("tp"), F.col("tp") + F.col("fp")))
    return curve.groupBy(*by).agg(
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        F.try_divide(area, F.max(F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc_roc"),
        F.try_divide(step, F.max("n_pos").cast("double")).alias("auc_pr"),
        F.max(_tpr() - _fpr()).alias("ks"),
    )


def confusion_at(df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """``(tp, fp, fn, tn)`` with a positive prediction at ``score >= threshold``."""
    flagged, y = F.col(score) >= threshold, F.col(label) == 1
    return scored(df, score, label).groupBy(*by).agg(
        F.count_if(flagged & y).alias("tp"),
        F.count_if(flagged & ~y).alias("fp"),
        F.count_if(~flagged & y).alias("fn"),
        F.count_if(~flagged & ~y).alias("tn"),
    )


def metrics_at(df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1."""
    return _add_rates(confusion_at(df, score, label, threshold, by))


def evaluate(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """One row: AUC-ROC, AUC-PR, KS, and accuracy, precision, recall, F1 at the threshold."""
    curve = score_curve(df, score, label)
    flagged = F.col("threshold") >= threshold
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    step = F.sum(F.col("pos") * _div(F.col("tp"), F.col("tp") + F.col("fp")))
    row = curve.agg(
        F.try_divide(area, F.max(F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc_roc"),
        F.try_divide(step, F.max("n_pos").cast("double")).alias("auc_pr"),
        F.max(_tpr() - _fpr()).alias("ks"),
        F.coalesce(F.sum(F.when(flagged, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(flagged, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~flagged, F.col("pos"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~flagged, F.col("neg"))), F.lit(0)).alias("tn"),
    )
    return _add_rates(row).select("auc_roc", "auc_pr", "ks", "accuracy", "precision", "recall", "f1")


def roc_points(
    df: DataFrame,
    score: str,
    label: str,
    drop_intermediate: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``(threshold, fpr, tpr)``, starting at (inf, 0, 0).

    ``drop_intermediate`` leaves out points on a straight line between their neighbours: those
    whose own step equals the following one.
    """
    splits = score_splits(df, score, rows_per_bucket)
    curve = score_curve(df, score, label, splits=splits)
    if drop_intermediate:
        curve = _keep_corners(curve, splits)
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(curve.select("threshold", _fpr().alias("fpr"), _tpr().alias("tpr")))


def _keep_corners(curve: DataFrame, splits: Sequence[float]) -> DataFrame:
    """First, last and every point after which the step changes."""
    step = F.struct("pos", "neg")
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    corner = first | F.col("_next").isNull() | (F.col("_next") != step)
    if not splits:
        following = F.lead(step).over(Window.orderBy(F.desc("threshold")))
        return curve.withColumn("_next", following).filter(corner).select(*curve.columns)
    cut = with_range_bucket(curve, "threshold", splits)
    # One row per range: the step that the next range (lower scores) starts with.
    heads = cut.groupBy(BUCKET).agg(F.max_by(step, "threshold").alias("head"))
    following = heads.select(BUCKET, F.lead("head").over(Window.orderBy(F.desc(BUCKET))).alias("_after"))
    within = Window.partitionBy(BUCKET).orderBy(F.desc("threshold"))
    marked = cut.join(F.broadcast(following), BUCKET).withColumn(
        "_next", F.coalesce(F.lead(step).over(within), "_after")
    )
    return marked.filter(corner).select(*curve.columns)


def precision_recall_points(
    df: DataFrame, score: str, label: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """``(threshold, precision, recall, prior)`` per score, closed by precision 1 at recall 0."""
    curve = score_curve(df, score, label, rows_per_bucket=rows_per_bucket)
    prior = _div(F.col("n_pos"), F.col("n_pos") + F.col("n_neg"))
    points = curve.select(
        "threshold",
        _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _tpr().alias("recall"),
        prior.alias("prior"),
    )
    y = F.col(label).cast("double")
    end = scored(df, score, label).agg(F.avg(y).alias("prior")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), "prior"
    )
    return points.unionByName(end)


def normalized_confusion(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """``(actual, predicted, n, pct)`` with the share within each actual class."""
    c = confusion_at(df, score, label, threshold)
    cell = lambda a, p, n, row: F.struct(
        F.lit(a).alias("actual"),
        F.lit(p).alias("predicted"),
        F.col(n).alias("n"),
        (F.coalesce(_div(F.col(n), row), F.lit(0.0)) * 100).alias("pct"),
    )
    negatives, positives = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return c.select(
        F.inline(
            F.array(
                cell(0, 0, "tn", negatives), cell(0, 1, "fp", negatives),
                cell(1, 0, "fn", positives), cell(1, 1, "tp", positives),
            )
        )
    )


def at_youden(df: DataFrame, score: str, label: str) -> DataFrame:
    """Threshold of the largest TPR - FPR (the highest such threshold) and the metrics there.

    If no threshold beats flagging nobody, the threshold is infinite.
    """
    curve = score_curve(df, score, label)
    j = _tpr() - _fpr()
    best = curve.agg(
        F.max_by(F.struct(j.alias("j"), "threshold", "tp", "fp"), F.struct(j, F.col("threshold"))).alias("best"),
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
    )
    useful = F.col("best.j") > 0
    counts = best.select(
        F.when(useful, F.col("best.threshold")).otherwise(float("inf")).alias("threshold"),
        F.when(useful, F.col("best.tp")).otherwise(0).alias("tp"),
        F.when(useful, F.col("best.fp")).otherwise(0).alias("fp"),
        "n_pos",
        "n_neg",
    )
    full = counts.withColumns({"fn": F.col("n_pos") - F.col("tp"), "tn": F.col("n_neg") - F.col("fp")})
    return _add_rates(full).select("threshold", *COUNTS, "accuracy", "precision", "recall", "f1")


def sweep_thresholds(first_percent: int = 5, last_percent: int = 95) -> list[float]:
    return [i / 100 for i in range(first_percent, last_percent + 1)]


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Confusion counts, metrics and flagged share at every threshold, from one pass.

    Each row falls between two thresholds; the counts per gap are then summed from above.
    """
    cuts = sorted(set(thresholds))
    known = scored(df, score, label).select(
        F.col(score).cast("double").alias("_s"), F.col(label).cast("bigint").alias("_y")
    )
    gaps = (
        Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_s", outputCol="_gap")
        .transform(known)
        .groupBy(F.col("_gap").cast("int").alias("_gap"))
        .agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    )
    # One row per threshold from here on; gap 0 lies below all of them.
    listed = [F.lit(None).cast("double"), *[F.lit(float(t)) for t in cuts]]
    every = df.sparkSession.range(1).select(F.posexplode(F.array(*listed)).alias("_gap", "threshold"))
    filled = every.join(F.broadcast(gaps), "_gap", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("_gap")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy("_gap").rowsBetween(Window.unboundedPreceding, -1)
    counts = filled.select(
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
    ).filter(F.col("threshold").isNotNull())
    flagged = _div(F.col("tp") + F.col("fp"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return _add_rates(counts).withColumn("flagged", flagged)


def operating_point(roc: DataFrame, threshold: float) -> DataFrame:
    """The first ROC point whose threshold is at most the given one, else the last point."""
    at_most = F.col("threshold") <= threshold
    point = F.struct("fpr", "tpr")
    found = roc.agg(
        F.max_by(F.when(at_most, point), F.when(at_most, F.col("threshold"))).alias("hit"),
        F.min_by(point, "threshold").alias("last"),
    )
    chosen = found.select(F.coalesce("hit", "last").alias("p"))
    return chosen.select(F.lit(threshold).alias("threshold"), F.col("p.fpr").alias("fpr"), F.col("p.tpr").alias("tpr"))


def comparison(results: DataFrame, *others: DataFrame, metric: str = "val_auc_roc") -> DataFrame:
    """Model rows of several sources in one table, best first."""
    return stack_tables([results, *others]).orderBy(F.desc_nulls_last(metric), "model")
