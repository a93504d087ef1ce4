from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerline.operators import evaluate as ev


def brute_curve(y, s):
    """Thresholds from high to low with positives and negatives at or above each."""
    thresholds = np.array(sorted(set(s), reverse=True))
    tp = np.array([((s >= t) & (y == 1)).sum() for t in thresholds])
    fp = np.array([((s >= t) & (y == 0)).sum() for t in thresholds])
    return thresholds, tp, fp


def scores(kind, n=600, seed=0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    s = y * 0.3 + rng.random(n)
    if kind == "tied":
        s = np.round(s, 1)
    if kind == "hot":
        s[rng.random(n) < 0.4] = 0.5
    return y, s


@pytest.fixture(params=["fine", "tied", "hot"])
def case(request, spark):
    y, s = scores(request.param)
    return y, s, spark.createDataFrame(pd.DataFrame({"y": y, "s": s})).repartition(3)


BUCKETS = pytest.mark.parametrize("rows_per_bucket", [40, 10**9])


@BUCKETS
def test_ranking_metrics(case, rows_per_bucket):
    y, s, df = case
    got = ev.ranking_metrics(df, "s", "y", rows_per_bucket=rows_per_bucket).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    thresholds, tp, fp = brute_curve(y, s)
    recall = tp / tp[-1]
    ap = np.sum(np.diff(np.r_[0, recall]) * tp / (tp + fp))
    assert got["auc_roc"] == pytest.approx(auc) and got["auc_pr"] == pytest.approx(ap)
    assert got["ks"] == pytest.approx(max(0, (recall - fp / fp[-1]).max()))
    vectors = df.select(F.col("y").cast("double").alias("label"), F.col("s").alias("rawPrediction"))
    assert got["auc_roc"] == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(vectors))


def test_monotone_change_of_score_keeps_the_ranking(case):
    _, _, df = case
    before = ev.ranking_metrics(df, "s", "y").first()
    after = ev.ranking_metrics(df.withColumn("s", F.exp("s") * 3 - 7), "s", "y").first()
    assert before["auc_roc"] == pytest.approx(after["auc_roc"]) and before["auc_pr"] == pytest.approx(after["auc_pr"])


@BUCKETS
@pytest.mark.parametrize("corners", [False, True])
def test_roc_points(case, rows_per_bucket, corners):
    y, s, df = case
    got = ev.roc_points(df, "s", "y", corners, rows_per_bucket).orderBy(F.desc("threshold")).collect()
    thresholds, tp, fp = brute_curve(y, s)
    if corners:
        keep = np.r_[True, (np.diff(fp, 2) != 0) | (np.diff(tp, 2) != 0), True]
        thresholds, tp, fp = thresholds[keep], tp[keep], fp[keep]
    expected = [(float("inf"), 0.0, 0.0)] + list(zip(thresholds, fp / (y == 0).sum(), tp / (y == 1).sum()))
    assert [tuple(r) for r in got] == [tuple(map(float, e)) for e in expected]


@BUCKETS
def test_precision_recall_points(case, rows_per_bucket):
    y, s, df = case
    got = ev.precision_recall_points(df, "s", "y", rows_per_bucket).collect()
    thresholds, tp, fp = brute_curve(y, s)
    expected = {(float(t), a / (a + b), a / tp[-1]) for t, a, b in zip(thresholds, tp, fp)} | {(None, 1.0, 0.0)}
    assert {(r["threshold"], r["precision"], r["recall"]) for r in got} == expected
    assert all(r["prior"] == pytest.approx(y.mean()) for r in got)


def test_youden(case):
    y, s, df = case
    got = ev.at_youden(df, "s", "y").first()
    thresholds, tp, fp = brute_curve(y, s)
    best = int((tp / tp[-1] - fp / fp[-1]).argmax())
    assert (got["threshold"], got["tp"], got["fp"]) == (thresholds[best], tp[best], fp[best])
    assert got["recall"] == pytest.approx(tp[best] / tp[-1])


def test_useless_score_flags_nobody(rows):
    df = rows([(1, 0.1), (0, 0.9)], "y int, s double")
    got = ev.at_youden(df, "s", "y").first()
    assert got["threshold"] == float("inf") and (got["tp"], got["fp"], got["recall"]) == (0, 0, 0.0)


def test_sweep_equals_one_threshold_at_a_time(case):
    y, s, df = case
    thresholds = ev.sweep_thresholds()
    assert len(thresholds) == 91 and thresholds[0] == 0.05 and thresholds[-1] == 0.95
    got = {r["threshold"]: r for r in ev.threshold_sweep(df, "s", "y", thresholds).collect()}
    assert sorted(got) == thresholds
    for t in thresholds:
        r = got[t]
        expected = [((s >= t) & (y == 1)).sum(), ((s >= t) & (y == 0)).sum(), ((s < t) & (y == 1)).sum(), ((s < t) & (y == 0)).sum()]
        assert [r["tp"], r["fp"], r["fn"], r["tn"]] == expected
        assert r["flagged"] == pytest.approx((s >= t).mean())


def test_evaluate_is_consistent_with_its_parts(case):
    _, _, df = case
    got = ev.evaluate(df, "s", "y", 0.6).first()
    at = ev.metrics_at(df, "s", "y", 0.6).first()
    ranked = ev.ranking_metrics(df, "s", "y").first()
    assert all(got[c] == pytest.approx(at[c]) for c in ("accuracy", "precision", "recall", "f1"))
    assert all(got[c] == pytest.approx(ranked[c]) for c in ("auc_roc", "auc_pr", "ks"))


def test_one_class_gives_null_or_zero(rows):
    df = rows([(0, 0.2), (0, 0.8), (None, 0.5), (0, None)], "y int, s double")
    got = ev.ranking_metrics(df, "s", "y").first()
    assert (got["auc_roc"], got["auc_pr"], got["ks"]) == (None, None, None)
    at = ev.metrics_at(df, "s", "y", 0.5).first()
    assert (at["tp"], at["fp"], at["fn"], at["tn"]) == (0, 1, 0, 1)
    assert (at["precision"], at["recall"], at["f1"], at["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_operating_point(rows):
    roc = rows([(float("inf"), 0.0, 0.0), (0.9, 0.1, 0.5), (0.4, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    assert tuple(ev.operating_point(roc, 0.5).first())[1:] == (1.0, 1.0)
    assert tuple(ev.operating_point(roc, 0.9).first())[1:] == (0.1, 0.5)
    assert tuple(ev.operating_point(roc, 0.1).first())[1:] == (1.0, 1.0)


@BUCKETS
def test_groups_are_ranked_apart(case, rows_per_bucket):
    _, _, df = case
    both = df.withColumn("g", F.lit("a")).unionByName(df.withColumn("g", F.lit("b")).withColumn("s", -F.col("s")))
    got = {r["g"]: r["auc_roc"] for r in ev.ranking_metrics(both, "s", "y", ["g"], rows_per_bucket).collect()}
    alone = ev.ranking_metrics(df, "s", "y").first()["auc_roc"]
    assert got["a"] == pytest.approx(alone) and got["b"] == pytest.approx(1 - alone)


def test_normalized_confusion(case):
    y, s, df = case
    got = ev.normalized_confusion(df, "s", "y", 0.5).collect()
    assert len(got) == 4
    for actual in (0, 1):
        assert sum(r["pct"] for r in got if r["actual"] == actual) == pytest.approx(100)


def test_comparison_orders_by_the_metric(rows):
    a = rows([("x", 0.7)], "model string, val_auc_roc double")
    b = rows([("y", 0.8, 0.1)], "model string, val_auc_roc double, val_ks double")
    assert [r["model"] for r in ev.comparison(a, b).collect()] == ["y", "x"]
