"""Linear fits that share their passes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerline.operators import linear_fits as lf
from ledgerline.operators import models as md

FEATURES = ["a", "b", "flat", "wide"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2_000, 4)) * [1, 0.2, 0, 300] + [0, 5, 2, 1_000]
    y = (x[:, 0] + 2 * (x[:, 1] - 5) + 0.001 * (x[:, 3] - 1_000) + rng.normal(size=2_000) * 0.5 > 0.4).astype(int)
    return pd.DataFrame(x, columns=FEATURES).assign(y=y, id=np.arange(2_000))


@pytest.fixture(scope="module")
def rows(spark, pdf):
    return spark.createDataFrame(pdf).repartition(5).cache()


def objective(pdf, loss, weights, c, w, b):
    x, y = pdf[FEATURES].to_numpy(), pdf["y"].to_numpy()
    z, weight = x @ w + b, np.where(y == 1, weights[1], weights[0])
    each = np.logaddexp(0, z) - y * z if loss == lf.LOGISTIC else np.maximum(1 - (2 * y - 1) * z, 0)
    return (weight @ each) / weight.sum() + w @ w / (2 * c * weight.sum())


@pytest.mark.parametrize("loss, library", [(lf.LOGISTIC, LogisticRegression), (lf.HINGE, LinearSVC)])
def test_fits_are_as_good_as_the_library(rows, pdf, loss, library):
    """Every penalty and fold reaches the minimum of the same function, features of any scale and a constant one included."""
    with md._fold_blocks(rows, FEATURES, "y", "id", 3) as (folded, blocks, moments, weights):
        own = folded.toPandas()
        assert moments.n.sum() == 2_000
        fits = [(c, [f for f in range(3) if f != held]) for c in (0.01, 1.0) for held in range(3)]
        found = lf.fit_linear(blocks, moments, loss, weights, fits, 200)
        for (c, folds), (w, b) in list(zip(fits, found))[1::3]:
            part = own[own[md.FOLD].isin(folds)]
            total = np.where(part["y"] == 1, weights[1], weights[0]).sum()
            train = folded.where(F.col(md.FOLD).isin(folds)).withColumn(md.WEIGHT, md.weight_column("y", weights))
            made = VectorAssembler(inputCols=FEATURES, outputCol=md.FEATURES).transform(train)
            theirs = library(featuresCol=md.FEATURES, labelCol="y", weightCol=md.WEIGHT, maxIter=200, regParam=1 / (c * total), standardization=False).fit(made)
            best = objective(part, loss, weights, c, theirs.coefficients.toArray(), theirs.intercept)
            assert objective(part, loss, weights, c, w, b) <= best * (1 + 1e-5)


def test_sigmoids_equal_the_library(rows):
    with md._fold_blocks(rows, FEATURES, "y", "id", 3) as (folded, blocks, moments, _):
        margins = [(held, np.array([1.0, 2.0 * held, 0.5, 0.001]), -1.0) for held in range(3)]
        for (held, w, b), found in zip(margins, lf.fit_sigmoids(blocks, moments, margins)):
            margin = folded.where(F.col(md.FOLD) == held).select("y", md.linear_margin(FEATURES, w, b).alias("margin"))
            assert found == pytest.approx(md.sigmoid(margin, "y"), rel=1e-3, abs=1e-3)


def test_models_of_the_library_score_alike(rows):
    table, model = md.cross_validate_logistic(rows, FEATURES, "y", "id", cs=(0.1, 1.0), max_iter=50)
    w, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    scored = md.predict(model, rows, FEATURES).withColumn("own", 1 / (1 + F.exp(-md.linear_margin(FEATURES, w, b))))
    assert scored.agg(F.max(F.abs(F.col("own") - F.col("score")))).first()[0] < 1e-12
    assert [r["c"] for r in table] == [0.1, 1.0]


def _passes(monkeypatch, ask):
    counted, add = [], lf.added
    with monkeypatch.context() as m:
        m.setattr(lf, "added", lambda *a: counted.append(1) or add(*a))
        ask()
    return len(counted)


def test_more_penalties_share_the_passes(rows, monkeypatch):
    """Six fits instead of three are not twice as many passes, and no fit keeps rows of its own."""
    monkeypatch.setattr(LogisticRegression, "fit", None)
    monkeypatch.setattr(LinearSVC, "fit", None)
    for ask in (
        lambda cs: md.cross_validate_logistic(rows, FEATURES, "y", "id", cs=cs, max_iter=50),
        lambda cs: md.fit_calibrated_svms(rows, FEATURES, "y", "id", cs, max_iter=50),
    ):
        one, two = (_passes(monkeypatch, lambda cs=cs: ask(cs)) for cs in ([1.0], [1.0, 0.9]))
        assert 3 < two < 1.5 * one


def test_vectors_are_fitted_by_the_library(rows):
    """A column of vectors may be wide and sparse: it is not made into arrays."""
    vectors = VectorAssembler(inputCols=["b", "wide"], outputCol="v").transform(rows)
    table, model = md.cross_validate_logistic(vectors, ["a", "v"], "y", "id", cs=(1.0,), max_iter=30)
    assert table[0]["mean_auc"] == pytest.approx(md.cross_validate_logistic(rows, ["a", "b", "wide"], "y", "id", cs=(1.0,), max_iter=30)[0][0]["mean_auc"], abs=1e-4)
    assert len(md.fit_calibrated_svm(vectors, ["a", "v"], "y", "id", max_iter=3).folds) == 3


def test_missing_values_are_refused(rows):
    with pytest.raises(Exception, match="NULL or NaN"):
        md.cross_validate_logistic(rows.withColumn("a", F.when(F.col("id") > 0, F.col("a"))), FEATURES, "y", "id", cs=(1.0,))


@pytest.mark.parametrize("limits", [{}, {"RANGE_ROWS": 50, "TASK_SCORES": 300}, {"RANGE_ROWS": 3, "SAMPLE": 40}])
def test_aucs_equal_the_ranking(rows, monkeypatch, limits):
    """Whatever the ranges; the second margin has few distinct scores, the third one alone."""
    for name, value in limits.items():
        monkeypatch.setattr(lf, name, value)
    few = rows.withColumn("b", F.round("b"))
    with md._fold_blocks(few, FEATURES, "y", "id", 3) as (folded, blocks, moments, _):
        margins = [(0, np.array([1.0, 2.0, 0.5, 0.001]), -1.0), (1, np.array([0.0, 1.0, 0.0, 0.0]), -5.0), (2, np.zeros(4), 0.3), (0, np.array([-1.0, 0.0, 0.0, 0.0]), 0.0)]
        for (held, w, b), found in zip(margins, lf.aucs(blocks, moments, margins)):
            scored = folded.where(F.col(md.FOLD) == held).select("y", (1 / (1 + F.exp(-md.linear_margin(FEATURES, w, b)))).alias("score"))
            assert found == pytest.approx(md.ranking_metrics(scored, "score", "y").first()["auc_roc"], abs=1e-9)
