from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import evaluate as ev
from ledgerline.operators import models as md
from ledgerline.operators import neighbors

FEATURES = ["a", "b", "noise"]


def planted(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=n) * 0.5 > 1.2).astype(int)
    pdf = pd.DataFrame(x, columns=FEATURES).assign(y=y, id=np.arange(n))
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="module")
def data(spark):
    return planted(spark, 1_500, 0), planted(spark, 600, 1)


def test_class_weights():
    assert md.class_weights(80, 20, "balanced") == (100 / 160, 100 / 40)
    assert md.class_weights(80, 20, "ratio") == (1.0, 4.0)
    assert md.class_weights(80, 20, "inverse") == (1.25, 5.0)
    assert md.class_weights(5, 0, "balanced") == (1.0, 1.0)


def test_logistic_minimises_the_weighted_penalised_loss(spark, data):
    """Gradient of 0.5 |w|^2 + C * sum(weight * loss) is 0 at the fitted coefficients."""
    train, _ = data
    c = 0.05
    model = md.fit_logistic(train, FEATURES, "y", c=c)
    w, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    pdf = train.toPandas()
    x, y = pdf[FEATURES].to_numpy(), pdf["y"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    residual = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    assert np.abs(w + c * x.T @ residual).max() < 1e-2 and abs(residual.sum()) < 1e-1


@pytest.mark.parametrize(
    "fit", [md.fit_logistic, lambda *a: md.fit_tree(*a, max_depth=6), lambda *a: md.fit_boosted(*a, trees=8, max_depth=4, row_share=0.8, column_share=0.8)]
)
def test_models_find_the_planted_signal(data, fit):
    train, val = data
    fitted = md.fit_and_score("m", "baseline", fit, train, val, FEATURES, "y")
    assert fitted.metrics["auc_roc"] > 0.75 and fitted.seconds > 0


def test_search_selection_and_runs(spark, data, tmp_path):
    train, val = data
    space = {"max_depth": md.whole(1, 6), "criterion": md.choice("gini", "entropy")}
    assert md.draw(space, 5, seed=7) == md.draw(space, 5, seed=7) != md.draw(space, 5, seed=8)
    found = md.search("Tree", md.tree, space, train, val, FEATURES, "y", trials=3)
    assert found.metrics["auc_roc"] == pytest.approx(max(t["auc"] for t in found.trials))
    base = md.fit_and_score("Logit", "baseline", md.fit_logistic, train, val, FEATURES, "y")
    assert md.best_tuned([base, found]) is found
    results = md.results_table(spark, [base, found])
    assert md.best_model_row(results).first()["model"] == "Tree"
    for _ in range(2):
        md.append_runs(spark, [base, found], str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.count() == 4 and runs.filter("is_best").select("run_name").distinct().first()[0] == "Tree_BEST"
    md.save_model(found.model, str(tmp_path / "model"))
    again = md.validation_metrics(md.load_model(str(tmp_path / "model")), val, "y")
    assert again == found.metrics
    importance = md.feature_importance(found.model, FEATURES).collect()
    assert {r["feature"] for r in importance[:2]} == {"a", "b"}


def test_cross_validation(data):
    train, val = data
    table, model = md.cross_validate_logistic(train, FEATURES, "y", "id", cs=(0.01, 1.0), max_iter=30)
    assert [r["c"] for r in table] == [0.01, 1.0] and all(0.7 < r["mean_auc"] < 1 and r["std_auc"] >= 0 for r in table)
    assert md.validation_metrics(model, val, "y")["auc_roc"] > 0.75


def test_calibrated_svm_gives_probabilities(data):
    train, val = data
    model = md.fit_calibrated_svm(train, FEATURES, "y", "id", c=1.0, max_iter=10)
    scored = model.predict(val, ["y"])
    row = scored.agg(F.min("score"), F.max("score"), F.avg("score"), F.avg("y")).first()
    assert 0 < row[0] < row[1] < 1 and row[2] == pytest.approx(row[3], abs=0.08)
    assert len(model.folds) == 3
    assert ev.ranking_metrics(scored, "score", "y").first()["auc_roc"] > 0.75


def test_ablation_and_split_metrics(data):
    train, val = data
    rows = md.ablation(train, val, ["noise"], ["a", "b"], "y").collect()
    assert rows[0]["delta"] == 0.0 and rows[1]["delta"] > 0.2
    model = md.fit_logistic(train, FEATURES, "y")
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    got = {r["split"]: r["auc_roc"] for r in md.split_metrics(model, both, "y", "split").collect()}
    assert got["val"] == pytest.approx(md.validation_metrics(model, val, "y")["auc_roc"])


@pytest.mark.parametrize("block_rows", [37, 10_000])
@pytest.mark.parametrize("skip_self", [False, True])
def test_neighbors_equal_brute_force(spark, block_rows, skip_self):
    rng = np.random.default_rng(0)
    train = np.round(rng.normal(size=(150, 5)), 1)
    train[100:] = train[:50]  # equal vectors, so that ids decide
    query = train[::3]
    frame = lambda x, ids: spark.createDataFrame(
        [(int(i), [float(v) for v in r], int(i % 2)) for i, r in zip(ids, x)], "id bigint, v array<float>, y int"
    )
    ids, q_ids = np.arange(150), np.arange(150)[::3]
    got = neighbors.nearest_neighbors(frame(query, q_ids), frame(train, ids), "id", "v", "y", 7, skip_self, block_rows)
    actual = {}
    for r in got.collect():
        actual.setdefault(r["id"], {})[r["rank"]] = r["neighbor"]
    x32, q32 = train.astype("float32").astype(float), query.astype("float32").astype(float)
    for i, q in zip(q_ids, q32):
        d = np.sqrt(((x32 - q) ** 2).sum(axis=1))
        if skip_self:
            d[i] = np.inf
        order = np.lexsort((ids, d))[:7]
        assert [actual[i][k + 1] for k in range(7)] == list(order)
    score = {r["id"]: r["score"] for r in neighbors.neighbor_score(got, "id", "y").collect()}
    assert all(0 <= v <= 1 for v in score.values()) and len(score) == 50


def test_folds_hold_equal_shares_of_each_class(spark):
    rows = spark.range(1_000).select("id", (F.col("id") % 50 == 0).cast("int").alias("y"))
    drawn = rows.select("id", "y", md.fold_draw("id"))
    counts = md.with_fold(drawn, "y", 3).groupBy("y", md.FOLD).count().collect()
    sizes = {y: sorted(r["count"] for r in counts if r["y"] == y) for y in (0, 1)}
    assert sizes == {0: [326, 327, 327], 1: [6, 7, 7]}
    one_class = md.with_fold(drawn.filter("y = 0"), "y", 3)
    assert one_class.select(md.FOLD).distinct().count() == 3
