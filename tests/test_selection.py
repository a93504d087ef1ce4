"""Tree tables, the halving search, runs and versioned tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import models as md
from ledgerline.operators import neighbors, runs, selection
from ledgerline.operators.ensembles import TreeTable, importance, node_rows
from ledgerline.sources import old_versions, read_version, write_version

FEATURES = ["a", "b", "noise"]


def planted(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=n) * 0.5 > 1.2).astype(int)
    return spark.createDataFrame(pd.DataFrame(x, columns=FEATURES).assign(y=y, id=np.arange(n))).cache()


@pytest.fixture(scope="module")
def data(spark):
    return planted(spark, 1_200, 0), planted(spark, 500, 1)


@pytest.fixture(scope="module")
def boosted(data):
    return md.fit_boosted(data[0], FEATURES, "y", trees=12, max_depth=4, row_share=0.8)


def _scores(model, df):
    return {r["id"]: r["score"] for r in md.predict(model, df, ["id"]).collect()}


def test_tree_table_scores_like_the_model(spark, data, boosted, tmp_path):
    _, val = data
    for model in (boosted, md.fit_tree(data[0], FEATURES, "y", max_depth=6)):
        table = TreeTable.of(model, FEATURES)
        md.save_model(table, str(tmp_path / str(table.trees)))
        again = md.load_model(str(tmp_path / str(table.trees)))
        own, theirs = _scores(again, val), _scores(model, val)
        assert own.keys() == theirs.keys() and all(own[k] == pytest.approx(theirs[k], abs=1e-9) for k in own)
        shares = {r["feature"]: r["importance"] for r in importance(node_rows(model, FEATURES), FEATURES).collect()}
        assert [shares[f] for f in FEATURES] == pytest.approx(model.stages[-1].featureImportances.toArray().tolist(), abs=1e-9)
        assert table.importance(spark).count() == 3


def test_prefixes_are_the_shorter_ensembles(data, boosted):
    train, val = data
    table = TreeTable.of(boosted, FEATURES)
    staged = table.staged(val, ["id"], [1, 5, 12, 99]).collect()
    assert {r["trees"] for r in staged} == {1, 5, 12}
    for trees in (1, 5):
        expected = _scores(table.first(trees), val)
        assert {r["id"]: r["score"] for r in staged if r["trees"] == trees} == expected
    shorter = md.fit_boosted(train, FEATURES, "y", trees=5, max_depth=4, row_share=0.8)
    fitted = _scores(shorter, val)
    assert all(fitted[k] == pytest.approx(v, abs=1e-9) for k, v in _scores(table.first(5), val).items())


def test_rungs():
    assert [n for n, _ in selection.rungs(50)] == [50, 17, 6, 2] and selection.rungs(50)[-1][1] == 1.0
    assert selection.rungs(50)[0][1] == pytest.approx(1 / 27)
    assert selection.rungs(1) == [(1, 1.0)] and selection.rungs(9, 3) == [(9, 1 / 9), (3, 1 / 3), (1, 1.0)]


def test_halving_search_of_an_ensemble(data):
    train, val = data
    space = {"trees": md.whole(20, 40), "max_depth": md.whole(2, 4), "learning_rate": md.log_uniform(0.05, 0.3)}
    found = selection.halving_search("Boosted", md.boosted, space, train, val, FEATURES, "y", "id", trials=9, least_rows=400)
    assert isinstance(found.model, TreeTable) and found.model.trees == found.params["trees"] <= 40
    assert [sorted(t["rung"] for t in found.trials).count(r) for r in (0, 1, 2)] == [6, 2, 1]
    assert {t["rows"] for t in found.trials if t["rung"] == 2} == {1.0}
    assert all(t["rows"] == pytest.approx(400 / 1_200) and t["trees"] == 3 for t in found.trials if t["rung"] == 0)
    best = found.trials[found.params["trial"]]
    assert found.metrics["auc_roc"] == pytest.approx(best["auc"]) and best["auc"] > 0.8
    again = selection.halving_search("Boosted", md.boosted, space, train, val, FEATURES, "y", "id", trials=9, least_rows=400)
    assert [t["auc"] for t in again.trials] == [t["auc"] for t in found.trials]


def test_halving_search_of_a_tree_without_a_key(data):
    train, val = data
    found = selection.halving_search("Tree", md.tree, md.TREE_SPACE, train, val, FEATURES, "y", trials=4, scheme="balanced")
    assert "trees" not in found.params and found.metrics["auc_roc"] == pytest.approx(max(t["auc"] for t in found.trials if t["rung"] == 1))


def test_runs_are_kept_once_and_replaced_by_later_ones(spark, data, tmp_path):
    train, val = data
    path = str(tmp_path / "runs")
    model = md.fit_and_score("Logit", "baseline", md.fit_logistic, train, val, FEATURES, "y")
    for _ in range(3):
        runs.log_runs(md.runs_table(spark, [model]), path, "a")
    assert spark.read.parquet(path).count() == 1
    md.save_model(model.model, str(tmp_path / "model"))
    held = runs.holdout_run(spark, "Logit", str(tmp_path / "model"), val, "y", {"c": 1.0})
    runs.log_runs(held, path, "b")
    row = runs.latest_runs(spark, path).first()
    assert row["batch"] == "b" and row["params"] == {"c": "1.0"} and "val_auc_roc" not in row["metrics"]
    assert row["metrics"]["test_auc_roc"] == pytest.approx(model.metrics["auc_roc"])
    assert {"test_accuracy", "test_precision", "test_recall", "test_f1", "test_threshold", "test_ks", "test_auc_pr"} <= set(row["metrics"])


def test_a_stopped_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    write_version(spark.range(3), path)
    second = spark.range(5)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            write_version(second, path)
    assert read_version(spark, path).count() == 3 and old_versions(spark, path) == []
    write_version(second, path)
    assert read_version(spark, path).count() == 5 and len(old_versions(spark, path)) == 1


def test_neighbors_skip_far_blocks(spark):
    """Clustered rows: few of the blocks are visited, and the answer stays that of brute force."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 6)) * 50
    x = centres[rng.integers(0, 40, 2_000)] + rng.normal(size=(2_000, 6))
    rows = spark.createDataFrame([(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)], "id bigint, v array<double>, y int")
    extra = spark.createDataFrame([(5_000, None, 1)], "id bigint, v array<double>, y int")
    counters: dict = {}
    got = neighbors.nearest_neighbors(rows.where("id % 10 = 0"), rows.unionByName(extra), "id", "v", "y", 5, True, 64, counters)
    actual = {}
    for r in got.collect():
        actual.setdefault(r["id"], {})[r["rank"]] = r["neighbor"]
    for i in range(0, 2_000, 10):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        assert [actual[i][k + 1] for k in range(5)] == list(np.lexsort((np.arange(2_000), d))[:5])
    assert counters["blocks"] > 20 and counters["skipped"] > 0.7 * counters["blocks"] * 200


def test_neighbors_of_many_equal_rows(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0] if i % 3 else [float(i), 0.0], i % 2) for i in range(300)], "id bigint, v array<double>, y int")
    got = neighbors.nearest_neighbors(rows, rows, "id", "v", "y", 3, True, 16)
    near = {(r["id"], r["rank"]): r["neighbor"] for r in got.collect()}
    assert len(near) == 900 and near[4, 1] == 1 and near[1, 1] == 2 and near[1, 3] == 5
    nothing = rows.limit(0)
    assert neighbors.nearest_neighbors(rows, nothing, "id", "v", "y", 3).count() == 0
    assert neighbors.nearest_neighbors(nothing, rows, "id", "v", "y", 3).count() == 0


def _brute(x, asked, k):
    for i in asked:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        yield i, list(np.lexsort((np.arange(len(x)), d))[:k])


def test_neighbors_keep_no_row_per_block(spark, monkeypatch):
    """Vectors without structure: every block is visited, yet no more rows are kept than the answer has."""
    x = np.random.default_rng(3).normal(size=(400, 16))
    x[200:260] = x[0]
    rows = spark.createDataFrame([(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)], "id bigint, v array<double>, y int")
    kept, counters = [], {}
    store = neighbors.stored

    def counted(frame, name):
        frame = store(frame, name)
        kept.append(frame.count())
        return frame

    monkeypatch.setattr(neighbors, "stored", counted)
    got = neighbors.nearest_neighbors(rows, rows, "id", "v", "y", 3, True, 16, counters).collect()
    actual = {(r["id"], r["rank"]): r["neighbor"] for r in got}
    assert all([actual[i, place + 1] for place in range(3)] == near for i, near in _brute(x, range(400), 3))
    assert counters["blocks"] > 20 and counters["visits"] > 10 * 400 and max(kept) <= 400 * 3


def test_neighbors_of_any_magnitude(spark):
    """The product in single precision only proposes: rows far from zero, tiny and huge ones and rows that are no vector."""
    rng = np.random.default_rng(4)
    x = np.concatenate([1e6 + 1e-3 * rng.normal(size=(60, 4)), 1e-25 * rng.normal(size=(60, 4)), 1e25 * rng.normal(size=(60, 4)), rng.normal(size=(60, 4))])
    data = [(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)]
    data += [(900, [float("nan")] * 4, 1), (901, [1.0, None, 1.0, 1.0], 1), (902, [float("inf"), 0.0, 0.0, 0.0], 1), (903, None, 1)]
    rows = spark.createDataFrame(data, "id bigint, v array<double>, y int")
    got = neighbors.nearest_neighbors(rows, rows, "id", "v", "y", 3, True, 16).collect()
    actual = {(r["id"], r["rank"]): r["neighbor"] for r in got}
    assert len(actual) == 240 * 3
    assert all([actual[i, place + 1] for place in range(3)] == near for i, near in _brute(x, range(240), 3))
