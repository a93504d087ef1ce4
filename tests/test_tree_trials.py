"""Decision trees of many trials from one set of cells."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from ledgerline.operators import histograms as hg
from ledgerline.operators import models as md
from ledgerline.operators import selection
from ledgerline.operators import tree_trials as tt
from ledgerline.operators.ensembles import TreeTable
from ledgerline.queries import REGISTRY

FEATURES = ["a", "b", "c"]
TIES = 2e-4  # equal gains of small nodes, told apart by rounding alone
PARAMS = [
    {"max_depth": d, "min_leaf": m, "criterion": c}
    for d, m, c in ((3, 1, "gini"), (7, 25, "entropy"), (5, 25, "entropy"), (9, 20, "gini"), (12, 30, "entropy"), (1, 40, "gini"))
]


def planted(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 20, size=(n, 3)).astype(float)
    y = (x[:, 0] + 0.1 * (x[:, 1] - 9) ** 2 + rng.normal(size=n) * 6 > 14).astype(int)
    return spark.createDataFrame(pd.DataFrame(x, columns=FEATURES).assign(y=y)).cache()


@pytest.fixture(scope="module")
def data(spark):
    return planted(spark, 3_000, 0), planted(spark, 1_500, 1)


@pytest.fixture(scope="module")
def expected(data):
    """AUC of each parameter set as the fitting library has it."""
    return [md.validation_metrics(md.fit_tree(data[0], FEATURES, "y", **p), data[1], "y")["auc_roc"] for p in PARAMS]


@pytest.mark.parametrize("local", [20_000, 400, 1])
def test_trials_equal_the_library(data, expected, monkeypatch, local):
    """Whole in a task, cut between jobs and tasks, and all in jobs: the same trees as one fit of the library each."""
    monkeypatch.setattr(tt, "LOCAL_CELLS", local)
    with md.cell_trials(md.CELL_TREE, *data, FEATURES, "y", PARAMS, "balanced") as grown:
        assert grown.aucs() == pytest.approx(expected, abs=TIES)
        for i in (0, 3, 5):
            model = grown.model(i)
            assert isinstance(model, TreeTable)
            assert md.validation_metrics(model, data[1], "y")["auc_roc"] == pytest.approx(grown.aucs()[i], abs=1e-9)


def test_copies_of_the_rows_are_as_many_cells(data):
    """Least leaves count rows, not cells: five copies with five times the least leaf give the same trees."""
    train, val = data
    copies = train.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(5))))
    with md.cell_trials(md.CELL_TREE, train, val, FEATURES, "y", PARAMS, "balanced") as one:
        more = [{**p, "min_leaf": 5 * p["min_leaf"]} for p in PARAMS]
        with md.cell_trials(md.CELL_TREE, copies, val, FEATURES, "y", more, "balanced") as many:
            assert many.rows.map(lambda part: part[0].shape[1]).sum() == one.rows.map(lambda part: part[0].shape[1]).sum()
            assert many.aucs()[1:] == pytest.approx(one.aucs()[1:], abs=TIES)


def test_rows_of_one_class(spark, data):
    """No cut, one leaf, no AUC."""
    train, val = data
    with md.cell_trials(md.CELL_TREE, train.withColumn("y", F.lit(0)), val, FEATURES, "y", PARAMS[:2], "balanced") as grown:
        assert grown.aucs() == [0.5, 0.5]
        assert len(grown.model(1).nodes) == 1


@pytest.mark.parametrize("name, searches", [("tree_search", 1), ("logged_runs", 2)])
def test_queries_fit_no_trial_by_itself(spark, sf_dir, monkeypatch, name, searches):
    def no_fit(*_):
        raise AssertionError("a trial was fitted on its own")

    started, make = [], tt.Trials.__init__

    def watched(self, cells, features, cuts, trials, weights):
        started.append(len(trials))
        make(self, cells, features, cuts, trials, weights)

    monkeypatch.setattr(DecisionTreeClassifier, "fit", no_fit)
    monkeypatch.setattr(tt.Trials, "__init__", watched)
    assert REGISTRY[name].run(spark, sf_dir).count() == {"tree_search": 50, "logged_runs": 2}[name]
    assert started == [50] * searches


@pytest.mark.parametrize("make, space", [(md.CELL_TREE, md.TREE_SPACE), (md.CELL_BOOSTED, None)])
def test_halving_over_cells(data, monkeypatch, make, space):
    """The rungs and shares of the search over rows; the model has the AUC noted for its trial."""
    train, val = data
    space = space or {"trees": md.whole(6, 12), "max_depth": md.whole(2, 3), "learning_rate": md.log_uniform(0.1, 0.3)}
    monkeypatch.setattr(selection, "LEVEL_BYTES", 0)
    found = selection.halving_search("T", make, space, train, val, FEATURES, "y", "a", trials=9, least_rows=900)
    assert [sorted(t["rung"] for t in found.trials).count(r) for r in (0, 1, 2)] == [6, 2, 1]
    assert {t["rows"] for t in found.trials if t["rung"] == 0} == {0.3} and {t["rows"] for t in found.trials if t["rung"] == 2} == {1.0}
    best = found.trials[found.params["trial"]]
    assert isinstance(found.model, TreeTable) and found.metrics["auc_roc"] == pytest.approx(best["auc"], abs=1e-9) and best["auc"] > 0.8
    assert not make.boosted or found.model.trees == found.params["trees"] <= 12


def test_selection_searches_cells():
    assert all(isinstance(make, md.CellTrees) for make, *_ in selection.SEARCHES.values())


def test_trials_side_by_side_equal_trials_in_jobs(spark, data, monkeypatch):
    """A task for each trial and jobs over many tasks find the same trees and AUCs; in the former, jobs do not follow trials and rounds."""
    train, val = data
    space = {"trees": md.whole(6, 12), "max_depth": md.whole(2, 4), "learning_rate": md.log_uniform(0.1, 0.3), "min_leaf": md.whole(5, 20)}
    found, jobs = [], []
    for most in (hg.MOST_CELLS, 600):
        monkeypatch.setattr(hg, "MOST_CELLS", most)
        monkeypatch.setattr(hg, "TASK_CELLS", min(most, hg.TASK_CELLS))
        group = f"most {most}"
        watched = selection._boosted_rung

        def counted(*rung, watched=watched, group=group):
            spark.sparkContext.setJobGroup(group, group)
            return watched(*rung)

        monkeypatch.setattr(selection, "_boosted_rung", counted)
        found.append(selection.halving_search("T", md.CELL_BOOSTED, space, train, val, FEATURES, "y", "a", trials=9, least_rows=900))
        monkeypatch.setattr(selection, "_boosted_rung", watched)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    one, other = found
    assert [t["auc"] for t in one.trials] == pytest.approx([t["auc"] for t in other.trials], abs=1e-6)
    assert one.params == other.params and one.model.nodes[["feature", "left", "right"]].equals(other.model.nodes[["feature", "left", "right"]])
    assert jobs[0] < 60 < jobs[1]
