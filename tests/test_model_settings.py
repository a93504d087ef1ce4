"""The model queries ask for the whole job; the fits themselves are made small here."""

from __future__ import annotations

import pytest

from ledgerline.operators import models as md
from ledgerline.operators import selection
from ledgerline.queries import REGISTRY


@pytest.mark.parametrize(
    "name, trials, trees",
    [
        ("boosted_trees", [], [300]), ("histogram_boosted_trees", [], [200]), ("tree_search", [50], []),
        ("model_selection", [50, 50, 50], []), ("logged_runs", [50, 50], []),
    ],
)
def test_whole_settings(spark, sf_dir, monkeypatch, name, trials, trees):
    asked, grown = [], []
    search, halving, fit = md.search, selection.halving_search, md.fit_and_score

    def small_search(model, make, space, *rows, trials=50, **fixed):
        asked.append(trials)
        space = {k: md.choice(2) if k in ("trees", "max_depth") else v for k, v in space.items()}
        return search(model, make, space, *rows, trials=1, **fixed)

    def small_halving(model, make, space, *rows, **fixed):
        asked.append(rows[5])
        space = {k: md.choice(2) if k in ("trees", "max_depth") else v for k, v in space.items()}
        return halving(model, make, space, *rows[:5], 1, **fixed)

    def small_fit(*rows, **params):
        if "trees" in params:
            grown.append(params["trees"])
            params["trees"] = 1
        return fit(*rows, **params)

    monkeypatch.setattr(md, "search", small_search)
    monkeypatch.setattr(selection, "halving_search", small_halving)
    monkeypatch.setattr(md, "fit_and_score", small_fit)
    assert REGISTRY[name].run(spark, sf_dir).count() > 0
    assert asked == trials and grown == trees
