"""What the fits read: a stored frame, so that their many passes repeat no join."""

from __future__ import annotations

import pytest

from ledgerline.operators import features
from ledgerline.queries import models as queries
from ledgerline.queries import scoring, series
from ledgerline.queries.base import REGISTRY


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_model_rows_are_joined_once(spark, sf_dir):
    for rows in (*queries._parts(spark, sf_dir), queries._two_values(spark, sf_dir)):
        assert "Join" not in _plan(rows)


@pytest.mark.parametrize("name, module", [("series_feature_matrix", series), ("explained_model_scores", scoring)])
def test_feature_fits_read_stored_rows(spark, sf_dir, monkeypatch, name, module):
    seen, fit = [], features.fit_features

    def watched(train, spec):
        seen.append(_plan(train))
        return fit(train, spec)

    monkeypatch.setattr(features, "fit_features", watched)
    assert REGISTRY[name].run(spark, sf_dir).count() > 0
    assert len(seen) == 1 and "Join" not in seen[0]
