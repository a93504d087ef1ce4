"""Scoring requests as they arrive: the batch expressions on a streaming DataFrame."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.features import FeatureModel
from ledgerline.operators.score import (
    fill_inputs,
    normalized_inputs,
    predict_probability,
    rejected_rows,
    valid_rows,
    with_errors,
    with_tier,
)
from ledgerline.plans.layers import prepared


def score_batch(
    applicants: DataFrame,
    key: str,
    features: FeatureModel,
    model: PipelineModel,
    as_of: str,
    model_name: str,
    unemployment: DataFrame | None = None,
) -> DataFrame:
    """The score record of every valid applicant; works on a static or a streaming DataFrame.

    ``unemployment`` is the series the features were fitted with, if any.
    """
    checked = with_errors(fill_inputs(applicants))
    ready = prepared(normalized_inputs(valid_rows(checked), as_of), unemployment)
    scored = predict_probability(ready, features, model, [key])
    return with_tier(scored, "score", model_name).drop("score")


def rejected(applicants: DataFrame, key: str) -> DataFrame:
    """``(key, error)`` of the applicants that break a rule."""
    return rejected_rows(with_errors(fill_inputs(applicants))).select(key, "error")


def score_stream(
    applicants: DataFrame,
    key: str,
    features: FeatureModel,
    model: PipelineModel,
    as_of: str,
    model_name: str,
    path: str,
    checkpoint: str,
    unemployment: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Write score records as parquet; the checkpoint makes a restart continue where it stopped."""
    records = score_batch(applicants, key, features, model, as_of, model_name, unemployment)
    writer = records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
