"""The loan tables, layer by layer: raw, cleaned, split, joined with the macro series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators import clean, features, models, selection, split, timeseries
from ledgerline.sources import filtered_loans


def bronze(spark: SparkSession, path: str, start: str = cfg.START_DATE, end: str = cfg.END_DATE) -> DataFrame:
    """The period's rows, numbers typed, names made safe."""
    raw = filtered_loans(spark, path, start, end, require_rows=True)
    return clean.sanitize_columns(clean.cast_doubles(raw, cfg.NUMERIC_COLUMNS))


def silver(loans: DataFrame) -> DataFrame:
    """Finished loans with a target, without sparse, leaking or idle columns, text parsed."""
    finished = clean.binary_target(loans, "loan_status", cfg.POSITIVE_STATUS, cfg.NEGATIVE_STATUS, cfg.TARGET)
    dense = clean.drop_sparse_columns(finished, cfg.MISSING_THRESHOLD)
    kept = clean.drop_present(dense, cfg.LEAKAGE_COLUMNS + cfg.UNINFORMATIVE_COLUMNS)
    typed = clean.parse_numeric_text(kept, ["term"], ["int_rate", "revol_util"])
    ordinal = clean.map_ordinal_text(typed, "emp_length", cfg.EMP_LENGTH_ORDINALS)
    dated = clean.parse_dates(ordinal, month_text=["earliest_cr_line"], iso=["issue_d"])
    return clean.null_impossible(dated, cfg.IMPOSSIBLE_VALUES)


def gold(
    loans: DataFrame,
    train_rows: int | None = None,
    val_rows: int | None = None,
    tie_key: str | None = None,
) -> dict[str, DataFrame]:
    """``train``, ``val`` and ``test``, whole; the first two sampled only if a size is asked for."""
    marked = split.time_split(loans, "issue_d", cfg.TRAIN_YEARS, [cfg.TEST_YEAR], cfg.TRAIN_SHARE, tie_key)
    parts = {name: marked.filter(F.col("split") == name).drop("split") for name in ("train", "val", "test")}
    for name, size in (("train", train_rows), ("val", val_rows)):
        if size is not None:
            parts[name] = split.stratified_sample(parts[name], size, cfg.TARGET, cfg.SEED, tie_key)
    return parts


def silver_macro(long: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """One row per month with every series and the yearly change of the price index."""
    wide = timeseries.pivot_series(long, ids or [*cfg.NATIONAL_SERIES, *cfg.STATE_SERIES.values()])
    return timeseries.year_over_year(wide, "CPIAUCSL", "CPI_YOY")


def gold_macro(loans: DataFrame, wide: DataFrame) -> DataFrame:
    return timeseries.add_macro_features(
        loans, wide, "issue_d", "int_rate", "addr_state", cfg.STATE_SERIES, "UNRATE", "CPI_YOY", "FEDFUNDS"
    )


def loan_spec() -> features.FeatureSpec:
    return features.FeatureSpec(
        skewed=cfg.SKEWED_COLUMNS,
        binarized=cfg.BINARIZED_COLUMNS,
        capped=cfg.CAPPED_COLUMNS,
        cap_quantile=cfg.CAP_QUANTILE,
        ordinal=cfg.ORDINAL_COLUMNS,
        one_hot=cfg.ONE_HOT_COLUMNS,
        rare=cfg.RARE_COLUMNS,
        rare_threshold=cfg.RARE_THRESHOLD,
        rare_label=cfg.RARE_LABEL,
        exclude=[cfg.TARGET],
    )


def prepared(loans: DataFrame, unemployment: DataFrame | None = None) -> DataFrame:
    """The columns the feature fit starts from: ratios, date parts, missing flags, unemployment."""
    slim = clean.drop_present(loans, cfg.CORRELATED_COLUMNS)
    macro = timeseries.join_with_fallback(
        slim, unemployment, "issue_d", "unemployment_rate", cfg.UNEMPLOYMENT_FALLBACK
    )
    dated = features.add_date_parts(macro, "issue_d", "earliest_cr_line")
    return features.add_missing_flags(features.add_loan_ratios(dated), cfg.MISSING_FLAG_COLUMNS)


def fit_loan_features(train: DataFrame, unemployment: DataFrame | None = None) -> features.FeatureModel:
    return features.fit_features(prepared(train, unemployment), loan_spec())


def feature_frame(
    model: features.FeatureModel, loans: DataFrame, unemployment: DataFrame | None = None, keep: Sequence[str] = (cfg.TARGET,)
) -> DataFrame:
    return model.transform(prepared(loans, unemployment), keep)


def select_model(
    train: DataFrame, val: DataFrame, names: Sequence[str], trials: int = 50, label: str = cfg.TARGET
) -> list[models.Fitted]:
    """Baseline logistic regression and three searched tree models, on the same rows."""
    return selection.select_models(train, val, names, label, trials=trials)
