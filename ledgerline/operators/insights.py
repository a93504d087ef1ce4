"""Grouped rates of a 0/1 target. Every table here is small however large the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.config import HIGH_RATE_LABEL, LOW_RATE_LABEL, LOW_RATE_LIMIT
from ledgerline.functions.numeric import as_column
from ledgerline.operators.filters import years_condition
from ledgerline.operators.timeseries import month_of


def rounded(value: Column, digits: int = 1) -> Column:
    """Rounded, with no negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def rate_by(df: DataFrame, keys: Sequence[Column | str], target: str, count: str = "n") -> DataFrame:
    """Row count and target mean per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(count), F.avg(target).alias("default_rate"))


def rate_by_rounded(df: DataFrame, value: str, target: str, output: str, digits: int = 1) -> DataFrame:
    """Rate by rounded value of a column."""
    known = df.filter(F.col(value).isNotNull())
    return rate_by(known, [rounded(F.col(value), digits).alias(output)], target, "n_loans").orderBy(output)


def rate_regime(value: str, limit: float = LOW_RATE_LIMIT) -> Column:
    return F.when(F.col(value) <= limit, LOW_RATE_LABEL).otherwise(HIGH_RATE_LABEL)


def rate_by_category_and_regime(
    df: DataFrame, category: str, value: str, target: str, limit: float = LOW_RATE_LIMIT
) -> DataFrame:
    known = df.filter(F.col(category).isNotNull() & F.col(value).isNotNull())
    return rate_by(known, [category, rate_regime(value, limit).alias("rate_regime")], target).orderBy(
        category, "rate_regime"
    )


def regime_wide(long: DataFrame, category: str, order: Sequence[str]) -> DataFrame:
    """One row per category in the given order, one rate column per regime; unlisted categories go."""
    wide = (
        long.groupBy(category).pivot("rate_regime", [HIGH_RATE_LABEL, LOW_RATE_LABEL]).agg(F.first("default_rate"))
    )
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(category))
    known = as_column(HIGH_RATE_LABEL).isNotNull() | as_column(LOW_RATE_LABEL).isNotNull()
    return wide.filter((place > 0) & known).orderBy(place)


def rate_by_difference(
    df: DataFrame, category: str, categories: Sequence[str], value: str, base: str, target: str, output: str
) -> DataFrame:
    """Rate by category and rounded difference of two columns."""
    known = df.filter(F.col(category).isin(*categories) & F.col(value).isNotNull() & F.col(base).isNotNull())
    difference = rounded(F.col(value) - F.col(base)).alias(output)
    return rate_by(known, [category, difference], target).orderBy(category, output)


def rate_by_month(df: DataFrame, date_column: str, target: str) -> DataFrame:
    return rate_by(df, [month_of(date_column).alias("year_month")], target).orderBy("year_month")


def split_sizes(
    df: DataFrame, date_column: str, train_years: Sequence[int], test_year: int, val_share: float = 0.20
) -> DataFrame:
    """``(train, val, test)`` row counts of the announced 80/20 split."""
    return df.agg(
        F.count_if(years_condition(date_column, train_years)).alias("early"),
        F.count_if(years_condition(date_column, [test_year])).alias("test"),
    ).select(
        (F.col("early") - F.floor(F.col("early") * val_share)).alias("train"),
        F.floor(F.col("early") * val_share).alias("val"),
        "test",
    )
