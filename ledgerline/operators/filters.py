"""Row filters, written as plain comparisons so that they reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import as_column


def _day(value) -> Column:
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def in_date_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Both ends included; NULL dates drop out."""
    return df.filter(as_column(column).between(_day(start), _day(end)))


def has_status(df: DataFrame, column: str, statuses: Sequence[str]) -> DataFrame:
    return df.filter(as_column(column).isin(*statuses))


def years_condition(column, years: Iterable[int]) -> Column:
    """The date lies in one of ``years``, as date ranges instead of a call to ``year``."""
    col = as_column(column)
    runs: list[list[int]] = []
    for y in sorted(set(years)):
        if runs and y == runs[-1][1] + 1:
            runs[-1][1] = y
        else:
            runs.append([y, y])
    condition = F.lit(False)
    for first, last in runs:
        span = (col >= F.lit(dt.date(first, 1, 1))) & (col < F.lit(dt.date(last + 1, 1, 1)))
        condition = condition | span
    return condition


def in_years(df: DataFrame, column: str, years: Iterable[int]) -> DataFrame:
    return df.filter(years_condition(column, years))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def value_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(as_column(column).isin(*values))


def rank_below(df: DataFrame, rank_column: str, limit: float) -> DataFrame:
    return df.filter(F.col(rank_column) < limit)


def violating(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which a consistency condition between columns is broken."""
    return df.filter(F.expr(condition))
