"""Sorts, top-k reports and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import as_column


def sort_by_date(df: DataFrame, date_column: str, key: str) -> DataFrame:
    """Ordered by date; the key breaks ties and lets one heavy date spread over tasks."""
    return df.orderBy(as_column(date_column), as_column(key))


def _ordered(df: DataFrame, metric: Column, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(metric.desc_nulls_last(), *[as_column(t) for t in ties])


def top_n(df: DataFrame, metric: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return _ordered(df, as_column(metric), ties).limit(n)


def sort_by_abs(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    return _ordered(df, F.abs(as_column(metric)), ties)


def latest_n(df: DataFrame, date_column: str, n: int) -> DataFrame:
    return df.orderBy(as_column(date_column).desc_nulls_last()).limit(n)


def best_row(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    """The one row with the highest metric."""
    return top_n(df, metric, 1, ties)


def stack_tables(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name; an absent column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
