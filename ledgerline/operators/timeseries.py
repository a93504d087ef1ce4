"""Monthly series: reshape, year-over-year change, joins to the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import as_column
from ledgerline.functions.sizing import lookup_join

PIVOT_BLOCK = 500


def month_of(column) -> Column:
    """First day of the month."""
    return F.trunc(as_column(column).cast("date"), "month")


def with_month(df: DataFrame, date_column: str, output: str = "year_month") -> DataFrame:
    return df.withColumn(output, month_of(date_column))


def series_summary(long: DataFrame) -> DataFrame:
    """``(series_id, n, start, end)``."""
    return long.groupBy("series_id").agg(
        F.count("*").alias("n"), F.min("observation_date").alias("start"), F.max("observation_date").alias("end")
    )


def series_ids(long: DataFrame) -> list[str]:
    """All series, one name each."""
    return sorted(r[0] for r in long.select("series_id").where("series_id IS NOT NULL").distinct().collect())


def pivot_series(long: DataFrame, ids: Sequence[str] | None = None, block: int = PIVOT_BLOCK) -> DataFrame:
    """One row per month, one column per series, holding the first observation of the month.

    Any number of series: they are pivoted ``block`` columns at a time and the blocks, a row per month each, joined.
    """
    ids = list(ids) if ids is not None else series_ids(long)
    dated = with_month(long, "observation_date")

    def pivoted(some: Sequence[str]) -> DataFrame:
        return dated.groupBy("year_month").pivot("series_id", list(some)).agg(F.min_by("value", "observation_date"))

    out = pivoted(ids[:block])
    for i in range(block, len(ids), block):
        more = pivoted(ids[i : i + block]).withColumnRenamed("year_month", "_month")
        out = out.join(more, F.col("year_month").eqNullSafe(F.col("_month")), "left").drop("_month")
    return out


def year_over_year(
    wide: DataFrame, column: str, output: str, periods: int = 12, calendar: bool = False
) -> DataFrame:
    """Percent change against ``periods`` rows earlier, or against the same calendar month if asked.

    ``wide`` has one row per month, so the ordered window covers a few hundred rows.
    """
    if calendar:
        earlier = wide.select(F.add_months("year_month", periods).alias("year_month"), F.col(column).alias("_past"))
        paired = lookup_join(wide, earlier, "year_month")
    else:
        paired = wide.withColumn("_past", F.lag(column, periods).over(Window.orderBy("year_month")))
    change = (F.try_divide(F.col(column), F.col("_past")) - 1) * 100
    return paired.withColumn(output, change).drop("_past")


def join_monthly(fact: DataFrame, wide: DataFrame, date_column: str, month: str = "year_month") -> DataFrame:
    """Left join of the month's series values to every fact row."""
    return lookup_join(with_month(fact, date_column, month), wide, month)


def join_with_fallback(
    fact: DataFrame,
    series: DataFrame | None,
    date_column: str,
    output: str,
    constant: float,
) -> DataFrame:
    """The value of the fact row's month; without one the latest value, without a table ``constant``.

    ``series`` has ``observation_date`` and ``value``, one row per month.
    """
    if series is None:
        return fact.withColumn(output, F.lit(constant))
    monthly = series.select(month_of("observation_date").alias("_month"), F.col("value").alias("_value"))
    latest = series.agg(F.max_by("value", "observation_date")).first()[0]
    joined = lookup_join(with_month(fact, date_column, "_month"), monthly, "_month")
    return joined.withColumn(output, F.coalesce("_value", F.lit(latest).cast("double"))).drop("_month", "_value")


def pick_by_key(key: str, column_of_key: Mapping[str, str], default_column: str) -> Column:
    """The column that belongs to the row's key value, else the default column."""
    choice = F.when(F.lit(False), F.col(default_column))
    for value, column in column_of_key.items():
        choice = choice.when(F.col(key) == value, F.col(column))
    return choice.otherwise(F.col(default_column))


def add_spreads(df: DataFrame, value: str, against: Mapping[str, str]) -> DataFrame:
    """``output = value - column`` for each ``output: column``."""
    return df.withColumns({out: F.col(value) - F.col(c) for out, c in against.items()})


def add_macro_features(
    fact: DataFrame,
    wide: DataFrame,
    date_column: str,
    rate_column: str,
    state_column: str,
    state_series: Mapping[str, str],
    national: str,
    inflation: str,
    policy_rate: str,
) -> DataFrame:
    """Monthly join, the state's own series where it has one, and two spreads; state columns go."""
    joined = join_monthly(fact, wide, date_column)
    with_state = joined.withColumn("state_unrate", pick_by_key(state_column, state_series, national))
    spread = add_spreads(with_state, rate_column, {"real_int_rate": inflation, "rate_spread": policy_rate})
    return spread.drop(*state_series.values())
