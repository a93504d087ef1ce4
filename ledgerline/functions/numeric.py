"""Numeric column expressions whose NULL handling the operators rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def as_column(c) -> Column:
    return F.col(quote_name(c)) if isinstance(c, str) else c


def quote_name(name: str) -> str:
    """A column name in backticks, so dots and blanks in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def project(df: DataFrame, exprs: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """The expressions computed once per row, as plain columns for the aggregates above them."""
    names = {name: f"v{i}" for i, name in enumerate(exprs)}
    return df.select(*[e.alias(names[n]) for n, e in exprs.items()]), {n: F.col(v) for n, v in names.items()}


def nan_to_null(c) -> Column:
    col = as_column(c)
    return F.when(~F.isnan(col), col)


def is_missing(field: T.StructField) -> Column:
    """NULL, and for floating columns NaN too."""
    col = as_column(field.name)
    return (col.isNull() | F.isnan(col)) if isinstance(field.dataType, FLOATING) else col.isNull()


def cap_above(c, cap) -> Column:
    """Clip from above; unlike ``least`` a NULL stays NULL."""
    col = as_column(c)
    return F.when(col > cap, F.lit(cap)).otherwise(col)


def floor_below(c, low) -> Column:
    """Clip from below; unlike ``greatest`` a NULL stays NULL."""
    col = as_column(c)
    return F.when(col < low, F.lit(low)).otherwise(col)


def ratio_plus_one(numerator, denominator) -> Column:
    """``a / (b + 1)``; NULL where ``b`` is -1."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double") + 1.0)


def month_difference(later, earlier) -> Column:
    """Whole calendar months between two dates, ignoring the day."""
    a, b = as_column(later), as_column(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def annuity_payment(principal, annual_rate_percent, months) -> Column:
    """Monthly payment of a level-payment loan; principal / months at rate zero."""
    amount = as_column(principal).cast("double")
    rate = as_column(annual_rate_percent).cast("double") / 100.0 / 12.0
    n = as_column(months).cast("double")
    growth = F.pow(1.0 + rate, n)
    return F.when(rate == 0, F.try_divide(amount, n)).otherwise(
        F.try_divide(amount * rate * growth, growth - 1.0)
    )


def skewness_corrected(c) -> Column:
    """Bias-corrected sample skewness: NULL below three values, 0 for a constant."""
    col = as_column(c)
    n = F.count(col).cast("double")
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.min(col) == F.max(col), 0.0)
        .otherwise(F.skewness(col) * F.try_divide(F.sqrt(n * (n - 1)), n - 2))
    )


def kurtosis_corrected(c) -> Column:
    """Bias-corrected excess kurtosis: NULL below four values, 0 for a constant."""
    col = as_column(c)
    n = F.count(col).cast("double")
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(F.min(col) == F.max(col), 0.0)
        .otherwise(F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(col) + 6))
    )
