"""Tolerant parsing: a value that does not parse becomes NULL, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.numeric import as_column


def null_tokens_to_null(c, tokens: Sequence[str]) -> Column:
    """NULL where the text is one of ``tokens``."""
    col = as_column(c)
    return F.when(~col.isin(*tokens), col)


# A plain or scientific number, or infinity; no type suffix such as the d of 12d (fixed value).
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))$"


def numeric_text(c: Column) -> Column:
    """Trimmed text that is a number as a double, else NULL."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_double(c) -> Column:
    """Trimmed text to double; anything unreadable, and NaN, becomes NULL."""
    return numeric_text(as_column(c))


def leading_integer(c) -> Column:
    """``" 36 months"`` -> 36."""
    return F.regexp_extract(F.trim(as_column(c).cast("string")), r"(\d+)", 1).try_cast("int")


def percent_to_double(c) -> Column:
    """``"12.5%"`` -> 12.5."""
    return numeric_text(F.replace(as_column(c).cast("string"), F.lit("%"), F.lit("")))


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Value of a small fixed map; unknown and NULL give ``default``."""
    col = as_column(c)
    chain = None
    for key, value in mapping.items():
        chain = F.when(col == key, value) if chain is None else chain.when(col == key, value)
    if chain is None:
        return F.lit(default)
    return chain if default is None else chain.otherwise(default)


def ordinal_position(c, ordered: Sequence[str]) -> Column:
    """Zero-based place in a fixed list, -1 for an unknown value, NULL for NULL."""
    return (F.array_position(F.array(*[F.lit(v) for v in ordered]), as_column(c)) - 1).cast("double")


def month_text_to_date(c) -> Column:
    """``"Oct-1981"`` -> 1981-10-01."""
    return F.to_date(F.try_to_timestamp(as_column(c).cast("string"), F.lit("MMM-yyyy")))


def iso_to_date(c) -> Column:
    """``"2014-01-01"`` or ``"2010-01"`` -> date."""
    return as_column(c).cast("string").try_cast("date")
