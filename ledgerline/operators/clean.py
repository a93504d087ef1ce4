"""Projections, typing and cleaning. Each function takes a DataFrame and returns one."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import (
    is_missing,
    iso_to_date,
    leading_integer,
    lookup,
    month_text_to_date,
    nan_to_null,
    percent_to_double,
    quote_name,
    to_double,
)
from ledgerline.functions.numeric import FLOATING
from ledgerline.operators.profile import missing_counts


def _replace(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    """One projection that swaps the expressions of ``changed`` in and keeps the column order."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(quote_name(c)) for c in df.columns])


def sanitized_names(names: Sequence[str]) -> list[str]:
    """Lower-case names of letters, digits and underscores; a repeated one gets a number."""
    out: list[str] = []
    for name in names:
        base = re.sub(r"[^A-Za-z0-9_]+", "_", name).strip("_").lower() or "col"
        candidate, i = base, 2
        while candidate in out:
            candidate, i = f"{base}_{i}", i + 1
        out.append(candidate)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitized_names(df.columns))


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN to NULL in floating columns, so that NULL is the only missing marker."""
    return _replace(
        df, {f.name: nan_to_null(f.name) for f in df.schema.fields if isinstance(f.dataType, FLOATING)}
    )


def cast_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tolerant cast of the listed columns that are present."""
    return _replace(df, {c: to_double(c) for c in columns if c in df.columns})


def binary_target(df: DataFrame, status: str, positive: str, negative: str, target: str) -> DataFrame:
    """Keep the two final statuses and replace the status by a 0/1 column."""
    return (
        df.filter(F.col(status).isin(positive, negative))
        .withColumn(target, (F.col(status) == positive).cast("int"))
        .drop(status)
    )


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    """Columns whose missing share is strictly above ``threshold``; one pass over the table."""
    counts = missing_counts(df).collect()
    return [r["column"] for r in counts if r["n_rows"] and r["missing"] / r["n_rows"] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.30) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop those of ``columns`` that exist: leaking, uninformative, correlated or helper columns."""
    return df.drop(*[c for c in columns if c in df.columns])


def _is_text(df: DataFrame, column: str) -> bool:
    return column in df.columns and isinstance(df.schema[column].dataType, T.StringType)


def parse_numeric_text(
    df: DataFrame, integer_columns: Sequence[str] = (), percent_columns: Sequence[str] = ()
) -> DataFrame:
    """``" 36 months"`` -> 36 and ``"12.5%"`` -> 12.5; columns already numeric stay."""
    changed = {c: leading_integer(c) for c in integer_columns if _is_text(df, c)}
    changed.update({c: percent_to_double(c) for c in percent_columns if _is_text(df, c)})
    return _replace(df, changed)


def map_ordinal_text(df: DataFrame, column: str, mapping: Mapping[str, int], unknown: int = -1) -> DataFrame:
    if not _is_text(df, column):
        return df
    return _replace(df, {column: lookup(column, mapping, unknown).cast("int")})


def parse_dates(df: DataFrame, month_text: Sequence[str] = (), iso: Sequence[str] = ()) -> DataFrame:
    """Month text and ISO text to dates; unreadable text becomes NULL."""
    changed = {c: month_text_to_date(c) for c in month_text if _is_text(df, c)}
    changed.update({c: iso_to_date(c) for c in iso if _is_text(df, c)})
    return _replace(df, changed)


def _rules_present(df: DataFrame, rules: Mapping[str, str]) -> dict[str, Column]:
    return {c: F.expr(cond) for c, cond in rules.items() if c in df.columns}


def null_impossible(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Set a column to NULL where its rule holds (``{"dti": "dti < 0"}``)."""
    present = _rules_present(df, rules)
    return _replace(
        df, {c: F.when(F.coalesce(~cond, F.lit(True)), F.col(quote_name(c))) for c, cond in present.items()}
    )


def count_impossible(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``(column, fixes)``: how many values ``null_impossible`` sets to NULL."""
    present = _rules_present(df, rules)
    if not present:
        return df.sparkSession.createDataFrame([], "column string, fixes bigint")
    wide = df.agg(*[F.count_if(cond).alias(c) for c, cond in present.items()])
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(quote_name(c)).alias("fixes")) for c in present]))
    )


def columns_by_type(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, list[str]]:
    """Column names as ``numeric``, ``categorical`` and ``date``."""
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "date": []}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            out["numeric"].append(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out["date"].append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            out["categorical"].append(f.name)
    return out


def column_overview(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, null_pct)`` of every column, one pass."""
    n = F.count("*")
    fields = df.schema.fields
    wide = df.agg(
        n.alias("_n"), *[F.count_if(is_missing(f)).alias(f"_m{i}") for i, f in enumerate(fields)]
    )
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("position"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.try_divide(F.col(f"_m{i}") * 100.0, F.col("_n")).alias("null_pct"),
                    )
                    for i, f in enumerate(fields)
                ]
            )
        )
    )


def relabel(df: DataFrame, column: str, mapping: Mapping, output: str) -> DataFrame:
    """Class codes to text; an unlisted code becomes its own text."""
    return df.withColumn(output, F.coalesce(lookup(column, mapping), F.col(column).cast("string")))
