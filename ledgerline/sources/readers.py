"""Scans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.config import NULL_TOKENS
from ledgerline.functions import month_text_to_date, null_tokens_to_null, quote_name, to_double
from ledgerline.operators.profile import year_counts
from ledgerline.sources.records import csv_records


class MissingColumnError(ValueError):
    """A column the scan depends on is not in the file."""


class EmptyResultError(ValueError):
    """The scan kept no row."""


def text_schema(names: Sequence[str]) -> T.StructType:
    """Every column as text: the reader then never guesses a type, and needs no pass to do so."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def dialect(reader_or_writer):
    """Fields in double quotes; a quote inside is doubled, as other programs write it."""
    return reader_or_writer.option("quote", '"').option("escape", '"')


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line."""
    return dialect(spark.read).option("header", True).csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    infer: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header. Raises on a missing path; ``null_tokens`` are read as NULL in text columns.

    Without a schema the columns stay text (``infer=True`` scans the whole file for types). A quote inside
    a quoted field is doubled. ``multi_line`` allows line breaks there; the blocks of a file are still read by many tasks
    (with ``infer`` a file is then read by one).
    """
    reader = dialect(spark.read).option("header", True).option("nullValue", "").option("nanValue", "NaN")
    if infer:
        return reader.option("multiLine", multi_line).option("inferSchema", True).option("samplingRatio", 1.0).csv(path)
    schema = schema or text_schema(csv_header(spark, path))
    if multi_line:
        options = {"quote": '"', "escape": '"', "nullValue": "", "nanValue": "NaN"}
        raw = csv_records(spark, path).select(F.from_csv("record", ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in schema), options).alias("r")).select("r.*")
    else:
        raw = reader.schema(schema).csv(path)
    return raw.select(
        *[
            null_tokens_to_null(f.name, null_tokens).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(quote_name(f.name))
            for f in raw.schema.fields
        ]
    )


def filtered_loans(
    spark: SparkSession,
    path: str,
    start: str,
    end: str,
    date_column: str = "issue_d",
    schema: T.StructType | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    require_rows: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """CSV rows whose month-text date lies in ``[start, end]``; unreadable dates drop out."""
    raw = read_csv(spark, path, schema, null_tokens, multi_line=multi_line)
    if date_column not in raw.columns:
        raise MissingColumnError(f"{path} has no column {date_column}")
    dated = raw.withColumn(date_column, month_text_to_date(date_column))
    kept = dated.filter(F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if require_rows and kept.isEmpty():
        raise EmptyResultError(f"{path} has no row with {date_column} between {start} and {end}")
    return kept


def year_distribution(spark: SparkSession, path: str, date_column: str = "issue_d") -> DataFrame:
    """Rows per year of one column; the scan parses no other column."""
    dates = read_csv(spark, path).select(month_text_to_date(date_column).alias(date_column))
    return year_counts(dates, date_column)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def insight_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One stored aggregate."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def in_memory_table(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def macro_series(spark: SparkSession, folder: str) -> DataFrame:
    """``(series_id, observation_date, value)`` from a folder with one two-column CSV per series.

    ``<series id>.csv`` is a file, or a folder of parts as Spark writes it. The columns are
    taken by position, and a value that is not a number becomes NULL.
    """
    schema = T.StructType(
        [T.StructField("observation_date", T.StringType()), T.StructField("value", T.StringType())]
    )
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .schema(schema)
        .csv(folder)
    )
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv(?:/part-[^/]*)?$", 1).alias("series_id"),
        F.col("observation_date").try_cast("date").alias("observation_date"),
        to_double("value").alias("value"),
    )
