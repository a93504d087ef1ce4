"""Registry of the queries: a Spark callable, and the same question as SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Every double column to six places, without negative zero, for comparison."""
    return df.select(
        *[
            (F.round(f.name, DIGITS) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _rounded_sql(sql: str, doubles: str) -> str:
    if not doubles:
        return sql
    swaps = ", ".join(f"round({c}, {DIGITS}) + 0.0::DOUBLE AS {c}" for c in doubles.split())
    return f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS unrounded"


def query(name: str, covers: str, sql: str | None = None, doubles: str = ""):
    """Register a query; ``doubles`` names the SQL columns to round as the Spark side does."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        REGISTRY[name] = Query(name, tuple(covers.split()), run, None if sql is None else _rounded_sql(sql, doubles))
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
