"""Sinks and table checks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.readers import dialect


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    drop: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Overwrite a table, schema included, so that a second run leaves the same state."""
    writer = df.drop(*drop).write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_version(df: DataFrame, path: str) -> str:
    """Replace the table at ``path`` in two steps: a new folder with all its rows, then one more row in the table of versions.

    Readers (``read_version``) follow the last version named there, so they see the old rows or the new ones, never a part;
    a write that stops in between changes nothing for them. Old folders stay until ``old_versions`` names them to the caller.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}/version={version}")
    switch = spark.createDataFrame([(version,)], "version string").withColumn("at", F.current_timestamp())
    switch.coalesce(1).write.mode("append").parquet(f"{path}/switches")
    return version


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The versions switched to, the current one last; a row per write of the table."""
    switches = spark.read.schema("version string, at timestamp").parquet(f"{path}/switches")
    return [r["version"] for r in switches.orderBy("at", "version").collect()]


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/version={_versions(spark, path)[-1]}")


def old_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders that no reader starting now will open."""
    return [f"{path}/version={v}" for v in _versions(spark, path)[:-1]]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; NULL as an empty field, quotes doubled, blanks at the ends of a text kept."""
    writer = dialect(df.write.mode("overwrite")).option("header", True).option("nullValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def table_report(spark: SparkSession, name: str) -> DataFrame:
    """Row count of a stored table with its provider and location."""
    detail = (
        spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        .filter(F.col("col_name").isin("Provider", "Location"))
        .groupBy()
        .agg(
            F.max(F.when(F.col("col_name") == "Provider", F.col("data_type"))).alias("provider"),
            F.max(F.when(F.col("col_name") == "Location", F.col("data_type"))).alias("location"),
        )
    )
    rows = spark.table(name).agg(F.count("*").alias("n")).scalar()
    return detail.select(F.lit(name).alias("table_name"), "provider", "location", rows.alias("n_rows"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def schema_report(df: DataFrame) -> str:
    return df.schema.treeString()
