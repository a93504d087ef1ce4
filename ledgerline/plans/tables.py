"""Build and store every layer; each step reads the stored table of the one before."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators import insights
from ledgerline.operators.filters import years_condition
from ledgerline.operators.timeseries import month_of
from ledgerline.plans import layers
from ledgerline.sources import macro_series, read_table, write_table


@dataclass(frozen=True)
class LoanTables:
    """Names of the stored tables."""

    prefix: str = ""
    fmt: str = "parquet"
    folder: str | None = None

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def write(self, df: DataFrame, table: str, partition_by=()) -> DataFrame:
        path = f"{self.folder.rstrip('/')}/{self.name(table)}" if self.folder else None
        write_table(df, self.name(table), self.fmt, partition_by, path=path)
        return read_table(df.sparkSession, self.name(table))


def build(
    spark: SparkSession,
    loans_csv: str,
    series_folder: str,
    tables: LoanTables,
    train_rows: int | None = None,
    val_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Raw files to stored layers and insight tables.

    Cleaned loans are stored by issue month, and the splits read only the months of their years.
    ``train_rows`` and ``val_rows`` ask for samples of the splits instead of the whole.
    """
    out = {"bronze_loans": tables.write(layers.bronze(spark, loans_csv), "bronze_loans")}
    silver = layers.silver(out["bronze_loans"]).withColumn("issue_month", month_of("issue_d"))
    out["silver_loans"] = tables.write(silver, "silver_loans", ["issue_month"])
    loans = out["silver_loans"].drop("issue_month")
    years = years_condition("issue_month", [*cfg.TRAIN_YEARS, cfg.TEST_YEAR])
    splits = layers.gold(out["silver_loans"].filter(years).drop("issue_month"), train_rows, val_rows)
    for name, part in splits.items():
        out[f"gold_loans_{name}"] = tables.write(part, f"gold_loans_{name}")
    out["bronze_macro"] = tables.write(macro_series(spark, series_folder), "bronze_macro")
    out["silver_macro"] = tables.write(layers.silver_macro(out["bronze_macro"]), "silver_macro")
    out["gold_loans_macro"] = tables.write(layers.gold_macro(loans, out["silver_macro"]), "gold_loans_macro")
    for name, report in insight_tables(out["gold_loans_macro"]).items():
        out[name] = tables.write(report, name)
    return out


def insight_tables(combined: DataFrame) -> dict[str, DataFrame]:
    """The small reports kept for reading."""
    target = cfg.TARGET
    return {
        "insight1_unrate": insights.rate_by_rounded(combined, "UNRATE", target, "unrate_bin"),
        "insight2_subgrade_regime": insights.rate_by_category_and_regime(combined, "sub_grade", "FEDFUNDS", target),
        "insight3_state": insights.rate_by_difference(
            combined, "addr_state", list(cfg.STATE_SERIES), "state_unrate", "UNRATE", target, "excess_unemp"
        ),
        "default_by_subgrade": insights.rate_by(combined, ["sub_grade"], target),
        "default_over_time": insights.rate_by_month(combined, "issue_d", target),
        "rows_per_year": combined.groupBy(F.year("issue_d").alias("year")).agg(F.count("*").alias("n")),
    }
