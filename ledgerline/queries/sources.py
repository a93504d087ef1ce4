"""Scans and sinks. Files are written to the shared folder first, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators.timeseries import series_summary
from ledgerline.queries.base import query, table
from ledgerline.queries.frames import MACRO_LONG, RAW_LOANS, frame, sql
from ledgerline.session import shared_path
from ledgerline.sources import (
    filtered_loans,
    in_memory_table,
    insight_table,
    macro_series,
    preview,
    read_csv,
    read_table,
    table_report,
    write_csv,
    write_table,
    year_distribution,
)


def _raw_csv(spark, sf) -> str:
    """Orders as a CSV of texts, dates as month text with junk among them."""
    path = shared_path(spark, "orders-csv")
    text = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 97 == 0, "junk").otherwise(F.date_format("o_orderdate", "MMM-yyyy")).alias("issue_d"),
        F.when(F.col("o_orderkey") % 11 == 0, "NaN").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    write_csv(text, path)
    return path


@query(
    "csv_date_range_scan", "S1 S2 S3 S4 S8 F1 U1",
    sql="""
    SELECT cast(o_orderkey AS string) AS id, cast(date_trunc('month', o_orderdate) AS date) AS issue_d,
      CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status
    FROM orders
    WHERE o_orderkey % 97 <> 0 AND cast(date_trunc('month', o_orderdate) AS date) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    """,
)
def _(spark, sf):
    return filtered_loans(spark, _raw_csv(spark, sf), "1996-01-01", "1999-12-31", require_rows=True)


@query(
    "csv_year_distribution", "S5 A1",
    sql="""
    SELECT cast(year(o_orderdate) AS int) AS year, count(*) AS n,
      count(*) * 100e0 / sum(count(*)) OVER () AS pct
    FROM orders WHERE o_orderkey % 97 <> 0 GROUP BY 1
    """,
    doubles="pct",
)
def _(spark, sf):
    return year_distribution(spark, _raw_csv(spark, sf))


@query(
    "csv_round_trip_counts", "S3 S4 S8",
    sql="SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1",
)
def _(spark, sf):
    path = shared_path(spark, "priorities-csv")
    write_csv(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority")), path)
    return read_csv(spark, path).groupBy("priority").agg(F.count("*").alias("n"))


@query(
    "free_text_round_trip", "S1 S4 S8",
    sql="SELECT doc_id, text FROM documents",
)
def _(spark, sf):
    """Texts with quotes, commas and line breaks survive the CSV sink and scan unchanged."""
    path = shared_path(spark, "texts-csv")
    write_csv(table(spark, sf, "documents").select("doc_id", "text"), path)
    back = read_csv(spark, path, null_tokens=(), multi_line=True)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


@query(
    "series_folder_scan", "S11 U2 A24",
    sql=f"""
    SELECT series_id, count(*) AS n, min(observation_date) AS start, max(observation_date) AS "end"
    FROM {sql(MACRO_LONG)} GROUP BY 1
    """,
)
def _(spark, sf):
    folder = shared_path(spark, "series")
    long = frame(spark, sf, MACRO_LONG)
    # The sink names each file after its series, as a download of one file per series would.
    for series_id in [*cfg.NATIONAL_SERIES, *cfg.STATE_SERIES.values()]:
        one = long.filter(F.col("series_id") == series_id).select("observation_date", "value")
        write_csv(one.coalesce(1), f"{folder}/{series_id}.csv")
    return series_summary(macro_series(spark, folder))


@query(
    "table_overwrite_read", "S6 S7",
    sql="SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1",
)
def _(spark, sf):
    # Written twice: the second run leaves the same state.
    path = shared_path(spark, "order-states")
    name = "order_states_" + path.rsplit("-", 1)[1]
    states = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"))
    for _ in range(2):
        write_table(states, name, drop=["key"], path=path)
    return read_table(spark, name).groupBy("status").agg(F.count("*").alias("n"))


@query("stored_table_report", "S12", sql="SELECT 'parquet' AS provider, count(*) AS n_rows FROM orders")
def _(spark, sf):
    path = shared_path(spark, "reported-orders")
    name = "reported_orders_" + path.rsplit("-", 1)[1]
    write_table(table(spark, sf, "orders"), name, path=path)
    return table_report(spark, name).select("provider", "n_rows")


@query(
    "stored_insight_scan", "S9",
    sql="SELECT l_returnflag AS flag, count(*) AS n, avg(l_discount) AS rate FROM lineitem GROUP BY 1",
    doubles="rate",
)
def _(spark, sf):
    folder = shared_path(spark, "insights")
    rates = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count("*").alias("n"), F.avg("l_discount").alias("rate")
    )
    rates.write.parquet(f"{folder}/default_by_flag.parquet")
    return insight_table(spark, folder, "default_by_flag")


@query(
    "in_memory_lookup_join", "S10 J3",
    sql="""
    SELECT m.text AS status_text, count(*) AS n
    FROM orders JOIN (VALUES ('F', 'Charged Off'), ('O', 'Fully Paid'), ('P', 'Current')) AS m(code, text) ON o_orderstatus = m.code
    GROUP BY 1
    """,
)
def _(spark, sf):
    rows = [("F", "Charged Off"), ("O", "Fully Paid"), ("P", "Current")]
    names = in_memory_table(spark, rows, "code string, text string")
    orders = table(spark, sf, "orders")
    joined = orders.join(F.broadcast(names), orders["o_orderstatus"] == names["code"])
    return joined.groupBy(F.col("text").alias("status_text")).agg(F.count("*").alias("n"))


@query(
    "table_preview", "S13 O2",
    sql=f"SELECT loan_id, term, purpose FROM {sql(RAW_LOANS)} ORDER BY loan_id LIMIT 5",
)
def _(spark, sf):
    return preview(frame(spark, sf, RAW_LOANS).select("loan_id", "term", "purpose").orderBy("loan_id"), 5)
