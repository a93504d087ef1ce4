"""Splits, samples, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import filters, ranking, split
from ledgerline.queries.base import query, table
from ledgerline.queries.frames import LOANS, frame, sql

_LOANS = sql(LOANS)
_EARLY, _TEST = [1996, 1997, 1998], [1999]

_BY_RANK = f"""(
  SELECT loan_id, issue_d, charged_off, CASE WHEN year(issue_d) = 1999 THEN 'test' WHEN rank < 0.8e0 THEN 'train' ELSE 'val' END AS split
  FROM (SELECT *, percent_rank() OVER (PARTITION BY year(issue_d) = 1999 ORDER BY issue_d) AS rank FROM {_LOANS} AS l
    WHERE year(issue_d) BETWEEN 1996 AND 1999) AS r)"""
_BY_POSITION = f"""(
  SELECT loan_id, issue_d, charged_off, CASE WHEN year(issue_d) = 1999 THEN 'test'
      WHEN place <= floor(0.8e0 * total) THEN 'train' ELSE 'val' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY year(issue_d) = 1999 ORDER BY issue_d, loan_id) AS place,
      count(*) OVER (PARTITION BY year(issue_d) = 1999) AS total FROM {_LOANS} AS l
    WHERE year(issue_d) BETWEEN 1996 AND 1999) AS r)"""


def _loans(spark, sf):
    return frame(spark, sf, LOANS).select("loan_id", "issue_d", "charged_off")


@query("split_by_rank", "W1 F3 F6", sql=f"SELECT * FROM {_BY_RANK} AS s")
def _(spark, sf):
    return split.time_split(_loans(spark, sf), "issue_d", _EARLY, _TEST)


@query("split_by_position", "W2 F3", sql=f"SELECT * FROM {_BY_POSITION} AS s")
def _(spark, sf):
    return split.time_split(_loans(spark, sf), "issue_d", _EARLY, _TEST, tie_key="loan_id")


@query(
    "percent_rank_by_date", "W1",
    sql="SELECT o_orderkey, percent_rank() OVER (ORDER BY o_orderdate) AS rank FROM orders",
    doubles="rank",
)
def _(spark, sf):
    return split.with_percent_rank(table(spark, sf, "orders"), "o_orderdate", "rank").select("o_orderkey", "rank")


@query(
    "early_rows_by_rank", "F6",
    sql="SELECT o_orderkey FROM (SELECT o_orderkey, percent_rank() OVER (ORDER BY o_orderdate) AS rank FROM orders) AS r WHERE rank < 0.8e0",
)
def _(spark, sf):
    ranked = split.with_percent_rank(table(spark, sf, "orders"), "o_orderdate", "rank")
    return filters.rank_below(ranked, "rank", 0.8).select("o_orderkey")


@query(
    "split_summary", "A32 W1",
    sql=f"SELECT split, count(*) AS n, avg(charged_off) AS rate, min(issue_d) AS date_min, max(issue_d) AS date_max FROM {_BY_RANK} AS s GROUP BY 1",
    doubles="rate",
)
def _(spark, sf):
    marked = split.time_split(_loans(spark, sf), "issue_d", _EARLY, _TEST)
    return split.split_summary(marked, "split", "charged_off", "issue_d")


@query(
    "stratified_sample_counts", "M1",
    sql=f"""
    WITH c AS (SELECT charged_off, count(*) AS n, sum(count(*)) OVER () AS total FROM {_LOANS} AS l GROUP BY 1),
    e AS (SELECT *, least(total, 1000) * n * 1e0 / total AS exact FROM c),
    r AS (SELECT *, row_number() OVER (ORDER BY floor(exact) - exact, charged_off) AS place, sum(floor(exact)) OVER () AS whole FROM e)
    SELECT charged_off, CAST(floor(exact) AS BIGINT) + CASE WHEN place <= least(total, 1000) - whole THEN 1 ELSE 0 END AS n FROM r
    """,
)
def _(spark, sf):
    loans = _loans(spark, sf)
    sample = split.stratified_sample(loans, 1_000, "charged_off", key="loan_id")
    return sample.groupBy("charged_off").agg(F.count("*").alias("n"))


@query(
    "hash_sample", "M1",
    sql=f"""
    SELECT loan_id, charged_off FROM {_LOANS} AS l
    WHERE substr(md5('42:' || cast(loan_id AS varchar)), 1, 8) < '40000000'
    """,
)
def _(spark, sf):
    return split.hash_sample(_loans(spark, sf), "loan_id", 0.25).select("loan_id", "charged_off")


@query(
    "most_recent_rows", "M2",
    sql="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1234",
)
def _(spark, sf):
    return split.most_recent(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", 1234)


@query("orders_by_date", "O1", sql="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def _(spark, sf):
    return ranking.sort_by_date(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query(
    "largest_orders", "O2",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    doubles="o_totalprice",
)
def _(spark, sf):
    return ranking.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 25, ["o_orderkey"])


@query(
    "customers_by_absolute_balance", "O3",
    sql="SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey",
    doubles="c_acctbal",
)
def _(spark, sf):
    return ranking.sort_by_abs(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"])


@query(
    "best_customer", "O5",
    sql="""
    SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1 ORDER BY spent DESC, o_custkey LIMIT 1
    """,
    doubles="spent",
)
def _(spark, sf):
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return ranking.best_row(spent, "spent", ["o_custkey"])
