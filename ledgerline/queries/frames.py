"""Loan-like inputs derived from the given tables. One SQL text serves both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerline.queries.base import table
from ledgerline.session import stored

# Raw loans: text as it would arrive, with junk, blanks and impossible values.
RAW_LOANS = """
SELECT o_orderkey AS loan_id,
  CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE ' ' || cast(o_totalprice AS string) || ' ' END AS loan_amnt,
  CASE WHEN o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
  cast(5 + o_orderkey % 20 AS string) || '.' || cast(o_orderkey % 10 AS string) || '%' AS int_rate,
  CASE WHEN o_custkey % 41 = 0 THEN '' ELSE cast(o_custkey % 250 AS string) || '.5%' END AS revol_util,
  CASE o_orderkey % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
    WHEN 11 THEN 'n/a' WHEN 12 THEN NULL ELSE cast(o_orderkey % 13 AS string) || ' years' END AS emp_length,
  CASE WHEN o_orderkey % 89 = 0 THEN 'unknown'
    ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(1 + 3 * (o_custkey % 12) AS int), 3) || '-'
      || cast(1960 + o_custkey % 40 AS string) END AS earliest_cr_line,
  CASE WHEN o_orderkey % 101 = 0 THEN 'soon' ELSE cast(cast(o_orderdate AS date) AS string) END AS issue_d,
  CASE o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'O' THEN 'Fully Paid' ELSE 'Current' END AS loan_status,
  cast(o_custkey % 50 - 1 AS string) AS dti,
  cast(c_acctbal * 12 AS string) AS annual_inc,
  cast(o_custkey % 30 AS string) AS open_acc,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderkey % 60 AS string) END AS mths_since_last_record,
  cast(o_totalprice AS string) AS total_pymnt,
  cast(o_orderkey AS string) AS id,
  c_mktsegment AS purpose
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Typed loans, as they are after cleaning.
LOANS = """
SELECT o_orderkey AS loan_id,
  cast(o_orderdate AS date) AS issue_d,
  cast(cast(1960 + o_custkey % 40 AS string) || '-0' || cast(1 + o_custkey % 9 AS string) || '-01' AS date) AS earliest_cr_line,
  o_totalprice AS loan_amnt,
  cast(CASE WHEN o_orderkey % 2 = 0 THEN 36 ELSE 60 END AS int) AS term,
  cast(CASE WHEN o_orderkey % 83 = 0 THEN 0 ELSE 5 + o_orderkey % 20 END AS double) AS int_rate,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal * 12 END AS annual_inc,
  CASE WHEN o_custkey % 50 = 0 THEN NULL WHEN o_custkey % 499 = 1 THEN 999e0 ELSE cast(o_custkey % 50 AS double) END AS dti,
  cast(o_custkey % 30 AS double) AS open_acc,
  cast(o_custkey % 30 + o_orderkey % 20 AS double) AS total_acc,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN cast(o_orderkey % 3 AS double) ELSE 0e0 END AS delinq_2yrs,
  CASE WHEN o_orderkey % 7 = 0 THEN 1e0 ELSE 0e0 END AS pub_rec,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE cast(o_orderkey % 25 AS double) END AS mths_since_recent_inq,
  cast(600 + o_custkey % 250 AS double) AS fico_range_low,
  cast(604 + o_custkey % 250 AS double) AS fico_range_high,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL
    ELSE substr('ABCDEFG', cast(1 + o_custkey % 7 AS int), 1) || cast(1 + o_orderkey % 5 AS string) END AS sub_grade,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'MORTGAGE' WHEN 'AUTOMOBILE' THEN 'RENT' WHEN 'MACHINERY' THEN 'OWN'
    WHEN 'HOUSEHOLD' THEN 'ANY' ELSE NULL END AS home_ownership,
  CASE WHEN o_orderkey % 1501 = 7 THEN 'wedding' WHEN o_orderkey % 1201 = 8 THEN 'educational'
    ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'car' WHEN '3-MEDIUM' THEN 'house'
      WHEN '4-NOT SPECIFIED' THEN 'medical' ELSE 'moving' END END AS purpose,
  CASE c_nationkey WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL' WHEN 4 THEN 'IL'
    ELSE 'S' || cast(c_nationkey AS string) END AS addr_state,
  CASE WHEN o_orderkey % 2 = 0 THEN 'w' ELSE 'f' END AS initial_list_status,
  CASE o_orderkey % 3 WHEN 0 THEN 'Not Verified' WHEN 1 THEN 'Verified' ELSE 'Source Verified' END AS verification_status,
  cast(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS int) AS charged_off
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Monthly series in long form: the mean order value by priority, and by status.
MACRO_LONG = """
SELECT series_id, observation_date, avg(o_totalprice) / min(scale) AS value
FROM (
  SELECT cast(date_trunc('month', o_orderdate) AS date) AS observation_date, o_totalprice,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'UNRATE' WHEN '2-HIGH' THEN 'FEDFUNDS' WHEN '3-MEDIUM' THEN 'CPIAUCSL'
      WHEN '4-NOT SPECIFIED' THEN 'CAUR' ELSE 'TXUR' END AS series_id,
    CASE o_orderpriority WHEN '2-HIGH' THEN 500000e0 WHEN '3-MEDIUM' THEN 1000e0 ELSE 50000e0 END AS scale
  FROM {orders}
  UNION ALL
  SELECT cast(date_trunc('month', o_orderdate) AS date), o_totalprice,
    CASE o_orderstatus WHEN 'F' THEN 'NYUR' WHEN 'O' THEN 'FLUR' ELSE 'ILUR' END, 50000e0
  FROM {orders}
) AS m
GROUP BY series_id, observation_date
"""

# Scored rows: a 0/1 label, a score of few distinct values and one of many.
SCORED = """
SELECT CASE WHEN cast(round(l_discount * 100) AS int) + l_orderkey % 10 > 12 THEN 1 ELSE 0 END AS label,
  l_discount * 10 AS coarse,
  l_discount * 5 + l_quantity / 256e0 + l_extendedprice / 1048576e0 AS fine,
  l_returnflag AS part
FROM {lineitem}
"""

# Learnable rows: the label depends on three of the features.
LEARNABLE = """
SELECT l_orderkey * 8 + l_linenumber AS row_id,
  l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
  cast(l_linenumber AS double) AS line, o_totalprice AS total,
  cast(CASE WHEN l_discount * 100 + l_quantity / 5e0 + l_orderkey % 7 > 14 THEN 1 ELSE 0 END AS int) AS label,
  cast(o_orderdate AS date) AS day
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

# Documents with their labels: most documents have none, so the label columns hold NULLs.
LABELLED = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

# Applicants: inputs of the scoring rules, some broken.
APPLICANTS = """
SELECT o_orderkey AS applicant_id,
  CASE WHEN o_orderkey % 53 = 0 THEN 0e0 ELSE o_totalprice / 10 END AS loan_amnt,
  cast(CASE o_orderkey % 31 WHEN 0 THEN 48 ELSE 36 + 24 * (o_orderkey % 2) END AS int) AS term,
  cast(o_orderkey % 103 AS double) AS int_rate,
  CASE WHEN o_orderkey % 59 = 0 THEN 'h9' ELSE lower(substr('ABCDEFG', cast(1 + o_custkey % 7 AS int), 1)) || cast(1 + o_orderkey % 5 AS string) END AS sub_grade,
  c_acctbal * 12 AS annual_inc,
  cast(o_custkey % 50 - 1 AS double) AS dti,
  cast(290 + o_custkey % 580 AS int) AS fico_score,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'mortgage' WHEN 'AUTOMOBILE' THEN 'Rent' WHEN 'MACHINERY' THEN 'OWN'
    WHEN 'HOUSEHOLD' THEN 'ANY' ELSE 'tent' END AS home_ownership,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE 'Debt Consolidation' END AS purpose,
  cast(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 40 - 1 END AS int) AS open_acc,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(o_custkey % 210 AS double) END AS revol_util,
  cast(CASE WHEN o_orderkey % 67 = 0 THEN -1 WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 50 END AS int) AS total_acc,
  cast(CASE WHEN o_orderkey % 71 = 0 THEN -2 WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey % 4 END AS int) AS delinq_2yrs,
  cast(CASE WHEN o_orderkey % 73 = 0 THEN -1 WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_custkey % 3 END AS int) AS pub_rec,
  cast(CASE WHEN o_orderkey % 79 = 0 THEN -3 WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey % 6 END AS int) AS inq_last_6mths,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Unknown' WHEN o_orderkey % 7 = 1 THEN NULL ELSE 'Verified' END AS verification_status
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""


def _tables(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def frame(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in _tables(text)})


def frame_once(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """``frame`` for fits, which read their rows many times: the join is made once, later passes scan its few columns."""
    return stored(frame(spark, sf_dir, text), "frame")


def sql(text: str) -> str:
    """The text as a subquery over the pre-registered tables."""
    return "(" + text.format(**{name: name for name in _tables(text)}) + ")"
