"""Cleaning, typing and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.functions import leading_integer, lookup
from ledgerline.operators import clean, filters
from ledgerline.plans.layers import silver
from ledgerline.queries.base import query, table
from ledgerline.queries.frames import LABELLED, LOANS, RAW_LOANS, frame, sql


@query(
    "sanitized_column_names", "P1",
    sql='SELECT o_orderkey AS order_key, o_totalprice AS unnamed_0, o_orderstatus AS unnamed_0_2, o_orderpriority AS col FROM orders',
)
def _(spark, sf):
    odd = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key!"),
        F.col("o_totalprice").alias("Unnamed: 0"),
        F.col("o_orderstatus").alias("unnamed_0"),
        F.col("o_orderpriority").alias("%%"),
    )
    return clean.sanitize_columns(odd)


@query(
    "tolerant_double_cast", "P2",
    sql=f"SELECT loan_id, try_cast(trim(loan_amnt) AS double) AS loan_amnt, try_cast(annual_inc AS double) AS annual_inc FROM {sql(RAW_LOANS)}",
    doubles="loan_amnt annual_inc",
)
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("loan_id", "loan_amnt", "annual_inc")
    return clean.cast_doubles(raw, cfg.NUMERIC_COLUMNS)


@query(
    "binary_target", "P3",
    sql=f"""
    SELECT loan_id, cast(CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS int) AS charged_off
    FROM {sql(RAW_LOANS)} WHERE loan_status IN ('Charged Off', 'Fully Paid')
    """,
)
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("loan_id", "loan_status")
    return clean.binary_target(raw, "loan_status", cfg.POSITIVE_STATUS, cfg.NEGATIVE_STATUS, cfg.TARGET)


@query("rows_of_status", "F2", sql="SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def _(spark, sf):
    return filters.has_status(table(spark, sf, "orders"), "o_orderstatus", ["F", "P"]).select("o_orderkey", "o_orderstatus")


@query(
    "sparse_columns_dropped", "P4",
    sql=f"SELECT doc_id, lang, source, n_chars FROM {sql(LABELLED)}",
)
def _(spark, sf):
    return clean.drop_sparse_columns(frame(spark, sf, LABELLED), 0.30)


@query(
    "listed_columns_dropped", "P5 P6 P7 P18",
    sql=f"""
    SELECT loan_id, issue_d, loan_amnt, fico_range_low FROM {sql(LOANS)}
    """,
    doubles="loan_amnt fico_range_low",
)
def _(spark, sf):
    wide = frame(spark, sf, LOANS).select(
        "loan_id", "issue_d", "loan_amnt", "fico_range_low", "fico_range_high",
        F.col("loan_amnt").alias("total_pymnt"), F.col("loan_id").alias("id"),
    )
    return clean.drop_present(wide, cfg.LEAKAGE_COLUMNS + cfg.UNINFORMATIVE_COLUMNS + cfg.CORRELATED_COLUMNS)


@query(
    "numeric_text_parsed", "P8 P9",
    sql=f"""
    SELECT loan_id, try_cast(regexp_extract(trim(term), '(\\d+)', 1) AS int) AS term,
      try_cast(replace(int_rate, '%', '') AS double) AS int_rate,
      try_cast(replace(revol_util, '%', '') AS double) AS revol_util
    FROM {sql(RAW_LOANS)}
    """,
    doubles="int_rate revol_util",
)
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("loan_id", "term", "int_rate", "revol_util")
    return clean.parse_numeric_text(raw, ["term"], ["int_rate", "revol_util"])


@query(
    "brand_numbers", "P8",
    sql="SELECT p_partkey, try_cast(regexp_extract(p_brand, '(\\d+)', 1) AS int) AS brand FROM part",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", leading_integer("p_brand").alias("brand"))


@query(
    "ordinal_text_mapped", "P10 J3",
    sql=f"""
    SELECT loan_id, cast(CASE WHEN emp_length = '< 1 year' THEN 0 WHEN emp_length = '10+ years' THEN 10
      WHEN emp_length IS NULL OR emp_length = 'n/a' THEN -1
      ELSE cast(split_part(emp_length, ' ', 1) AS int) END AS int) AS emp_length
    FROM {sql(RAW_LOANS)}
    """,
)
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("loan_id", "emp_length")
    return clean.map_ordinal_text(raw, "emp_length", cfg.EMP_LENGTH_ORDINALS)


@query(
    "date_text_parsed", "P11",
    sql=f"""
    SELECT loan_id, cast(try_strptime(earliest_cr_line, '%b-%Y') AS date) AS earliest_cr_line,
      try_cast(issue_d AS date) AS issue_d
    FROM {sql(RAW_LOANS)}
    """,
)
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("loan_id", "earliest_cr_line", "issue_d")
    return clean.parse_dates(raw, month_text=["earliest_cr_line"], iso=["issue_d"])


_TYPED = f"""(
  SELECT loan_id, try_cast(dti AS double) AS dti, try_cast(annual_inc AS double) AS annual_inc,
    try_cast(open_acc AS double) AS open_acc, try_cast(replace(revol_util, '%', '') AS double) AS revol_util
  FROM {sql(RAW_LOANS)})"""


def _typed(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("loan_id", "dti", "annual_inc", "open_acc", "revol_util")
    return clean.cast_doubles(clean.parse_numeric_text(raw, percent_columns=["revol_util"]), ["dti", "annual_inc", "open_acc"])


@query(
    "impossible_values_nulled", "P12",
    sql=f"""
    SELECT loan_id, CASE WHEN dti < 0 THEN NULL ELSE dti END AS dti,
      CASE WHEN annual_inc < 0 THEN NULL ELSE annual_inc END AS annual_inc,
      CASE WHEN open_acc < 0 THEN NULL ELSE open_acc END AS open_acc,
      CASE WHEN revol_util > 200 THEN NULL ELSE revol_util END AS revol_util
    FROM {_TYPED}
    """,
    doubles="dti annual_inc open_acc revol_util",
)
def _(spark, sf):
    return clean.null_impossible(_typed(spark, sf), cfg.IMPOSSIBLE_VALUES)


@query(
    "impossible_value_counts", "P12 A7",
    sql=f"""
    WITH t AS (SELECT * FROM {_TYPED})
    SELECT 'dti' AS "column", count(*) FILTER (dti < 0) AS fixes FROM t
    UNION ALL SELECT 'annual_inc', count(*) FILTER (annual_inc < 0) FROM t
    UNION ALL SELECT 'open_acc', count(*) FILTER (open_acc < 0) FROM t
    UNION ALL SELECT 'revol_util', count(*) FILTER (revol_util > 200) FROM t
    """,
)
def _(spark, sf):
    return clean.count_impossible(_typed(spark, sf), cfg.IMPOSSIBLE_VALUES)


@query(
    "columns_selected_by_type", "P13",
    sql=f"SELECT loan_id, loan_amnt, term, int_rate, annual_inc, dti FROM {sql(LOANS)}",
    doubles="loan_amnt int_rate annual_inc dti",
)
def _(spark, sf):
    some = frame(spark, sf, LOANS).select(
        "loan_id", "issue_d", "loan_amnt", "term", "int_rate", "annual_inc", "dti", "sub_grade", "purpose", "charged_off"
    )
    return some.select(*clean.columns_by_type(some, [cfg.TARGET])["numeric"])


@query(
    "column_overview", "P14",
    sql=f"""
    WITH t AS (SELECT * FROM {sql(LABELLED)})
    SELECT cast(1 AS int) AS position, 'doc_id' AS "column", 'bigint' AS dtype, 100e0 * (count(*) - count(doc_id)) / count(*) AS null_pct FROM t
    UNION ALL SELECT 2, 'lang', 'string', 100e0 * (count(*) - count(lang)) / count(*) FROM t
    UNION ALL SELECT 3, 'source', 'string', 100e0 * (count(*) - count(source)) / count(*) FROM t
    UNION ALL SELECT 4, 'n_chars', 'bigint', 100e0 * (count(*) - count(n_chars)) / count(*) FROM t
    UNION ALL SELECT 5, 'quality', 'int', 100e0 * (count(*) - count(quality)) / count(*) FROM t
    UNION ALL SELECT 6, 'toxic', 'int', 100e0 * (count(*) - count(toxic)) / count(*) FROM t
    """,
    doubles="null_pct",
)
def _(spark, sf):
    return clean.column_overview(frame(spark, sf, LABELLED))


@query(
    "class_codes_relabelled", "P19",
    sql=f"""
    SELECT loan_id, CASE charged_off WHEN 0 THEN 'Fully Paid' ELSE 'Charged Off' END AS outcome FROM {sql(LOANS)}
    """,
)
def _(spark, sf):
    coded = frame(spark, sf, LOANS).select("loan_id", "charged_off")
    return clean.relabel(coded, "charged_off", cfg.CLASS_LABELS, "outcome").drop("charged_off")


@query(
    "rows_in_date_range", "F1",
    sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1998-09-30'",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return filters.in_date_range(orders, "o_orderdate", "1996-03-01", "1998-09-30").select("o_orderkey", "o_totalprice")


@query(
    "rows_in_years", "F3",
    sql="SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) IN (1995, 1996, 1999)",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return filters.in_years(orders, "o_orderdate", [1995, 1996, 1999]).select("o_orderkey", "o_totalprice")


@query(
    "rows_known_and_listed", "F4",
    sql=f"""
    SELECT loan_id, addr_state FROM {sql(LOANS)}
    WHERE addr_state IN ('CA','TX','NY','FL','IL') AND annual_inc IS NOT NULL AND sub_grade IS NOT NULL
    """,
)
def _(spark, sf):
    loans = frame(spark, sf, LOANS)
    known = filters.not_null(loans, ["annual_inc", "sub_grade"])
    return filters.value_in(known, "addr_state", list(cfg.STATE_SERIES)).select("loan_id", "addr_state")


@query(
    "rows_breaking_a_rule", "F5",
    sql="SELECT l_orderkey, l_linenumber, l_tax, l_discount FROM lineitem WHERE l_tax > l_discount",
    doubles="l_tax l_discount",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return filters.violating(lines, "l_tax > l_discount")


@query(
    "cleaned_loans", "P2 P3 P4 P5 P6 P8 P9 P10 P11 P12",
    sql=f"""
    WITH t AS (SELECT * FROM {sql(RAW_LOANS)} WHERE loan_status IN ('Charged Off', 'Fully Paid'))
    SELECT loan_id, try_cast(trim(loan_amnt) AS double) AS loan_amnt,
      try_cast(regexp_extract(trim(term), '(\\d+)', 1) AS int) AS term,
      try_cast(replace(int_rate, '%', '') AS double) AS int_rate,
      CASE WHEN try_cast(replace(revol_util, '%', '') AS double) > 200 THEN NULL
        ELSE try_cast(replace(revol_util, '%', '') AS double) END AS revol_util,
      cast(CASE WHEN emp_length = '< 1 year' THEN 0 WHEN emp_length = '10+ years' THEN 10
        WHEN emp_length IS NULL OR emp_length = 'n/a' THEN -1
        ELSE cast(split_part(emp_length, ' ', 1) AS int) END AS int) AS emp_length,
      cast(try_strptime(earliest_cr_line, '%b-%Y') AS date) AS earliest_cr_line,
      try_cast(issue_d AS date) AS issue_d,
      CASE WHEN try_cast(dti AS double) < 0 THEN NULL ELSE try_cast(dti AS double) END AS dti,
      CASE WHEN try_cast(annual_inc AS double) < 0 THEN NULL ELSE try_cast(annual_inc AS double) END AS annual_inc,
      try_cast(open_acc AS double) AS open_acc,
      purpose, cast(CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS int) AS charged_off
    FROM t
    """,
    doubles="loan_amnt int_rate revol_util dti annual_inc open_acc",
)
def _(spark, sf):
    return silver(clean.cast_doubles(frame(spark, sf, RAW_LOANS), cfg.NUMERIC_COLUMNS))


@query(
    "text_functions", "P10 P19",
    sql="""
    SELECT o_orderkey, upper(o_orderpriority) AS up, lower(replace(o_orderpriority, ' ', '_')) AS low,
      CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS code
    FROM orders
    """,
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.upper("o_orderpriority").alias("up"),
        F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit("_"))).alias("low"),
        lookup("o_orderstatus", {"F": 1, "O": 0}, -1).alias("code"),
    )
