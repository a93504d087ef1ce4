"""Profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators import profile
from ledgerline.operators.clean import cast_doubles
from ledgerline.queries.base import query, table
from ledgerline.queries.frames import LABELLED, LEARNABLE, LOANS, RAW_LOANS, frame, sql

_LOANS, _RAW, _LABELLED, _LEARNABLE = sql(LOANS), sql(RAW_LOANS), sql(LABELLED), sql(LEARNABLE)


def _union(template: str, columns) -> str:
    return "\nUNION ALL ".join(template.format(c=c) for c in columns)


@query(
    "rows_per_year", "A1 F3",
    sql="""
    SELECT cast(year(o_orderdate) AS int) AS year, count(*) AS n, 100e0 * count(*) / sum(count(*)) OVER () AS pct
    FROM orders GROUP BY 1
    """,
    doubles="pct",
)
def _(spark, sf):
    return profile.year_counts(table(spark, sf, "orders"), "o_orderdate")


@query(
    "table_shape", "A2",
    sql="SELECT count(*) AS n_rows, cast(6 AS int) AS n_columns, min(o_orderdate) AS date_min, max(o_orderdate) AS date_max FROM orders",
)
def _(spark, sf):
    return profile.table_shape(table(spark, sf, "orders"), "o_orderdate")


@query(
    "date_order_check", "A3",
    sql="""
    SELECT count(*) - 1 AS n_pairs, count(*) FILTER (o_orderdate < prev) AS n_inversions, count(*) FILTER (o_orderdate < prev) = 0 AS is_sorted
    FROM (SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderkey) AS prev FROM orders) AS p
    """,
)
def _(spark, sf):
    return profile.order_check(table(spark, sf, "orders"), "o_orderdate", "o_orderkey")


_LABEL_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
_MISSING = "(" + _union(
    f"SELECT '{{c}}' AS \"column\", count(*) - count({{c}}) AS missing, count(*) AS n FROM {_LABELLED}", _LABEL_COLUMNS
) + ")"


@query(
    "missing_rates", "A4",
    sql=f"""
    SELECT "column", missing, missing * 1e0 / n AS rate,
      CASE WHEN missing * 1e0 / n > 0.3 THEN 'DROP' WHEN missing > 0 THEN 'impute' ELSE 'keep' END AS action
    FROM {_MISSING}
    """,
    doubles="rate",
)
def _(spark, sf):
    return profile.missing_rates(frame(spark, sf, LABELLED))


@query(
    "missing_summary", "A4",
    sql=f"""
    SELECT cast(sum(missing) AS bigint) AS missing_cells, 100e0 * sum(missing) / sum(n) AS missing_pct,
      count(*) FILTER (missing > 0) AS columns_with_any, count(*) FILTER (missing * 1e0 / n > 0.3) AS columns_over,
      count(*) AS n_columns
    FROM {_MISSING}
    """,
    doubles="missing_pct",
)
def _(spark, sf):
    return profile.missing_summary(frame(spark, sf, LABELLED))


@query(
    "duplicate_rows", "A5",
    sql="""
    SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem) AS d) AS n_duplicates
    FROM lineitem
    """,
)
def _(spark, sf):
    return profile.duplicate_count(table(spark, sf, "lineitem"))


@query(
    "duplicate_keys", "A6",
    sql="SELECT count(*) AS n_rows, count(*) - count(DISTINCT l_orderkey) AS n_duplicates FROM lineitem",
)
def _(spark, sf):
    return profile.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey"])


@query(
    "consistency_report", "A7 F5",
    sql=f"""
    WITH t AS (SELECT try_cast(dti AS double) AS dti, try_cast(annual_inc AS double) AS annual_inc, try_cast(open_acc AS double) AS open_acc FROM {_RAW})
    SELECT rule, violations, CASE WHEN violations = 0 THEN 'OK' ELSE 'WARNING' END AS status FROM (
      SELECT 'dti < 0' AS rule, count(*) FILTER (dti < 0) AS violations FROM t
      UNION ALL SELECT 'annual_inc < 0', count(*) FILTER (annual_inc < 0) FROM t
      UNION ALL SELECT 'open_acc < 0', count(*) FILTER (open_acc < 0) FROM t) AS u
    """,
)
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS).select("dti", "annual_inc", "open_acc")
    return profile.consistency_report(cast_doubles(raw, cfg.NUMERIC_COLUMNS), cfg.CONSISTENCY_RULES)


_SUMMARY = """
SELECT '{c}' AS "column", min(v) AS min, median(v) AS median, avg(v) AS mean, max(v) AS max,
  count(*) FILTER (v < m - 3 * s OR v > m + 3 * s) AS outliers
FROM (SELECT {e} AS v FROM {t}) AS x, (SELECT avg({e}) AS m, stddev_samp({e}) AS s FROM {t}) AS y
"""


@query(
    "numeric_summary", "A8",
    sql="UNION ALL".join(
        _SUMMARY.format(c=c, e=e, t=_RAW)
        for c, e in [
            ("loan_amnt", "try_cast(trim(loan_amnt) AS double)"),
            ("int_rate", "try_cast(replace(int_rate, '%', '') AS double)"),
            ("annual_inc", "try_cast(annual_inc AS double)"),
        ]
    ),
    doubles="min median mean max",
)
def _(spark, sf):
    return profile.numeric_summary(frame(spark, sf, RAW_LOANS), ["loan_amnt", "int_rate", "annual_inc"])


@query(
    "value_counts", "A9",
    sql=f"""
    SELECT home_ownership AS value, count(*) AS n, 100e0 * count(*) / sum(count(*)) OVER () AS pct
    FROM {_LOANS} GROUP BY 1
    """,
    doubles="pct",
)
def _(spark, sf):
    return profile.value_counts(frame(spark, sf, LOANS), "home_ownership")


@query(
    "top_values", "A9 O2",
    sql=f"""
    SELECT addr_state AS value, count(*) AS n, 100e0 * count(*) / (SELECT count(*) FROM {_LOANS}) AS pct
    FROM {_LOANS} GROUP BY 1 ORDER BY n DESC, value LIMIT 15
    """,
    doubles="pct",
)
def _(spark, sf):
    return profile.value_counts(frame(spark, sf, LOANS), "addr_state", top=15)


@query(
    "class_balance", "A10",
    sql="""
    SELECT n_total, n_negative, n_positive, n_positive * 1e0 / n_total AS positive_rate, n_negative * 1e0 / n_positive AS imbalance,
      CASE WHEN n_negative * 1e0 / n_positive < 5 THEN 'Moderate' ELSE 'Severe' END AS severity
    FROM (SELECT count(*) AS n_total, count(*) FILTER (o_orderstatus = 'O') AS n_negative,
      count(*) FILTER (o_orderstatus = 'F') AS n_positive FROM orders WHERE o_orderstatus IN ('F', 'O')) AS c
    """,
    doubles="positive_rate imbalance",
)
def _(spark, sf):
    return profile.class_balance(table(spark, sf, "orders"), "o_orderstatus", "F", "O")


@query(
    "target_distribution", "A10 P19",
    sql=f"""
    SELECT CASE charged_off WHEN 0 THEN 'Fully Paid' ELSE 'Charged Off' END AS label, count(*) AS n,
      100e0 * count(*) / sum(count(*)) OVER () AS pct
    FROM {_LOANS} GROUP BY 1
    """,
    doubles="pct",
)
def _(spark, sf):
    return profile.target_distribution(frame(spark, sf, LOANS), "charged_off", cfg.CLASS_LABELS)


@query(
    "yearly_rates", "A11",
    sql=f"""
    SELECT cast(year(issue_d) AS int) AS year, count(*) AS n, cast(sum(charged_off) AS bigint) AS n_positive, avg(charged_off) AS rate
    FROM {_LOANS} GROUP BY 1
    """,
    doubles="rate",
)
def _(spark, sf):
    return profile.yearly_rates(frame(spark, sf, LOANS), "issue_d", "charged_off")


@query(
    "drift_summary", "A11",
    sql=f"""
    SELECT max(rate) - min(rate) AS rate_range, max(rate) - min(rate) > 0.05 AS drifted
    FROM (SELECT year(issue_d) AS y, avg(charged_off) AS rate FROM {_LOANS} GROUP BY 1) AS r
    """,
    doubles="rate_range",
)
def _(spark, sf):
    return profile.drift_summary(frame(spark, sf, LOANS), "issue_d", "charged_off")


def _census_sql() -> str:
    text = ["loan_amnt", "term", "int_rate", "revol_util", "emp_length", "issue_d", "dti", "purpose"]
    number = "count(try_cast(split_part(trim(rtrim({c}, '%')), ' ', 1) AS double)) = count({c})"
    parts = [
        f"SELECT '{c}' AS \"column\", CASE WHEN {number.format(c=c)} THEN 'numeric_text' ELSE 'categorical' END AS kind FROM {_RAW}"
        for c in text
    ]
    return "SELECT 'loan_id' AS \"column\", 'numeric' AS kind UNION ALL " + " UNION ALL ".join(parts)


@query("column_kinds", "A12", sql=_census_sql())
def _(spark, sf):
    raw = frame(spark, sf, RAW_LOANS)
    return profile.type_census(
        raw.select("loan_id", "loan_amnt", "term", "int_rate", "revol_util", "emp_length", "issue_d", "dti", "purpose")
    )


@query(
    "categorical_cardinality", "A13",
    sql=_union(
        f"""SELECT '{{c}}' AS "column", count(DISTINCT {{c}}) AS n_unique,
          (SELECT {{c}} FROM {_LOANS} WHERE {{c}} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_value FROM {_LOANS}""",
        ["sub_grade", "home_ownership", "purpose", "addr_state"],
    ),
)
def _(spark, sf):
    return profile.cardinality(frame(spark, sf, LOANS), ["sub_grade", "home_ownership", "purpose", "addr_state"])


@query(
    "describe_numeric", "A14",
    sql=_union(
        f"""SELECT '{{c}}' AS "column", quantile_cont({{c}}, 0.25) AS q1, median({{c}}) AS median, quantile_cont({{c}}, 0.75) AS q3,
          count({{c}}) AS n, avg({{c}}) AS mean, stddev_samp({{c}}) AS std, min({{c}}) AS min, max({{c}}) AS max,
          skewness({{c}}) AS skew, kurtosis({{c}}) AS kurtosis FROM {_LOANS}""",
        ["loan_amnt", "annual_inc", "dti", "open_acc"],
    ),
    doubles="q1 median q3 mean std min max skew kurtosis",
)
def _(spark, sf):
    return profile.describe(frame(spark, sf, LOANS), ["loan_amnt", "annual_inc", "dti", "open_acc"])


_FENCES = """
SELECT '{c}' AS "column", {cls} AS class, {c} AS v, q1, q2, q3, q1 - 1.5e0 * (q3 - q1) AS low, q3 + 1.5e0 * (q3 - q1) AS high
FROM {t} AS x, (SELECT quantile_cont({c}, 0.25) AS q1, median({c}) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {t} WHERE {w}) AS q
WHERE {w}
"""


@query(
    "iqr_outliers", "A15",
    sql="SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT "column", count(*) FILTER (v < low OR v > high) AS outliers, 100e0 * count(*) FILTER (v < low OR v > high) / count(*) AS pct,
        min(v) AS min, max(v) AS max, min(q1) AS q1, min(q3) AS q3 FROM ({_FENCES.format(c=c, cls="'all'", t=_LOANS, w='true')}) AS f GROUP BY 1"""
        for c in ["loan_amnt", "annual_inc", "dti", "delinq_2yrs", "pub_rec"]
    ) + ") AS o WHERE outliers > 0",
    doubles="pct min max q1 q3",
)
def _(spark, sf):
    return profile.iqr_outliers(frame(spark, sf, LOANS), ["loan_amnt", "annual_inc", "dti", "delinq_2yrs", "pub_rec"])


@query(
    "histogram_50_bins", "A16",
    sql="""
    SELECT cast(least(floor((o_totalprice - lo) / w) + 1, 50) AS int) AS bin, min(lo) + (least(floor((o_totalprice - lo) / w) + 1, 50) - 1) * min(w) AS lower,
      min(lo) + least(floor((o_totalprice - lo) / w) + 1, 50) * min(w) AS upper, count(*) AS n
    FROM orders, (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 50e0 AS w FROM orders) AS e
    GROUP BY least(floor((o_totalprice - lo) / w) + 1, 50)
    """,
    doubles="lower upper",
)
def _(spark, sf):
    return profile.histogram(table(spark, sf, "orders"), "o_totalprice", 50)


def _box_sql(groups) -> str:
    return " UNION ALL ".join(
        f"""SELECT "column", class, count(v) AS n, min(q1) AS q1, min(q2) AS median, min(q3) AS q3,
        min(v) FILTER (v BETWEEN low AND high) AS whisker_low, max(v) FILTER (v BETWEEN low AND high) AS whisker_high,
        count(*) FILTER (v < low OR v > high) AS fliers
        FROM ({_FENCES.format(c=c, cls=f"'{cls}'", t=_LOANS, w=where)}) AS f GROUP BY 1, 2"""
        for c in ["loan_amnt", "dti"]
        for cls, where in groups
    )


@query("box_stats", "A17", sql=_box_sql([("all", "true")]), doubles="q1 median q3 whisker_low whisker_high")
def _(spark, sf):
    return profile.box_stats(frame(spark, sf, LOANS), ["loan_amnt", "dti"])


@query(
    "box_stats_by_class", "A17",
    sql=_box_sql([("0", "charged_off = 0"), ("1", "charged_off = 1")]),
    doubles="q1 median q3 whisker_low whisker_high",
)
def _(spark, sf):
    return profile.box_stats(frame(spark, sf, LOANS), ["loan_amnt", "dti"], "charged_off", [0, 1])


@query(
    "rates_by_category", "A18",
    sql=_union(
        f"SELECT '{{c}}' AS \"column\", {{c}} AS value, avg(charged_off) AS rate, count(*) AS n FROM {_LOANS} WHERE {{c}} IS NOT NULL GROUP BY 2",
        ["home_ownership", "verification_status", "purpose"],
    ),
    doubles="rate",
)
def _(spark, sf):
    columns = ["home_ownership", "verification_status", "purpose", "addr_state", "sub_grade"]
    return profile.rates_by_category(frame(spark, sf, LOANS), columns, "charged_off")


_CORR_COLUMNS = ["quantity", "price", "discount", "tax", "line", "total"]


@query(
    "correlation_matrix", "A19",
    sql=" UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {_LEARNABLE}"
        for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i + 1:]
    ),
    doubles="r",
)
def _(spark, sf):
    return profile.correlations(frame(spark, sf, LEARNABLE), _CORR_COLUMNS)


@query(
    "correlation_matrix_wide", "A19",
    sql=" UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {_LOANS}"
        for i, a in enumerate(["loan_amnt", "annual_inc", "dti", "total_acc"])
        for b in ["loan_amnt", "annual_inc", "dti", "total_acc"][i + 1:]
    ),
    doubles="r",
)
def _(spark, sf):
    # The columns hold NULLs in different rows.
    columns = ["loan_amnt", "annual_inc", "dti", "total_acc"]
    return profile.correlations(frame(spark, sf, LOANS), columns)


@query(
    "top_target_correlations", "A20 O2 O3",
    sql="SELECT \"column\", r, abs(r) AS abs_r FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", corr({c}, label) AS r FROM {_LEARNABLE}" for c in _CORR_COLUMNS
    ) + ") AS c ORDER BY abs(r) DESC, \"column\" LIMIT 4",
    doubles="r abs_r",
)
def _(spark, sf):
    return profile.top_correlated(frame(spark, sf, LEARNABLE), _CORR_COLUMNS, "label", 4)


@query(
    "strongly_correlated_pairs", "A21 O3",
    sql="SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {_LOANS}"
        for a, b in [("fico_range_low", "fico_range_high"), ("fico_range_low", "open_acc"), ("fico_range_low", "total_acc"),
                     ("fico_range_high", "open_acc"), ("fico_range_high", "total_acc"), ("open_acc", "total_acc")]
    ) + ") AS c WHERE abs(r) > 0.8",
    doubles="r",
)
def _(spark, sf):
    return profile.correlated_pairs(frame(spark, sf, LOANS), ["fico_range_low", "fico_range_high", "open_acc", "total_acc"], 0.8)


@query(
    "skew_screen", "A22 O2",
    sql="SELECT * FROM (" + _union(
        f"SELECT '{{c}}' AS \"column\", skewness({{c}}) AS skew, skewness(ln(1 + CASE WHEN {{c}} >= 0 THEN {{c}} END)) AS log_skew FROM {_LOANS}",
        ["loan_amnt", "annual_inc", "dti", "delinq_2yrs", "pub_rec"],
    ) + ") AS s WHERE abs(skew) > 1 ORDER BY abs(skew) DESC LIMIT 8",
    doubles="skew log_skew",
)
def _(spark, sf):
    return profile.skew_screen(
        frame(spark, sf, LOANS), ["loan_amnt", "annual_inc", "dti", "delinq_2yrs", "pub_rec"], limit=1.0, top=8
    )
