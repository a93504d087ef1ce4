"""Monthly series, joins and grouped insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators import features, insights, models, ranking, timeseries
from ledgerline.plans.layers import gold_macro, silver_macro
from ledgerline.queries.base import query, table
from ledgerline.queries.frames import LOANS, MACRO_LONG, frame, sql
from ledgerline.session import stored

_LOANS, _LONG = sql(LOANS), sql(MACRO_LONG)
_IDS = [*cfg.NATIONAL_SERIES, *cfg.STATE_SERIES.values()]
_WIDE = (
    "(SELECT observation_date AS year_month, "
    + ", ".join(f"max(CASE WHEN series_id = '{s}' THEN value END) AS {s}" for s in _IDS)
    + f" FROM {_LONG} GROUP BY 1)"
)
_WIDE_YOY = f"(SELECT *, (CPIAUCSL / lag(CPIAUCSL, 12) OVER (ORDER BY year_month) - 1) * 100 AS CPI_YOY FROM {_WIDE} AS w)"
_JOINED = f"""(
  SELECT l.*, m.UNRATE, m.FEDFUNDS, m.CPIAUCSL, m.CPI_YOY,
    CASE addr_state WHEN 'CA' THEN CAUR WHEN 'TX' THEN TXUR WHEN 'NY' THEN NYUR WHEN 'FL' THEN FLUR WHEN 'IL' THEN ILUR ELSE UNRATE END AS state_unrate,
    int_rate - CPI_YOY AS real_int_rate, int_rate - FEDFUNDS AS rate_spread
  FROM {_LOANS} AS l LEFT JOIN {_WIDE_YOY} AS m ON cast(date_trunc('month', l.issue_d) AS date) = m.year_month)"""


def _joined(spark, sf):
    return gold_macro(frame(spark, sf, LOANS), silver_macro(frame(spark, sf, MACRO_LONG)))


@query("month_key", "P15", sql="SELECT o_orderkey, cast(date_trunc('month', o_orderdate) AS date) AS year_month FROM orders")
def _(spark, sf):
    return timeseries.with_month(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "year_month")


@query("series_pivot", "A23", sql=f"SELECT * FROM {_WIDE} AS w", doubles=" ".join(_IDS))
def _(spark, sf):
    return timeseries.pivot_series(frame(spark, sf, MACRO_LONG), _IDS)


@query(
    "series_summary", "A24",
    sql=f'SELECT series_id, count(*) AS n, min(observation_date) AS start, max(observation_date) AS "end" FROM {_LONG} AS l GROUP BY 1',
)
def _(spark, sf):
    return timeseries.series_summary(frame(spark, sf, MACRO_LONG))


@query("year_over_year", "W3", sql=f"SELECT year_month, CPI_YOY FROM {_WIDE_YOY} AS w", doubles="CPI_YOY")
def _(spark, sf):
    return silver_macro(frame(spark, sf, MACRO_LONG)).select("year_month", "CPI_YOY")


@query(
    "year_over_year_calendar", "W3",
    sql=f"""
    SELECT a.year_month, (a.CPIAUCSL / b.CPIAUCSL - 1) * 100 AS CPI_YOY
    FROM {_WIDE} AS a LEFT JOIN {_WIDE} AS b ON b.year_month = cast(a.year_month - INTERVAL 12 MONTH AS date)
    """,
    doubles="CPI_YOY",
)
def _(spark, sf):
    wide = timeseries.pivot_series(frame(spark, sf, MACRO_LONG), _IDS)
    return timeseries.year_over_year(wide, "CPIAUCSL", "CPI_YOY", calendar=True).select("year_month", "CPI_YOY")


@query("latest_months", "O4", sql=f"SELECT year_month, UNRATE FROM {_WIDE} AS w ORDER BY year_month DESC LIMIT 3", doubles="UNRATE")
def _(spark, sf):
    wide = timeseries.pivot_series(frame(spark, sf, MACRO_LONG), _IDS)
    return ranking.latest_n(wide, "year_month", 3).select("year_month", "UNRATE")


@query(
    "loans_with_series", "J1 P15",
    sql=f"""
    SELECT loan_id, UNRATE, FEDFUNDS, CPI_YOY FROM {_JOINED} AS j
    """,
    doubles="UNRATE FEDFUNDS CPI_YOY",
)
def _(spark, sf):
    wide = silver_macro(frame(spark, sf, MACRO_LONG))
    joined = timeseries.join_monthly(frame(spark, sf, LOANS), wide, "issue_d")
    return joined.select("loan_id", "UNRATE", "FEDFUNDS", "CPI_YOY")


@query(
    "loans_with_state_series", "P16 P17 P18 J1",
    sql=f"SELECT loan_id, state_unrate, real_int_rate, rate_spread FROM {_JOINED} AS j",
    doubles="state_unrate real_int_rate rate_spread",
)
def _(spark, sf):
    return _joined(spark, sf).select("loan_id", "state_unrate", "real_int_rate", "rate_spread")


@query(
    "loans_with_fallback_series", "J2",
    sql=f"""
    WITH s AS (SELECT observation_date, value FROM {_LONG} AS l WHERE series_id = 'UNRATE' AND observation_date < DATE '2000-01-01')
    SELECT loan_id, coalesce(value, (SELECT value FROM s ORDER BY observation_date DESC LIMIT 1)) AS unemployment_rate
    FROM {_LOANS} AS l LEFT JOIN s ON cast(date_trunc('month', issue_d) AS date) = s.observation_date
    """,
    doubles="unemployment_rate",
)
def _(spark, sf):
    series = frame(spark, sf, MACRO_LONG).filter("series_id = 'UNRATE' AND observation_date < DATE '2000-01-01'")
    loans = frame(spark, sf, LOANS).select("loan_id", "issue_d")
    joined = timeseries.join_with_fallback(loans, series, "issue_d", "unemployment_rate", cfg.UNEMPLOYMENT_FALLBACK)
    return joined.select("loan_id", "unemployment_rate")


@query(
    "loans_with_constant_series", "J2",
    sql=f"SELECT loan_id, 5e0 AS unemployment_rate FROM {_LOANS} AS l",
    doubles="unemployment_rate",
)
def _(spark, sf):
    loans = frame(spark, sf, LOANS).select("loan_id", "issue_d")
    joined = timeseries.join_with_fallback(loans, None, "issue_d", "unemployment_rate", cfg.UNEMPLOYMENT_FALLBACK)
    return joined.select("loan_id", "unemployment_rate")


@query(
    "rate_by_rounded_series", "A25 F4",
    sql=f"""
    SELECT round(UNRATE, 1) + 0e0 AS unrate_bin, count(*) AS n_loans, avg(charged_off) AS default_rate
    FROM {_JOINED} AS j WHERE UNRATE IS NOT NULL GROUP BY 1
    """,
    doubles="unrate_bin default_rate",
)
def _(spark, sf):
    return insights.rate_by_rounded(_joined(spark, sf), "UNRATE", "charged_off", "unrate_bin")


_REGIME = f"""
SELECT sub_grade, CASE WHEN FEDFUNDS <= 0.5 THEN 'low rate (<=0.5%)' ELSE 'high rate (>0.5%)' END AS rate_regime,
  count(*) AS n, avg(charged_off) AS default_rate
FROM {_JOINED} AS j WHERE sub_grade IS NOT NULL AND FEDFUNDS IS NOT NULL GROUP BY 1, 2
"""


@query("rate_by_grade_and_regime", "A26 F4", sql=_REGIME, doubles="default_rate")
def _(spark, sf):
    return insights.rate_by_category_and_regime(_joined(spark, sf), "sub_grade", "FEDFUNDS", "charged_off")


@query(
    "rate_by_grade_wide", "A27",
    sql=f"""
    SELECT sub_grade, max(CASE WHEN rate_regime = 'high rate (>0.5%)' THEN default_rate END) AS high_rate,
      max(CASE WHEN rate_regime = 'low rate (<=0.5%)' THEN default_rate END) AS low_rate
    FROM ({_REGIME}) AS r GROUP BY 1
    """,
    doubles="high_rate low_rate",
)
def _(spark, sf):
    long = insights.rate_by_category_and_regime(_joined(spark, sf), "sub_grade", "FEDFUNDS", "charged_off")
    wide = insights.regime_wide(long, "sub_grade", cfg.SUB_GRADES)
    return wide.withColumnsRenamed({cfg.HIGH_RATE_LABEL: "high_rate", cfg.LOW_RATE_LABEL: "low_rate"})


@query(
    "rate_by_state_difference", "A28 F4",
    sql=f"""
    SELECT addr_state, round(state_unrate - UNRATE, 1) + 0e0 AS excess_unemp, count(*) AS n, avg(charged_off) AS default_rate
    FROM {_JOINED} AS j WHERE addr_state IN ('CA','TX','NY','FL','IL') AND state_unrate IS NOT NULL AND UNRATE IS NOT NULL GROUP BY 1, 2
    """,
    doubles="excess_unemp default_rate",
)
def _(spark, sf):
    return insights.rate_by_difference(
        _joined(spark, sf), "addr_state", list(cfg.STATE_SERIES), "state_unrate", "UNRATE", "charged_off", "excess_unemp"
    )


@query(
    "rate_by_grade", "A29",
    sql=f"SELECT sub_grade, count(*) AS n, avg(charged_off) AS default_rate FROM {_LOANS} AS l WHERE sub_grade IS NOT NULL GROUP BY 1",
    doubles="default_rate",
)
def _(spark, sf):
    loans = frame(spark, sf, LOANS).filter("sub_grade is not null")
    return insights.rate_by(loans, ["sub_grade"], "charged_off").orderBy("sub_grade")


@query(
    "rate_by_month", "A30",
    sql=f"SELECT cast(date_trunc('month', issue_d) AS date) AS year_month, count(*) AS n, avg(charged_off) AS default_rate FROM {_LOANS} AS l GROUP BY 1",
    doubles="default_rate",
)
def _(spark, sf):
    return insights.rate_by_month(frame(spark, sf, LOANS), "issue_d", "charged_off")


@query(
    "announced_split_sizes", "A31",
    sql="""
    SELECT early - cast(floor(early * 0.2) AS bigint) AS train, cast(floor(early * 0.2) AS bigint) AS val, test
    FROM (SELECT count(*) FILTER (year(o_orderdate) IN (1996, 1997, 1998)) AS early, count(*) FILTER (year(o_orderdate) = 1999) AS test FROM orders) AS c
    """,
)
def _(spark, sf):
    return insights.split_sizes(table(spark, sf, "orders"), "o_orderdate", [1996, 1997, 1998], 1999)


@query(
    "series_stacked", "U2 U3",
    sql=f"SELECT series_id, observation_date, value FROM {_LONG} AS l",
    doubles="value",
)
def _(spark, sf):
    long = frame(spark, sf, MACRO_LONG)
    return ranking.stack_tables([long.filter(F.col("series_id") == s) for s in _IDS])


# The seven columns that the series add to a loan, encoded as the model input: median and scale of the early loans.
_ADDED = ["UNRATE", "FEDFUNDS", "CPIAUCSL", "CPI_YOY", "state_unrate", "real_int_rate", "rate_spread"]
_EARLY = "issue_d < DATE '1997-01-01'"


def _each(text: str) -> str:
    return ", ".join(text.format(c=c) for c in _ADDED)


@query(
    "series_feature_matrix", "E18",
    sql=f"""
    WITH j AS (SELECT * FROM {_JOINED} AS x), t AS (SELECT * FROM j WHERE {_EARLY}),
      m AS (SELECT {_each("median({c}) AS {c}_m")} FROM t),
      z AS (SELECT {_each("avg(coalesce({c}, {c}_m)) AS {c}_a, stddev_pop(coalesce({c}, {c}_m)) AS {c}_s")} FROM t, m)
    SELECT loan_id, {_each("(coalesce({c}, {c}_m) - {c}_a) / {c}_s AS {c}")} FROM j, m, z
    """,
    doubles=" ".join(_ADDED),
)
def _(spark, sf):
    rows = stored(_joined(spark, sf).select("loan_id", "issue_d", *_ADDED), "frame")
    made = features.fit_features(rows.filter(_EARLY), features.plain_spec([], exclude=["loan_id"]))
    return made.transform(rows, ["loan_id"])


@query("series_ablation", "L12 E18")
def _(spark, sf):
    """What the series add to the loan's own numbers, by the validation AUC of the same model."""
    own = ["loan_amnt", "term", "int_rate", "annual_inc", "dti", "open_acc", "fico_range_low"]
    rows = stored(_joined(spark, sf).select("issue_d", "charged_off", *own, *_ADDED), "frame")
    made = features.fit_features(rows.filter(_EARLY), features.plain_spec([], exclude=["charged_off"]))
    parts = [made.transform(rows.filter(part), ["charged_off"]) for part in (_EARLY, f"NOT {_EARLY}")]
    return models.ablation(*parts, own, _ADDED, "charged_off")
