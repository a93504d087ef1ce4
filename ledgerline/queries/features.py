"""Feature engineering: fitted on the training part of the loans, applied to all of them."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.functions import ordinal_position
from ledgerline.operators import clean, features as fe
from ledgerline.plans.layers import feature_frame, fit_loan_features, loan_spec
from ledgerline.queries.base import query
from ledgerline.queries.frames import LOANS, MACRO_LONG, frame, sql

_LOANS, _LONG = sql(LOANS), sql(MACRO_LONG)
_TRAIN_UNTIL = "1999-12-31"
_TRAIN = f"(SELECT * FROM {_LOANS} AS l WHERE issue_d <= DATE '{_TRAIN_UNTIL}')"


def _loans(spark, sf):
    return frame(spark, sf, LOANS)


def _train(loans):
    return loans.filter(F.col("issue_d") <= F.lit(_TRAIN_UNTIL).cast("date"))


_MONTHS = "(year(issue_d) - year(earliest_cr_line)) * 12 + (month(issue_d) - month(earliest_cr_line))"
_HISTORY = f"cast(greatest({_MONTHS}, 0) AS double)"
_LTI = "loan_amnt / (annual_inc + 1)"
_RATE = "(int_rate / 100e0 / 12e0)"
_PTI = f"""(CASE WHEN int_rate = 0 THEN loan_amnt / term
  ELSE loan_amnt * {_RATE} * pow(1 + {_RATE}, term) / (pow(1 + {_RATE}, term) - 1) END) / (annual_inc / 12e0 + 1)"""
_DELINQ = "delinq_2yrs / (total_acc + 1)"


@query(
    "date_parts", "E1",
    sql=f"""
    SELECT loan_id, cast(year(issue_d) AS double) AS issue_year, cast(month(issue_d) AS double) AS issue_month, {_HISTORY} AS credit_history_months
    FROM {_LOANS} AS l
    """,
    doubles="issue_year issue_month credit_history_months",
)
def _(spark, sf):
    dates = _loans(spark, sf).select("loan_id", "issue_d", "earliest_cr_line")
    return fe.add_date_parts(dates, "issue_d", "earliest_cr_line")


@query(
    "loan_ratios", "E2 E3 E4",
    sql=f"SELECT loan_id, {_LTI} AS loan_to_income, {_PTI} AS monthly_payment_to_income, {_DELINQ} AS delinq_rate FROM {_LOANS} AS l",
    doubles="loan_to_income monthly_payment_to_income delinq_rate",
)
def _(spark, sf):
    loans = fe.add_loan_ratios(_loans(spark, sf))
    return loans.select("loan_id", "loan_to_income", "monthly_payment_to_income", "delinq_rate")


@query(
    "capped_at_train_quantile", "E5",
    sql=f"""
    SELECT loan_id, CASE WHEN dti > cap THEN cap ELSE dti END AS dti, CASE WHEN loan_amnt > cap2 THEN cap2 ELSE loan_amnt END AS loan_amnt
    FROM {_LOANS} AS l, (SELECT quantile_cont(dti, 0.99) AS cap, quantile_cont(loan_amnt, 0.99) AS cap2 FROM {_TRAIN} AS t) AS q
    """,
    doubles="dti loan_amnt",
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "dti", "loan_amnt")
    caps = fe.fit_caps(_train(loans), ["dti", "loan_amnt"], cfg.CAP_QUANTILE)
    return fe.apply_caps(loans, caps).drop("issue_d")


@query(
    "missing_flags", "E6",
    sql=f"SELECT loan_id, CASE WHEN mths_since_recent_inq IS NULL THEN 1e0 ELSE 0e0 END AS mths_since_recent_inq_missing FROM {_LOANS} AS l",
    doubles="mths_since_recent_inq_missing",
)
def _(spark, sf):
    loans = fe.add_missing_flags(_loans(spark, sf), cfg.MISSING_FLAG_COLUMNS)
    return loans.select("loan_id", "mths_since_recent_inq_missing")


@query(
    "rare_levels_merged", "E7",
    sql=f"""
    WITH rare AS (SELECT purpose FROM {_TRAIN} AS t GROUP BY 1 HAVING count(*) < 50)
    SELECT loan_id, CASE WHEN purpose IN (SELECT purpose FROM rare) THEN 'other' ELSE purpose END AS purpose FROM {_LOANS} AS l
    """,
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "purpose")
    rare = fe.rare_levels(_train(loans), ["purpose"], cfg.RARE_THRESHOLD)
    return fe.merge_rare(loans, rare, ["purpose"], cfg.RARE_LABEL).drop("issue_d")


@query(
    "median_imputed", "E8",
    sql=f"""
    SELECT loan_id, coalesce(annual_inc, m1) AS annual_inc, coalesce(dti, m2) AS dti
    FROM {_LOANS} AS l, (SELECT median(annual_inc) AS m1, median(dti) AS m2 FROM {_TRAIN} AS t) AS m
    """,
    doubles="annual_inc dti",
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "annual_inc", "dti")
    return fe.impute(loans, fe.fit_medians(_train(loans), ["annual_inc", "dti"])).drop("issue_d")


_MODE = "(SELECT {c} FROM {t} AS t WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(
    "mode_imputed", "E9",
    sql=f"""
    SELECT loan_id, coalesce(home_ownership, {_MODE.format(c='home_ownership', t=_TRAIN)}) AS home_ownership,
      coalesce(sub_grade, {_MODE.format(c='sub_grade', t=_TRAIN)}) AS sub_grade
    FROM {_LOANS} AS l
    """,
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "home_ownership", "sub_grade")
    return fe.impute(loans, fe.fit_modes(_train(loans), ["home_ownership", "sub_grade"])).drop("issue_d")


@query(
    "binarized", "E10",
    sql=f"""
    SELECT loan_id, CASE WHEN coalesce(delinq_2yrs, 0) > 0 THEN 1e0 ELSE 0e0 END AS delinq_2yrs,
      CASE WHEN coalesce(pub_rec, 0) > 0 THEN 1e0 ELSE 0e0 END AS pub_rec FROM {_LOANS} AS l
    """,
    doubles="delinq_2yrs pub_rec",
)
def _(spark, sf):
    return _loans(spark, sf).select(
        "loan_id", fe.above_zero("delinq_2yrs").alias("delinq_2yrs"), fe.above_zero("pub_rec").alias("pub_rec")
    )


@query(
    "log_scaled", "E11 E12",
    sql=f"""
    SELECT loan_id, (ln(1 + loan_amnt) - m) / s AS loan_amnt
    FROM {_LOANS} AS l, (SELECT avg(ln(1 + loan_amnt)) AS m, stddev_pop(ln(1 + loan_amnt)) AS s FROM {_TRAIN} AS t) AS q
    """,
    doubles="loan_amnt",
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "loan_amnt")
    logged = {"loan_amnt": F.log1p("loan_amnt")}
    mean, deviation = fe.fit_scale(_train(loans), logged)["loan_amnt"]
    return loans.select("loan_id", fe.standardized(logged["loan_amnt"], mean, deviation).alias("loan_amnt"))


_ORDER = "list_position([" + ", ".join(f"'{g}'" for g in cfg.SUB_GRADES) + "], {c})"


@query(
    "ordinal_encoded", "E13",
    sql=f"""
    SELECT loan_id, CASE WHEN sub_grade IS NULL THEN NULL ELSE cast(coalesce({_ORDER.format(c='sub_grade')}, 0) - 1 AS double) END AS grade,
      CASE WHEN home_ownership IS NULL THEN NULL WHEN home_ownership = 'RENT' THEN 0e0 ELSE -1e0 END AS home
    FROM {_LOANS} AS l
    """,
    doubles="grade home",
)
def _(spark, sf):
    return _loans(spark, sf).select(
        "loan_id",
        ordinal_position("sub_grade", cfg.SUB_GRADES).alias("grade"),
        ordinal_position("home_ownership", ["RENT"]).alias("home"),
    )


@query(
    "one_hot_first_dropped", "E14",
    sql=f"""
    SELECT loan_id, CASE WHEN h = 'MORTGAGE' THEN 1e0 ELSE 0e0 END AS home_ownership_MORTGAGE,
      CASE WHEN h = 'OWN' THEN 1e0 ELSE 0e0 END AS home_ownership_OWN, CASE WHEN h = 'RENT' THEN 1e0 ELSE 0e0 END AS home_ownership_RENT
    FROM (SELECT loan_id, coalesce(home_ownership, {_MODE.format(c='home_ownership', t=_TRAIN)}) AS h FROM {_LOANS} AS l) AS x
    """,
    doubles="home_ownership_MORTGAGE home_ownership_OWN home_ownership_RENT",
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "home_ownership")
    spec = fe.FeatureSpec(one_hot=["home_ownership"], exclude=["loan_id"])
    return fe.fit_features(_train(loans), spec).transform(loans, ["loan_id"])


@query(
    "one_hot_all_levels_sparse", "E15",
    sql=f"""
    SELECT verification_status, initial_list_status, count(*) AS n, 1 + list_position(['Not Verified', 'Source Verified', 'Verified'], verification_status) - 2 AS first_slot,
      3 + list_position(['f', 'w'], initial_list_status) - 1 AS second_slot
    FROM {_LOANS} AS l GROUP BY 1, 2
    """,
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "verification_status", "initial_list_status")
    columns = ["verification_status", "initial_list_status"]
    encoded = fe.sparse_one_hot(columns).fit(_train(loans)).transform(loans)
    slots = F.array_compact(
        F.transform(vector_to_array("categories"), lambda v, i: F.when(v == 1.0, i))
    )
    return encoded.groupBy(*columns, slots.alias("slots")).agg(F.count("*").alias("n")).select(
        *columns, "n", F.col("slots")[0].alias("first_slot"), F.col("slots")[1].alias("second_slot")
    )


_TREATMENTS = {
    "skewed": ["annual_inc", "dti"],
    "binarized": ["pub_rec", "delinq_2yrs"],
    "ordinal": ["sub_grade"],
    "one_hot": ["home_ownership", "verification_status", "purpose", "addr_state", "initial_list_status"],
    "normal": ["loan_amnt", "term", "int_rate", "open_acc", "total_acc", "mths_since_recent_inq", "fico_range_low"],
}


@query(
    "cells_by_treatment", "E16 P7",
    sql=" UNION ALL ".join(
        f"SELECT '{g}' AS treatment, cast({len(cs)} AS int) AS n_columns, " + " + ".join(f"count({c})" for c in cs) + f" AS n_values FROM {_LOANS} AS l"
        for g, cs in _TREATMENTS.items()
    ),
)
def _(spark, sf):
    loans = clean.drop_present(_loans(spark, sf).drop("loan_id"), cfg.CORRELATED_COLUMNS)
    groups = fe.route_columns(loans, loan_spec())
    counts = loans.agg(*[F.count(c).alias(c) for cs in groups.values() for c in cs])
    rows = [
        F.struct(F.lit(g).alias("treatment"), F.lit(len(cs)).alias("n_columns"), sum(F.col(c) for c in cs).alias("n_values"))
        for g, cs in groups.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def _chain_sql() -> str:
    base = f"""(SELECT loan_id, issue_d, charged_off, loan_amnt, cast(term AS double) AS term, int_rate, annual_inc, dti, open_acc, total_acc,
      delinq_2yrs, pub_rec, mths_since_recent_inq, fico_range_low, sub_grade, home_ownership, purpose, verification_status,
      {_LTI} AS loan_to_income, {_PTI} AS monthly_payment_to_income, {_DELINQ} AS delinq_rate, {_HISTORY} AS credit_history_months,
      CASE WHEN mths_since_recent_inq IS NULL THEN 1e0 ELSE 0e0 END AS mths_since_recent_inq_missing,
      cast(year(issue_d) AS double) AS issue_year, cast(month(issue_d) AS double) AS issue_month FROM {_LOANS} AS l)"""
    skewed = ["annual_inc", "dti", "loan_to_income", "monthly_payment_to_income", "delinq_rate", "credit_history_months"]
    normal = ["loan_amnt", "term", "int_rate", "open_acc", "total_acc", "mths_since_recent_inq", "fico_range_low",
              "issue_year", "issue_month", "mths_since_recent_inq_missing"]
    train = f"issue_d <= DATE '{_TRAIN_UNTIL}'"
    capped = f"(SELECT * REPLACE (CASE WHEN dti > cap THEN cap ELSE dti END AS dti) FROM b, (SELECT quantile_cont(dti, 0.99) AS cap FROM b WHERE {train}) AS q)"
    medians = ", ".join(f"median({c}) AS m_{c}" for c in skewed + normal)
    filled = ", ".join(
        [f"ln(1 + coalesce({c}, m_{c})) AS {c}" for c in skewed] + [f"coalesce({c}, m_{c}) AS {c}" for c in normal]
    )
    mode = "(SELECT {c} FROM b WHERE {c} IS NOT NULL AND " + train + " GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
    grade = f"coalesce(sub_grade, {mode.format(c='sub_grade')})"
    home = f"coalesce(home_ownership, {mode.format(c='home_ownership')})"
    scaled = skewed + normal + ["sub_grade"]
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in scaled)
    out = ", ".join(f"({c} - a_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}" for c in scaled)
    flags = ", ".join(f"CASE WHEN coalesce({c}, 0) > 0 THEN 1e0 ELSE 0e0 END AS {c}" for c in ["pub_rec", "delinq_2yrs"])
    hot = ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS {name}"
        for c, v, name in [("home", "MORTGAGE", "home_mortgage"), ("home", "OWN", "home_own"), ("home", "RENT", "home_rent")]
    )
    return f"""
    WITH b AS (SELECT * FROM {base} AS x), c AS (SELECT * FROM {capped} AS y),
    f AS (SELECT loan_id, issue_d, {filled}, cast({_ORDER.format(c=grade)} - 1 AS double) AS sub_grade, {home} AS home, {flags}
      FROM c, (SELECT {medians} FROM c WHERE {train}) AS m),
    s AS (SELECT {stats} FROM f WHERE {train})
    SELECT loan_id, {out}, pub_rec, delinq_2yrs, {hot} FROM f, s
    """


_CHAIN_DOUBLES = [
    "annual_inc", "dti", "loan_to_income", "monthly_payment_to_income", "delinq_rate", "credit_history_months", "loan_amnt",
    "term", "int_rate", "open_acc", "total_acc", "mths_since_recent_inq", "fico_range_low", "issue_year", "issue_month",
    "mths_since_recent_inq_missing", "sub_grade", "pub_rec", "delinq_2yrs", "home_mortgage", "home_own", "home_rent",
]


@query("feature_chain", "E17 E1 E2 E3 E4 E5 E6 E8 E9 E10 E11 E12 E13 E14", sql=_chain_sql(), doubles=" ".join(_CHAIN_DOUBLES))
def _(spark, sf):
    loans = _loans(spark, sf)
    model = fit_loan_features(_train(loans).drop("loan_id"))
    made = feature_frame(model, loans, keep=["loan_id"])
    named = made.withColumnsRenamed(
        {"home_ownership_MORTGAGE": "home_mortgage", "home_ownership_OWN": "home_own", "home_ownership_RENT": "home_rent"}
    )
    return named.select("loan_id", *_CHAIN_DOUBLES)


@query(
    "feature_chain_with_series", "E17 E18 J2",
    sql=f"""
    WITH s AS (SELECT observation_date, value FROM {_LONG} AS x WHERE series_id = 'UNRATE'),
    j AS (SELECT loan_id, issue_d, coalesce(value, (SELECT value FROM s ORDER BY observation_date DESC LIMIT 1)) AS u
      FROM {_LOANS} AS l LEFT JOIN s ON cast(date_trunc('month', issue_d) AS date) = s.observation_date)
    SELECT loan_id, (u - m) / d AS unemployment_rate
    FROM j, (SELECT avg(u) AS m, stddev_pop(u) AS d FROM j WHERE issue_d <= DATE '{_TRAIN_UNTIL}') AS q
    """,
    doubles="unemployment_rate",
)
def _(spark, sf):
    loans = _loans(spark, sf)
    series = frame(spark, sf, MACRO_LONG).filter("series_id = 'UNRATE'")
    model = fit_loan_features(_train(loans).drop("loan_id"), series)
    return feature_frame(model, loans, series, keep=["loan_id"]).select("loan_id", "unemployment_rate")


@query(
    "plain_encoding", "E15 E18",
    sql=f"""
    SELECT loan_id, (coalesce(annual_inc, m1) - a) / s AS annual_inc,
      CASE WHEN initial_list_status = 'f' THEN 1e0 ELSE 0e0 END AS initial_list_status_f,
      CASE WHEN initial_list_status = 'w' THEN 1e0 ELSE 0e0 END AS initial_list_status_w
    FROM {_LOANS} AS l, (SELECT median(annual_inc) AS m1 FROM {_TRAIN} AS t) AS m,
      (SELECT avg(coalesce(annual_inc, mm)) AS a, stddev_pop(coalesce(annual_inc, mm)) AS s
       FROM {_TRAIN} AS t, (SELECT median(annual_inc) AS mm FROM {_TRAIN} AS t2) AS q) AS z
    """,
    doubles="annual_inc initial_list_status_f initial_list_status_w",
)
def _(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "issue_d", "annual_inc", "initial_list_status")
    kinds = clean.columns_by_type(loans, ["loan_id"])
    spec = fe.plain_spec(kinds["categorical"], exclude=["loan_id"])
    return fe.fit_features(_train(loans), spec).transform(loans, ["loan_id"])
