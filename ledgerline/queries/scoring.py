"""Batch scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators import features as fe
from ledgerline.operators import models as md
from ledgerline.operators import score as sc
from ledgerline.operators.evaluate import confusion_at
from ledgerline.plans.layers import feature_frame, fit_loan_features, prepared
from ledgerline.queries.base import query
from ledgerline.queries.frames import APPLICANTS, LEARNABLE, LOANS, SCORED, frame, frame_once, sql
from ledgerline.session import shared_path

_APPLICANTS = sql(APPLICANTS)
_FILLED = f"""(
  SELECT applicant_id, loan_amnt, term, int_rate, sub_grade, annual_inc, dti, fico_score, home_ownership, purpose,
    coalesce(open_acc, 10) AS open_acc, coalesce(revol_util, 30) AS revol_util, coalesce(verification_status, 'Not Verified') AS verification_status,
    coalesce(total_acc, 20) AS total_acc, coalesce(delinq_2yrs, 0) AS delinq_2yrs, coalesce(pub_rec, 0) AS pub_rec,
    coalesce(inq_last_6mths, 0) AS inq_last_6mths
  FROM {_APPLICANTS} AS a)"""
_GRADES = ", ".join(f"'{g}'" for g in cfg.SUB_GRADES)
_ERROR = f"""concat_ws(' | ',
  CASE WHEN purpose IS NULL THEN 'purpose is required.' END,
  CASE WHEN loan_amnt <= 0 THEN 'loan_amnt must be a positive number.' END,
  CASE WHEN term NOT IN (36, 60) THEN 'term must be 36 or 60 months.' END,
  CASE WHEN NOT (int_rate > 0 AND int_rate < 100) THEN 'int_rate must be between 0 and 100 (exclusive).' END,
  CASE WHEN annual_inc <= 0 THEN 'annual_inc must be a positive number.' END,
  CASE WHEN dti < 0 THEN 'dti must be non-negative.' END,
  CASE WHEN fico_score NOT BETWEEN 300 AND 850 THEN 'fico_score must be between 300 and 850.' END,
  CASE WHEN upper(sub_grade) NOT IN ({_GRADES}) THEN 'sub_grade ''' || sub_grade || ''' is invalid. Use A1-G5 (e.g. B3).' END,
  CASE WHEN upper(home_ownership) NOT IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER', 'NONE', 'ANY')
    THEN 'home_ownership must be one of [''ANY'', ''MORTGAGE'', ''NONE'', ''OTHER'', ''OWN'', ''RENT''].' END,
  CASE WHEN verification_status NOT IN ('Not Verified', 'Verified', 'Source Verified')
    THEN 'verification_status must be one of [''Not Verified'', ''Source Verified'', ''Verified''].' END,
  CASE WHEN open_acc < 0 THEN 'open_acc must be non-negative.' END,
  CASE WHEN total_acc < 0 THEN 'total_acc must be non-negative.' END,
  CASE WHEN revol_util NOT BETWEEN 0 AND 200 THEN 'revol_util must be between 0 and 200.' END,
  CASE WHEN delinq_2yrs < 0 THEN 'delinq_2yrs must be non-negative.' END,
  CASE WHEN pub_rec < 0 THEN 'pub_rec must be non-negative.' END,
  CASE WHEN inq_last_6mths < 0 THEN 'inq_last_6mths must be non-negative.' END)"""


def _checked(spark, sf):
    return sc.with_errors(sc.fill_inputs(frame(spark, sf, APPLICANTS)))


@query("rejected_applicants", "R1", sql=f"SELECT applicant_id, error FROM (SELECT applicant_id, {_ERROR} AS error FROM {_FILLED} AS f) AS e WHERE error <> ''")
def _(spark, sf):
    return sc.rejected_rows(_checked(spark, sf)).select("applicant_id", "error")


@query(
    "valid_applicants_normalized", "R1 R2",
    sql=f"""
    SELECT applicant_id, upper(sub_grade) AS sub_grade, upper(home_ownership) AS home_ownership, lower(replace(purpose, ' ', '_')) AS purpose,
      cast(open_acc AS double) AS open_acc, revol_util, cast(fico_score AS double) AS fico_range_low, verification_status,
      DATE '2024-06-01' AS issue_d, DATE '2010-01-01' AS earliest_cr_line, 10000e0 AS revol_bal, cast(NULL AS double) AS mths_since_recent_inq, 'CA' AS addr_state
    FROM (SELECT *, {_ERROR} AS error FROM {_FILLED} AS f) AS e WHERE error = ''
    """,
    doubles="open_acc revol_util fico_range_low revol_bal mths_since_recent_inq",
)
def _(spark, sf):
    ready = sc.normalized_inputs(sc.valid_rows(_checked(spark, sf)), "2024-06")
    return ready.select(
        "applicant_id", "sub_grade", "home_ownership", "purpose", "open_acc", "revol_util", "fico_range_low",
        "verification_status", "issue_d", "earliest_cr_line", "revol_bal", "mths_since_recent_inq", "addr_state",
    )


@query(
    "risk_tiers", "R4",
    sql=f"""
    SELECT part, risk_level, prediction, tier, count(*) AS n FROM (
      SELECT part, CASE WHEN fine < 0.15e0 THEN 1 WHEN fine < 0.25e0 THEN 2 WHEN fine < 0.35e0 THEN 3 WHEN fine < 0.5e0 THEN 4 ELSE 5 END AS risk_level,
        CASE WHEN fine >= 0.35e0 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS prediction,
        CASE WHEN fine < 0.15e0 THEN 'Very Low risk: Approve' WHEN fine < 0.25e0 THEN 'Low risk: Approve' WHEN fine < 0.35e0 THEN 'Moderate risk: Review'
          WHEN fine < 0.5e0 THEN 'High risk: Decline' ELSE 'Very High risk: Decline' END AS tier
      FROM {sql(SCORED)} AS s) AS t
    GROUP BY ALL
    """,
)
def _(spark, sf):
    tiers = sc.with_tier(frame(spark, sf, SCORED), "fine", "linear")
    # The share inside the text is cut out: its last digit is a matter of rounding.
    text = F.regexp_replace("risk_description", r" \([0-9.]+%\) — Recommendation:", ":")
    return tiers.groupBy("part", "risk_level", "prediction", text.alias("tier")).agg(F.count("*").alias("n"))


@query(
    "risk_texts", "R4",
    sql=f"""
    SELECT part, p AS probability, text AS risk_description, count(*) AS n FROM (
      SELECT part, p, CASE WHEN p < 0.15 THEN 'Very Low' WHEN p < 0.25 THEN 'Low' WHEN p < 0.35 THEN 'Moderate' WHEN p < 0.5 THEN 'High' ELSE 'Very High' END
        || ' risk (' || format('{{:.1f}}', p * 100) || '%) — Recommendation: '
        || CASE WHEN p < 0.25 THEN 'Approve' WHEN p < 0.35 THEN 'Review' ELSE 'Decline' END AS text
      FROM (SELECT part, least(floor(fine * 8), 8) / 8e0 AS p FROM {sql(SCORED)} AS s) AS q) AS t
    GROUP BY ALL
    """,
    doubles="probability",
)
def _(spark, sf):
    """The whole text with its percentage, on probabilities of which one decimal says all."""
    eighths = F.least(F.floor(F.col("fine") * 8), F.lit(8)) / 8.0
    tiers = sc.with_tier(frame(spark, sf, SCORED).withColumn("probability", eighths), "probability", "linear")
    return tiers.groupBy("part", "probability", "risk_description").agg(F.count("*").alias("n"))


def _scenario_sql() -> str:
    columns = ["term", "int_rate", "fico_score"]
    parts = []
    for name, values in cfg.SCENARIOS.items():
        cells = ", ".join(f"cast({values[c]} AS {'double' if c == 'int_rate' else 'int'}) AS {c}" for c in columns)
        parts.append(f"SELECT applicant_id, '{name}' AS scenario, {cells}, annual_inc FROM {_APPLICANTS} AS a")
    return " UNION ALL ".join(parts)


@query("applicants_under_scenarios", "J4", sql=_scenario_sql(), doubles="int_rate annual_inc")
def _(spark, sf):
    applicants = frame(spark, sf, APPLICANTS).select("applicant_id", "term", "int_rate", "fico_score", "annual_inc")
    # The profiles without their income, so that the applicant's own is kept.
    own_income = {n: {c: v for c, v in s.items() if c != "annual_inc"} for n, s in cfg.SCENARIOS.items()}
    return sc.explode_scenarios(applicants, own_income).select(
        "applicant_id", "scenario", "term", "int_rate", "fico_score", "annual_inc"
    )


@query("scored_applicants", "R3 R4 E17 L1")
def _(spark, sf):
    loans = frame(spark, sf, LOANS)
    features = fit_loan_features(loans.drop("loan_id"))
    train = feature_frame(features, loans)
    model = md.fit_logistic(train, features.feature_names, cfg.TARGET)
    ready = prepared(sc.normalized_inputs(sc.valid_rows(_checked(spark, sf)), "2001-06"))
    scored = sc.predict_probability(ready, features, model, ["applicant_id"])
    return sc.with_tier(scored, "score", "LogisticRegression").drop("score", "risk_description")


@query(
    "linear_contributions", "R5",
    sql=f"""
    WITH c AS (SELECT row_id, unnest([struct_pack(f := 'quantity', v := quantity * 0.02), struct_pack(f := 'discount', v := discount * -3e0),
      struct_pack(f := 'tax', v := tax * 2e0), struct_pack(f := 'line', v := line * 0.05)], recursive := true) FROM (
        SELECT row_number() OVER () AS row_id, quantity, discount, tax, line FROM {sql(LEARNABLE)} AS l) AS g),
    p AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(v) DESC, f) AS place FROM c)
    SELECT f AS feature, cast(place AS int) AS place, count(*) AS n, avg(v) AS mean_value FROM p WHERE place <= 2 GROUP BY 1, 2
    """,
    doubles="mean_value",
)
def _(spark, sf):
    rows = frame(spark, sf, LEARNABLE)
    explained = sc.linear_contributions(rows, {"quantity": 0.02, "discount": -3.0, "tax": 2.0, "line": 0.05}, top=2)
    each = explained.select(F.posexplode("contributions").alias("place", "c"))
    return each.groupBy(F.col("c.feature").alias("feature"), (F.col("place") + 1).alias("place")).agg(
        F.count("*").alias("n"), F.avg("c.value").alias("mean_value")
    )


@query(
    "stored_scores_reused", "R6 V6",
    sql=f"""
    SELECT count(*) FILTER (fine >= 0.5e0 AND label = 1) AS tp, count(*) FILTER (fine >= 0.5e0 AND label = 0) AS fp,
      count(*) FILTER (fine < 0.5e0 AND label = 1) AS fn, count(*) FILTER (fine < 0.5e0 AND label = 0) AS tn
    FROM {sql(SCORED)} AS s
    """,
)
def _(spark, sf):
    path = shared_path(spark, "scores")
    frame(spark, sf, SCORED).write.parquet(path)
    return confusion_at(spark.read.parquet(path), "fine", "label", 0.5)


@query(
    "baseline_probability", "R7",
    sql=f"SELECT part, 1 / (1 + exp(-ln(rate / (1 - rate)))) AS probability FROM (SELECT part, avg(label) AS rate FROM {sql(SCORED)} AS s GROUP BY 1) AS r",
    doubles="probability",
)
def _(spark, sf):
    rates = frame(spark, sf, SCORED).groupBy("part").agg(F.avg("label").alias("rate"))
    bias = F.ln(F.col("rate") / (1 - F.col("rate")))
    return rates.select("part", sc.baseline_probability(bias).alias("probability"))


@query(
    "baseline_of_two_values", "R7 L1",
    sql=f"""
    SELECT round(pos * all_neg * 1e0 / (pos * all_neg + neg * all_pos), 3) AS probability FROM (
      SELECT x, sum(label) AS pos, count(*) - sum(label) AS neg, sum(sum(label)) OVER () AS all_pos, sum(count(*) - sum(label)) OVER () AS all_neg
      FROM (SELECT CASE WHEN quantity > 25 THEN 1e0 ELSE 0e0 END AS x, label FROM {sql(LEARNABLE)} AS l) AS r GROUP BY x) AS s
    WHERE x = 0
    """,
    doubles="probability",
)
def _(spark, sf):
    """The bias of a fitted model: what it predicts where its only feature is 0."""
    rows = frame(spark, sf, LEARNABLE).select(F.when(F.col("quantity") > 25, 1.0).otherwise(0.0).alias("x"), "label")
    bias = float(md.fit_logistic(rows, ["x"], "label", c=1e12).stages[-1].intercept)
    return spark.range(1).select(F.round(sc.baseline_probability(bias), 3).alias("probability"))


@query("explained_model_scores", "R5 L1 R7")
def _(spark, sf):
    rows = frame_once(spark, sf, LEARNABLE)
    names = ["quantity", "price", "discount", "tax", "line", "total"]
    features = fe.fit_features(rows, fe.FeatureSpec(exclude=["row_id", "label", "day"]))
    made = features.transform(rows, ["row_id", "label"])
    model = md.fit_logistic(made, names, "label")
    explained = sc.linear_contributions(made, sc.model_weights(model, names), top=1)
    top = F.col("contributions")[0]["feature"]
    return explained.groupBy(top.alias("feature")).agg(F.count("*").alias("n")).withColumn(
        "baseline", sc.baseline_probability(float(model.stages[-1].intercept))
    )
