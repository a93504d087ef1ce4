from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ledgerline import config as cfg
from ledgerline.operators import score as sc

GOOD = {
    "loan_amnt": 8000.0, "term": 36, "int_rate": 6.5, "sub_grade": "a2", "annual_inc": 95000.0, "dti": 8.0,
    "fico_score": 760, "home_ownership": "mortgage", "purpose": "Credit Card",
}
SCHEMA = (
    "loan_amnt double, term int, int_rate double, sub_grade string, annual_inc double, dti double, fico_score int, "
    "home_ownership string, purpose string"
)


@pytest.fixture
def applicants(rows):
    def make(*changes):
        return rows([tuple({**GOOD, **c}[k] for k in GOOD) for c in changes], SCHEMA)

    return make


def errors(df):
    return [r["error"] for r in sc.with_errors(sc.fill_inputs(df)).collect()]


@pytest.mark.parametrize(
    "change, message",
    [
        ({}, None),
        ({"loan_amnt": 0.0}, "loan_amnt must be a positive number."),
        ({"term": 48}, "term must be 36 or 60 months."),
        ({"int_rate": 100.0}, "int_rate must be between 0 and 100 (exclusive)."),
        ({"dti": -0.1}, "dti must be non-negative."),
        ({"fico_score": 851}, "fico_score must be between 300 and 850."),
        ({"sub_grade": "H1"}, "sub_grade 'H1' is invalid. Use A1-G5 (e.g. B3)."),
        ({"home_ownership": "tent"}, "home_ownership must be one of ['ANY', 'MORTGAGE', 'NONE', 'OTHER', 'OWN', 'RENT']."),
        ({"purpose": None}, "purpose is required."),
        ({"term": 48, "dti": -1.0}, "term must be 36 or 60 months. | dti must be non-negative."),
    ],
)
def test_validation_messages(applicants, change, message):
    assert errors(applicants(change)) == [message]


def test_optional_inputs_are_checked_too(applicants):
    df = applicants({}).withColumns({"revol_util": F.lit(201.0), "pub_rec": F.lit(-1), "open_acc": F.lit(None).cast("int")})
    assert errors(df) == ["revol_util must be between 0 and 200. | pub_rec must be non-negative."]


def test_an_absent_required_column_is_an_error_of_every_row(applicants):
    assert errors(applicants({}).drop("term")) == ["term is required."]


def test_rows_are_valid_or_rejected(applicants):
    checked = sc.with_errors(sc.fill_inputs(applicants({}, {"term": 1}, {"dti": None})))
    assert sc.valid_rows(checked).count() == 1 and sc.rejected_rows(checked).count() == 2


def test_normalized_inputs(applicants):
    got = sc.normalized_inputs(sc.valid_rows(sc.with_errors(sc.fill_inputs(applicants({})))), "2024-06").first()
    assert (got["sub_grade"], got["home_ownership"], got["purpose"]) == ("A2", "MORTGAGE", "credit_card")
    assert got["term"] == 36.0 and got["fico_range_low"] == 760.0 and got["open_acc"] == 10.0
    assert str(got["issue_d"]) == "2024-06-01" and str(got["earliest_cr_line"]) == "2010-01-01"
    for column, default in cfg.SECONDARY_DEFAULTS.items():
        assert got[column] == default


def test_tiers_at_their_borders(rows):
    values = [0.0, 0.1499, 0.15, 0.25, 0.2847, 0.35, 0.4999, 0.5, 1.0]
    got = sc.with_tier(rows([(v,) for v in values], "p double"), "p", "M").collect()
    assert [r["risk_level"] for r in got] == [1, 1, 2, 3, 3, 4, 4, 5, 5]
    assert [r["prediction"] for r in got] == ["LOW RISK"] * 5 + ["HIGH RISK"] * 4
    assert got[4]["risk_description"] == "Moderate risk (28.5%) — Recommendation: Review"
    assert got[8]["risk_description"] == "Very High risk (100.0%) — Recommendation: Decline"
    assert got[4]["default_probability"] == 0.2847 and got[4]["model"] == "M"


def test_scenarios_override_what_they_name(applicants):
    df = applicants({"loan_amnt": 1.0}, {"loan_amnt": 2.0}).select("loan_amnt", "term")
    got = sc.explode_scenarios(df, {"base": {}, "long": {"term": 60, "unknown": 1}}).collect()
    assert sorted((r["loan_amnt"], r["scenario"], r["term"]) for r in got) == [
        (1.0, "base", 36), (1.0, "long", 60), (2.0, "base", 36), (2.0, "long", 60)
    ]
    assert sc.explode_scenarios(applicants({})).count() == len(cfg.SCENARIOS)


def test_contributions_are_ranked_by_size(rows):
    df = rows([(1.0, -5.0, 2.0)], "a double, b double, c double")
    got = sc.linear_contributions(df, {"a": 1.0, "b": 1.0, "c": 2.0}, top=2).first()["contributions"]
    assert [(c["feature"], c["value"]) for c in got] == [("b", -5.0), ("c", 4.0)]


def test_baseline_probability(spark):
    assert spark.range(1).select(sc.baseline_probability(-1.5)).first()[0] == pytest.approx(1 / (1 + math.exp(1.5)))
