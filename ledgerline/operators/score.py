"""Batch scoring of applicants: validation, defaults, probability, risk tier, contributions.

Everything but the model itself is a row expression, so the same functions serve a streaming
DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.config import (
    HIGH_RISK_FROM,
    INPUT_DEFAULTS,
    REQUIRED_INPUTS,
    RISK_TIERS,
    SCENARIOS,
    SECONDARY_DEFAULTS,
    SUB_GRADES,
    VALID_HOME_OWNERSHIP,
    VALID_TERMS,
    VALID_VERIFICATION,
)
from ledgerline.functions.numeric import quote_name
from ledgerline.operators.features import FeatureModel

ERROR = "error"
MESSAGE_SEPARATOR = " | "


def _in_grades() -> Column:
    return F.upper("sub_grade").isin(*SUB_GRADES)


# What an applicant must satisfy, and the message if not.
def validation_rules() -> list[tuple[Column, Column]]:
    text = F.lit
    homes = "[" + ", ".join(f"'{v}'" for v in VALID_HOME_OWNERSHIP) + "]"
    verifications = "[" + ", ".join(f"'{v}'" for v in VALID_VERIFICATION) + "]"
    return [
        (F.col("loan_amnt") > 0, text("loan_amnt must be a positive number.")),
        (F.col("term").isin(*VALID_TERMS), text("term must be 36 or 60 months.")),
        ((F.col("int_rate") > 0) & (F.col("int_rate") < 100), text("int_rate must be between 0 and 100 (exclusive).")),
        (F.col("annual_inc") > 0, text("annual_inc must be a positive number.")),
        (F.col("dti") >= 0, text("dti must be non-negative.")),
        (F.col("fico_score").between(300, 850), text("fico_score must be between 300 and 850.")),
        (_in_grades(), F.concat(text("sub_grade '"), F.col("sub_grade"), text("' is invalid. Use A1-G5 (e.g. B3)."))),
        (F.upper("home_ownership").isin(*VALID_HOME_OWNERSHIP), text(f"home_ownership must be one of {homes}.")),
        (F.col("verification_status").isin(*VALID_VERIFICATION), text(f"verification_status must be one of {verifications}.")),
        (F.col("open_acc") >= 0, text("open_acc must be non-negative.")),
        (F.col("total_acc") >= 0, text("total_acc must be non-negative.")),
        (F.col("revol_util").between(0, 200), text("revol_util must be between 0 and 200.")),
        (F.col("delinq_2yrs") >= 0, text("delinq_2yrs must be non-negative.")),
        (F.col("pub_rec") >= 0, text("pub_rec must be non-negative.")),
        (F.col("inq_last_6mths") >= 0, text("inq_last_6mths must be non-negative.")),
    ]


def fill_inputs(df: DataFrame) -> DataFrame:
    """Optional inputs that are absent or NULL get their defaults; an absent required one becomes NULL."""
    filled = {}
    for c, default in INPUT_DEFAULTS.items():
        filled[c] = F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
    for c in REQUIRED_INPUTS:
        if c not in df.columns:
            filled[c] = F.lit(None).cast("string")
    return df.withColumns(filled)


def with_errors(df: DataFrame) -> DataFrame:
    """Adds the messages of all broken rules, joined; NULL for a valid row. A missing required input is an error."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} is required.")) for c in REQUIRED_INPUTS]
    broken = [F.when(~ok, message) for ok, message in validation_rules()]
    return df.withColumn(ERROR, F.nullif(F.concat_ws(MESSAGE_SEPARATOR, *missing, *broken), F.lit("")))


def _is_valid() -> Column:
    """No rule broken and nothing required missing; cheaper to filter by than the message text."""
    condition = F.lit(True)
    for ok, _ in validation_rules():
        condition = condition & F.coalesce(ok, F.lit(True))
    for c in REQUIRED_INPUTS:
        condition = condition & F.col(c).isNotNull()
    return condition


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(_is_valid()).drop(ERROR)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(~_is_valid())


def normalized_inputs(df: DataFrame, as_of: str | Column) -> DataFrame:
    """Spelling made uniform, numbers as double, the issue date set, and unstated columns defaulted."""
    issued = F.lit(as_of) if isinstance(as_of, str) else as_of
    renamed = df.withColumnRenamed("fico_score", "fico_range_low")
    numeric = [
        f.name for f in renamed.schema.fields if isinstance(f.dataType, T.NumericType) and f.name in _INPUT_NUMBERS
    ]
    changed = {c: F.col(c).cast("double") for c in numeric}
    changed["sub_grade"] = F.upper("sub_grade")
    changed["home_ownership"] = F.upper("home_ownership")
    changed["purpose"] = F.replace(F.lower("purpose"), F.lit(" "), F.lit("_"))
    changed["issue_d"] = issued.cast("string").try_cast("date")
    changed["earliest_cr_line"] = F.col("earliest_cr_line").cast("string").try_cast("date")
    for c, default in SECONDARY_DEFAULTS.items():
        value = F.lit(default) if default is not None else F.lit(None).cast("double")
        changed[c] = F.coalesce(F.col(quote_name(c)), value) if c in renamed.columns else value
    return renamed.withColumns(changed)


_INPUT_NUMBERS = {
    "loan_amnt", "term", "int_rate", "annual_inc", "dti", "fico_range_low", "open_acc", "revol_util", "total_acc",
    "delinq_2yrs", "pub_rec", "inq_last_6mths",
}


def risk_level(probability: Column) -> Column:
    chain = None
    for bound, level, _, _ in RISK_TIERS[:-1]:
        chain = F.when(probability < bound, level) if chain is None else chain.when(probability < bound, level)
    return chain.otherwise(RISK_TIERS[-1][1])


def _tier_text(probability: Column) -> Column:
    """``"Low risk (20.0%) — Recommendation: Approve"``."""
    share = F.concat(F.call_function("format_number", probability * 100, F.lit("0.0")), F.lit("%"))
    chain = None
    for bound, _, tier, decision in RISK_TIERS:
        text = F.concat(F.lit(f"{tier} risk ("), share, F.lit(f") — Recommendation: {decision}"))
        if bound is None:
            return chain.otherwise(text)
        chain = F.when(probability < bound, text) if chain is None else chain.when(probability < bound, text)
    return chain


def with_tier(df: DataFrame, probability: str, model_name: str) -> DataFrame:
    """The score record: rounded probability, HIGH/LOW label, level, text and model name."""
    p = F.col(probability)
    return df.withColumns(
        {
            "default_probability": F.round(p, 4),
            "prediction": F.when(p >= HIGH_RISK_FROM, "HIGH RISK").otherwise("LOW RISK"),
            "risk_level": risk_level(p),
            "risk_description": _tier_text(p),
            "model": F.lit(model_name),
        }
    )


def predict_probability(
    df: DataFrame, features: FeatureModel, model: PipelineModel, keep: Sequence[str], output: str = "score"
) -> DataFrame:
    """Feature projection and model in one plan."""
    return model.transform(features.transform(df, keep)).select(
        *[F.col(quote_name(c)) for c in keep], vector_to_array("probability")[1].alias(output)
    )


def explode_scenarios(df: DataFrame, scenarios: Mapping[str, Mapping] | None = None, output: str = "scenario") -> DataFrame:
    """Every row once per named input set; inputs a set does not name keep the row's own value."""
    scenarios = scenarios or SCENARIOS
    names = sorted({c for s in scenarios.values() for c in s} & set(df.columns))
    sets = [
        F.struct(
            F.lit(name).alias(output),
            *[
                (F.lit(values[c]) if values.get(c) is not None else F.lit(None)).cast(df.schema[c].dataType).alias(f"_{c}")
                for c in names
            ],
        )
        for name, values in scenarios.items()
    ]
    wide = df.select("*", F.inline(F.array(*sets)))
    return wide.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(quote_name(c))) for c in names}).drop(
        *[f"_{c}" for c in names]
    )


def linear_contributions(
    df: DataFrame, weights: Mapping[str, float], top: int = 8, output: str = "contributions"
) -> DataFrame:
    """The ``top`` terms of a linear model per row, largest magnitude first, as (feature, value) structs."""
    terms = F.array(
        *[
            F.struct(
                (-F.abs(F.col(quote_name(f)) * w)).alias("order"),
                F.lit(f).alias("feature"),
                (F.col(quote_name(f)) * w).alias("value"),
            )
            for f, w in weights.items()
        ]
    )
    ranked = F.slice(F.array_sort(terms), 1, top)
    return df.withColumn(output, F.transform(ranked, lambda t: F.struct(t["feature"].alias("feature"), t["value"].alias("value"))))


def model_weights(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    return dict(zip(features, [float(v) for v in model.stages[-1].coefficients.toArray()]))


def baseline_probability(bias) -> Column:
    """Probability before any feature contributes."""
    b = F.lit(bias) if not isinstance(bias, Column) else bias
    return 1.0 / (1.0 + F.exp(-b))
