"""Feature engineering: fitted on the training rows, applied to any rows.

Fitting runs a fixed number of aggregates and keeps their few results; applying is a plain
projection of column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import (
    annuity_payment,
    cap_above,
    floor_below,
    month_difference,
    nan_to_null,
    ordinal_position,
    quote_name,
    ratio_plus_one,
)
from ledgerline.functions.numeric import as_column, project
from ledgerline.functions.quantiles import exact_quantiles
from ledgerline.functions.sizing import lookup_join
from ledgerline.operators.levels import Levels, fit_levels
from ledgerline.operators.profile import value_counts_long
from ledgerline.session import shared_path, stored

# Largest category list that is turned into one column per level. A longer one becomes entries of a sparse vector.
MAX_LEVELS = 5_000
WIDE = "wide_levels"


def add_date_parts(
    df: DataFrame,
    issued: str,
    first_credit: str,
    year: str = "issue_year",
    month: str = "issue_month",
    history: str = "credit_history_months",
) -> DataFrame:
    """Year and month of one date, whole months since the other (at least 0); both dates are dropped."""
    return df.withColumns(
        {
            year: F.year(issued).cast("double"),
            month: F.month(issued).cast("double"),
            history: floor_below(month_difference(issued, first_credit), 0).cast("double"),
        }
    ).drop(issued, first_credit)


def loan_to_income(amount: str, income: str) -> Column:
    return ratio_plus_one(amount, income)


def payment_to_income(amount: str, rate: str, months: str, income: str) -> Column:
    """Monthly payment over monthly income plus one."""
    return F.try_divide(annuity_payment(amount, rate, months), as_column(income).cast("double") / 12.0 + 1.0)


def delinquency_rate(delinquencies: str, accounts: str) -> Column:
    return ratio_plus_one(delinquencies, accounts)


def add_loan_ratios(
    df: DataFrame,
    amount: str = "loan_amnt",
    income: str = "annual_inc",
    rate: str = "int_rate",
    months: str = "term",
    delinquencies: str = "delinq_2yrs",
    accounts: str = "total_acc",
) -> DataFrame:
    return df.withColumns(
        {
            "loan_to_income": loan_to_income(amount, income),
            "monthly_payment_to_income": payment_to_income(amount, rate, months, income),
            "delinq_rate": delinquency_rate(delinquencies, accounts),
        }
    )


def _value(column: str) -> Column:
    return nan_to_null(as_column(column).cast("double"))


def fit_caps(train: DataFrame, columns: Sequence[str], quantile: float) -> dict[str, float]:
    present = [c for c in columns if c in train.columns]
    fitted = exact_quantiles(train, {c: _value(c) for c in present}, [quantile])
    return {c: q[0] for c, q in fitted.items() if q[0] is not None}


def apply_caps(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: cap_above(c, cap) for c, cap in caps.items() if c in df.columns})


def add_missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {f"{c}_missing": _value(c).isNull().cast("double") for c in columns if c in df.columns}
    )


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` over all listed columns in one scan."""
    return value_counts_long(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def rare_levels(train: DataFrame, columns: Sequence[str], threshold: int) -> DataFrame:
    """``(column, value)`` of the levels seen fewer than ``threshold`` times in training."""
    present = [c for c in columns if c in train.columns]
    return level_counts(train, present).filter(F.col("n") < threshold).select("column", "value")


def merge_rare(df: DataFrame, rare: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Rare levels become ``label``; levels never seen in training stay as they are.

    A short list goes into the expression; a long one is joined.
    """
    listed = rare.limit(MAX_LEVELS + 1).collect()
    if len(listed) <= MAX_LEVELS:
        by_column: dict[str, list[str]] = {}
        for r in listed:
            by_column.setdefault(r["column"], []).append(r["value"])
        return df.withColumns(
            {c: F.when(F.col(quote_name(c)).isin(*v), label).otherwise(F.col(quote_name(c))) for c, v in by_column.items()}
        )
    out = df
    for c in columns:
        one = rare.filter(F.col("column") == c).select(F.col("value").alias(c), F.lit(True).alias("_rare"))
        out = lookup_join(out, one, c).withColumn(c, F.when(F.col("_rare"), label).otherwise(F.col(c))).drop("_rare")
    return out.select(*df.columns)


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    fitted = exact_quantiles(train, {c: _value(c) for c in columns}, [0.5])
    return {c: q[0] for c, q in fitted.items() if q[0] is not None}


def fit_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column; the smallest of equally frequent ones."""
    tops = level_counts(train, columns).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )
    return {r["column"]: r["mode"] for r in tops.collect()}


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(quote_name(c)), F.lit(v)) for c, v in values.items()})


def above_zero(column: str) -> Column:
    """1.0 for a positive value, else 0.0, also for a missing one."""
    return (F.coalesce(_value(column), F.lit(0.0)) > 0).cast("double")


def fit_scale(train: DataFrame, exprs: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each expression; a constant's deviation is exactly 0."""
    train, exprs = project(train, exprs)
    deviation = lambda e: F.when(F.min(e) < F.max(e), F.stddev_pop(e)).otherwise(0.0)
    row = train.agg(
        *[F.struct(F.avg(e), deviation(e)).alias(f"s{i}") for i, e in enumerate(exprs.values())]
    ).first()
    return {n: (row[i][0], row[i][1]) for i, n in enumerate(exprs) if row[i][0] is not None}


def standardized(e: Column, mean: float, deviation: float) -> Column:
    """Zero mean and unit population deviation; a constant becomes 0."""
    return (e - F.lit(mean)) / F.lit(deviation if deviation else 1.0)


def one_hot(e: Column, column: str, levels: Sequence[str], drop_first: bool) -> dict[str, Column]:
    """A 0/1 column per level; an unseen level is 0 everywhere."""
    kept = list(levels)[1:] if drop_first else list(levels)
    return {f"{column}_{v}": F.coalesce((e == F.lit(v)).cast("double"), F.lit(0.0)) for v in kept}


@dataclass
class FeatureSpec:
    """Which columns get which treatment. Every other numeric column is imputed and scaled."""

    skewed: list[str] = field(default_factory=list)
    binarized: list[str] = field(default_factory=list)
    capped: list[str] = field(default_factory=list)
    cap_quantile: float = 0.99
    ordinal: dict[str, list[str]] = field(default_factory=dict)
    one_hot: list[str] = field(default_factory=list)
    rare: list[str] = field(default_factory=list)
    rare_threshold: int = 50
    rare_label: str = "other"
    drop_first: bool = True
    exclude: list[str] = field(default_factory=list)


def route_columns(df: DataFrame, spec: FeatureSpec) -> dict[str, list[str]]:
    """The columns present, by treatment; columns that fit none are dropped."""
    have = set(df.columns)
    groups = {
        "skewed": [c for c in spec.skewed if c in have],
        "binarized": [c for c in spec.binarized if c in have],
        "ordinal": [c for c in spec.ordinal if c in have],
        "one_hot": [c for c in spec.one_hot if c in have],
    }
    taken = {c for g in groups.values() for c in g} | set(spec.exclude)
    groups["normal"] = [
        f.name for f in df.schema.fields if f.name not in taken and isinstance(f.dataType, T.NumericType)
    ]
    return groups


@dataclass
class FeatureModel:
    """Everything learned from the training rows, as plain values."""

    spec: FeatureSpec
    groups: dict[str, list[str]]
    caps: dict[str, float]
    medians: dict[str, float]
    modes: dict[str, str]
    levels: dict[str, list[str]]
    rare: dict[str, list[str]]
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    wide: str | None = None  # folder of the levels of one-hot columns that have too many for a column each

    def _numeric(self, column: str) -> Column:
        e = _value(column)
        if column in self.caps:
            e = cap_above(e, self.caps[column])
        e = F.coalesce(e, F.lit(self.medians[column]))
        return F.log1p(e) if column in self.groups["skewed"] else e

    def _category(self, column: str) -> Column:
        e = F.col(quote_name(column)).cast("string")
        if self.rare.get(column):
            e = F.when(e.isin(*self.rare[column]), self.spec.rare_label).otherwise(e)
        return F.coalesce(e, F.lit(self.modes[column]))

    def scaled_inputs(self) -> dict[str, Column]:
        """The expressions that are scaled: skewed, normal and ordinal columns."""
        numeric = [c for g in ("skewed", "normal") for c in self.groups[g] if c in self.medians]
        out = {c: self._numeric(c) for c in numeric}
        for c in self.groups["ordinal"]:
            if c in self.modes:
                out[c] = ordinal_position(self._category(c), self.spec.ordinal[c])
        return out

    def expressions(self) -> dict[str, Column]:
        """Feature name -> expression, in output order."""
        scaled = {c: standardized(e, *self.scale[c]) for c, e in self.scaled_inputs().items()}
        out = {c: scaled[c] for c in self.groups["skewed"] if c in scaled}
        out.update({c: above_zero(c) for c in self.groups["binarized"]})
        out.update({c: scaled[c] for c in self.groups["normal"] if c in scaled})
        out.update({c: scaled[c] for c in self.groups["ordinal"] if c in scaled})
        for c in self.groups["one_hot"]:
            if c in self.modes:
                out.update(one_hot(self._category(c), c, self.levels[c], self.spec.drop_first))
        return out

    @property
    def feature_names(self) -> list[str]:
        return [*self.expressions(), *([WIDE] if self.wide else [])]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The features, after the columns of ``keep``; columns of very many levels share one sparse vector."""
        wide = []
        if self.wide:
            df, wide = Levels.load(df.sparkSession, self.wide).encoded(df, WIDE, self.spec.drop_first), [WIDE]
        return df.select(
            *[F.col(quote_name(c)) for c in keep], *[e.alias(n) for n, e in self.expressions().items()], *wide
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """One text file, and beside it the folder of long level lists."""
        if self.wide:
            Levels.load(spark, self.wide).save(f"{path}.levels")
            self.wide = f"{path}.levels"
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        state = json.loads(spark.read.text(path).first()[0])
        state["spec"] = FeatureSpec(**state["spec"])
        state["scale"] = {c: tuple(v) for c, v in state["scale"].items()}
        return FeatureModel(**state)


def _collect_levels(train: DataFrame, columns: Sequence[str], spec: FeatureSpec):
    """Modes, sorted level lists and rare lists after merging, from one count over all columns; and the columns too long for lists."""
    counts = stored(level_counts(train, columns), "levels")
    sizes = {r["column"]: r["n_levels"] for r in counts.groupBy("column").agg(F.count("*").alias("n_levels")).collect()}
    short = [c for c in columns if sizes.get(c, MAX_LEVELS + 1) <= MAX_LEVELS]
    listed = counts.filter(F.col("column").isin(*short)).collect() if short else []
    modes, levels, rare = {}, {}, {}
    for c in short:
        found = {r["value"]: r["n"] for r in listed if r["column"] == c}
        if c in spec.rare:
            rare[c] = sorted(v for v, n in found.items() if n < spec.rare_threshold)
            merged = sum(found.pop(v) for v in rare[c])
            if merged:
                found[spec.rare_label] = found.get(spec.rare_label, 0) + merged
        modes[c] = min(found, key=lambda v: (-found[v], v))
        levels[c] = sorted(found)
    return modes, levels, rare, [c for c in columns if sizes.get(c, 0) > MAX_LEVELS]


def fit_features(train: DataFrame, spec: FeatureSpec) -> FeatureModel:
    """Learn caps, medians, modes, levels and scales from the training rows only."""
    groups = route_columns(train, spec)
    numeric = groups["skewed"] + groups["normal"]
    quantiles = exact_quantiles(train, {c: _value(c) for c in numeric}, [0.5, spec.cap_quantile])
    caps = {c: quantiles[c][1] for c in spec.capped if c in quantiles and quantiles[c][1] is not None}
    # Capping does not change the order, so the median of the capped values is the capped median.
    medians = {c: min(q[0], caps.get(c, q[0])) for c, q in quantiles.items() if q[0] is not None}
    text = groups["ordinal"] + groups["one_hot"]
    modes, levels, rare, wide = _collect_levels(train, text, spec) if text else ({}, {}, {}, [])
    model = FeatureModel(spec, groups, caps, medians, modes, levels, rare)
    if wide:
        long = fit_levels(train, wide, [c for c in wide if c in spec.rare], spec.rare_threshold, spec.rare_label)
        model.modes |= {c: long.modes[c] for c in wide if c in groups["ordinal"]}
        hot = [c for c in wide if c in groups["one_hot"]]
        if hot:
            model.wide = shared_path(train.sparkSession, "levels")
            Levels(long.dictionary, {c: long.sizes[c] for c in hot}, long.modes).save(model.wide)
    inputs = model.scaled_inputs()
    model.scale = fit_scale(train, inputs) if inputs else {}
    return model


def plain_spec(categorical: Sequence[str], exclude: Sequence[str]) -> FeatureSpec:
    """Median and scale for numbers, every level of the categories, nothing else."""
    return FeatureSpec(one_hot=list(categorical), exclude=list(exclude), drop_first=False)


def sparse_one_hot(columns: Sequence[str], output: str = "categories") -> Pipeline:
    """Sparse 0/1 vector over all levels seen in training; an unseen level gives no entry."""
    index = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    # "keep" adds a last slot for unseen levels, which dropLast takes off again.
    encode = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vector" for c in columns], dropLast=True
    )
    join = VectorAssembler(inputCols=[f"{c}_vector" for c in columns], outputCol=output)
    return Pipeline(stages=[index, encode, join])
