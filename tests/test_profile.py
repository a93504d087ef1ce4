from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import profile


def by(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_missing_rates_see_nan_and_null(rows):
    df = rows([(None, float("nan"), 1), ("a", 1.0, 1), ("b", 2.0, 1), (None, 3.0, 1)], "s string, x double, i int")
    got = by(profile.missing_rates(df, 0.30))
    assert [(got[c]["missing"], got[c]["action"]) for c in ("s", "x", "i")] == [(2, "DROP"), (1, "impute"), (0, "keep")]
    summary = profile.missing_summary(df).first()
    assert (summary["missing_cells"], summary["columns_with_any"], summary["columns_over"]) == (3, 2, 1)


def test_duplicates_count_null_as_equal(rows):
    df = rows([(1, None), (1, None), (2, 3), (2, 3), (2, 3), (None, None)], "a int, b int")
    assert profile.duplicate_count(df).first()["n_duplicates"] == 3
    assert profile.duplicate_count(df, ["a"]).first()["n_duplicates"] == 3
    assert profile.duplicate_count(df.limit(0)).first()["n_duplicates"] == 0


@pytest.mark.parametrize("rows_per_bucket", [50, 10**9])
def test_order_check_counts_every_inversion(spark, rows_per_bucket):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 40, 2_000)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(2_000), "v": values}))
    got = profile.order_check(df.orderBy(F.rand(1)), "v", "k", rows_per_bucket).first()
    assert got["n_inversions"] == int((np.diff(values) < 0).sum()) and got["n_pairs"] == 1_999
    assert not got["is_sorted"]
    assert profile.order_check(df.withColumn("v", F.col("k")), "v", "k", rows_per_bucket).first()["is_sorted"]


def test_numeric_summary_reads_percent_text(rows):
    df = rows([("10%",), ("12.5%",), (None,), ("junk",)] + [("11%",)] * 20 + [("900%",)], "r string")
    got = by(profile.numeric_summary(df, ["r", "absent"]))
    assert list(got) == ["r"]
    assert (got["r"]["min"], got["r"]["median"], got["r"]["max"], got["r"]["outliers"]) == (10.0, 11.0, 900.0, 1)


def test_class_balance_without_positives(rows):
    got = profile.class_balance(rows([("paid",)] * 3 + [("late",)], "s string"), "s", "bad", "paid").first()
    assert got["n_total"] == 3 and got["imbalance"] == float("inf") and got["severity"] == "Severe"


def test_value_counts_keep_null(rows):
    got = profile.value_counts(rows([("a",), (None,), (None,)], "s string"), "s").collect()
    assert sorted((r["value"] or "", r["n"]) for r in got) == [("", 2), ("a", 1)]


def test_drift(rows):
    data = [("2014-01-01", i < 1) for i in range(10)] + [("2015-01-01", i < 3) for i in range(10)]
    df = rows([(d, int(y)) for d, y in data], "d string, y int").withColumn("d", F.col("d").cast("date"))
    got = profile.drift_summary(df, "d", "y").first()
    assert got["rate_range"] == pytest.approx(0.2) and got["drifted"]


def test_type_census(rows):
    df = rows([("1%", "36 months", "x", 1, None), ("2.5", "60", "7", 2, None)], "p string, t string, c string, n int, e string")
    kinds = {r["column"]: r["kind"] for r in profile.type_census(df).collect()}
    assert kinds == {"p": "numeric_text", "t": "numeric_text", "c": "categorical", "n": "numeric", "e": "numeric_text"}


def test_describe_equals_pandas(spark):
    x = np.random.default_rng(3).lognormal(size=500)
    got = profile.describe(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"]).first()
    expected = pd.Series(x).describe()
    for ours, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("q1", "25%"), ("median", "50%"), ("q3", "75%")):
        assert got[ours] == pytest.approx(expected[theirs])
    assert got["skew"] == pytest.approx(pd.Series(x).skew()) and got["kurtosis"] == pytest.approx(pd.Series(x).kurtosis())


def test_profiles_of_an_empty_column(rows):
    df = rows([(None, 1.0), (None, 2.0)], "gone double, x double")
    assert by(profile.describe(df, ["gone", "x"]))["gone"]["n"] == 0
    assert list(by(profile.iqr_outliers(df, ["gone", "x"], keep_zero=True))) == ["x"]
    assert list(by(profile.numeric_summary(df, ["gone", "x"]))) == ["x"]
    assert profile.histogram(df, "gone").count() == 0


def test_histogram_puts_the_maximum_in_the_last_bin(rows):
    df = rows([(float(i),) for i in range(101)], "x double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 10).collect()}
    assert got == {**{i: 10 for i in range(1, 10)}, 10: 11}
    constant = profile.histogram(rows([(3.0,)] * 4, "x double"), "x", 10).collect()
    assert [r["n"] for r in constant] == [4]


def test_box_stats_by_class(rows):
    df = rows([(0, float(v)) for v in (1, 2, 3, 4, 100)] + [(1, 7.0)], "y int, x double")
    got = {(r["column"], r["class"]): r for r in profile.box_stats(df, ["x"], "y", [0, 1]).collect()}
    zero = got["x", "0"]
    assert (zero["q1"], zero["median"], zero["q3"], zero["whisker_low"], zero["whisker_high"], zero["fliers"]) == (2, 3, 4, 1, 4, 1)
    assert got["x", "1"]["n"] == 1


def test_rates_skip_columns_of_many_levels(rows):
    df = rows([(str(i), "a" if i % 2 else None, i % 3 == 0) for i in range(30)], "many string, few string, f boolean")
    got = profile.rates_by_category(df.withColumn("y", F.col("f").cast("int")), ["many", "few"], "y").collect()
    assert [(r["column"], r["value"], r["n"]) for r in got] == [("few", "a", 15)]


def test_wide_correlations_equal_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(400, 6)) + 1e6, columns=list("abcdef"))
    pdf["b"] = pdf["a"] * 2 + rng.normal(size=400) * 0.1
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    pdf["k"] = 7.0
    expected = pdf.corr()
    df = spark.createDataFrame(pdf).repartition(3)
    for r in profile.correlations(df, list(pdf.columns)).collect():
        theirs = expected.loc[r["a"], r["b"]]
        assert (r["r"] is None) if np.isnan(theirs) else r["r"] == pytest.approx(theirs, abs=1e-9)
    assert [(r["a"], r["b"]) for r in profile.correlated_pairs(df, list(pdf.columns), 0.8).collect()] == [("a", "b")]


def test_correlations_alike_for_few_and_many_columns(spark):
    """300 columns give the NULLs and values that their first ten give, constants on the common rows included."""
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(size=(60, 300)), columns=[f"c{i}" for i in range(300)])
    pdf["c1"], pdf["c2"] = 1e9 + 0.1, np.where(np.arange(60) < 30, 5.0, np.nan)
    pdf["c3"] = np.where(np.arange(60) < 30, 0.1, 0.3)
    df = spark.createDataFrame(pdf).repartition(3)
    few = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, list(pdf.columns)[:10]).collect()}
    many = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, list(pdf.columns)).collect()}
    assert len(few) == 45 and len(many) == 300 * 299 // 2
    assert all(many[p] == pytest.approx(r, abs=1e-12) if r is not None else many[p] is None for p, r in few.items())
    assert few["c1", "c4"] is None and few["c2", "c3"] is None and few["c3", "c4"] is not None


def test_skew_screen_uses_non_negative_values_for_the_log(spark):
    x = np.append(np.random.default_rng(1).lognormal(sigma=2, size=300), [-5.0])
    got = profile.skew_screen(spark.createDataFrame(pd.DataFrame({"x": x, "u": np.arange(301.0)})), ["x", "u"]).collect()
    assert [r["column"] for r in got] == ["x"]
    assert got[0]["skew"] == pytest.approx(pd.Series(x).skew())
    assert got[0]["log_skew"] == pytest.approx(pd.Series(np.log1p(x[x >= 0])).skew())


def test_cardinality_breaks_ties_by_value(rows):
    got = profile.cardinality(rows([("b",), ("a",), (None,)], "s string"), ["s"]).first()
    assert (got["n_unique"], got["top_value"]) == (2, "a")
