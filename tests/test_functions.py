from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import functions as fn
from ledgerline import session
from ledgerline.config import EMP_LENGTH_ORDINALS
from ledgerline.functions.ordering import BUCKET, range_splits, running_sums, with_range_bucket
from ledgerline.functions.quantiles import exact_quantiles, order_statistics, quantiles_with
from ledgerline.functions.sizing import broadcast_if_small, is_small, lookup_join


def one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_messy_text_never_raises(rows):
    df = rows([(" 36 months",), ("12.5%",), ("",), ("n/a",), (None,), ("10+ years",), ("Oct-1981",), ("2010-01",)], "s string")
    assert one(df, fn.leading_integer("s")) == [36, 12, None, None, None, 10, 1981, 2010]
    assert one(df, fn.percent_to_double("s"))[1] == 12.5
    assert one(df, fn.percent_to_double("s"))[2:5] == [None, None, None]
    assert one(df, fn.lookup("s", EMP_LENGTH_ORDINALS, -1)) == [-1, -1, -1, -1, -1, 10, -1, -1]
    assert [str(v) for v in one(df, fn.month_text_to_date("s"))][6] == "1981-10-01"
    assert one(df, fn.month_text_to_date("s"))[:6] == [None] * 6
    assert str(one(df, fn.iso_to_date("s"))[7]) == "2010-01-01"
    assert one(df, fn.to_double("s"))[0] is None


def test_nan_counts_as_missing(rows):
    df = rows([(float("nan"),), (None,), (1.0,)], "x double")
    assert one(df, fn.nan_to_null("x")) == [None, None, 1.0]
    assert df.filter(fn.is_missing(df.schema["x"])).count() == 2


def test_clipping_keeps_null(rows):
    df = rows([(9.0,), (None,), (-3.0,)], "x double")
    assert one(df, fn.cap_above("x", 5.0)) == [5.0, None, -3.0]
    assert one(df, fn.floor_below("x", 0.0)) == [9.0, None, 0.0]


def test_annuity_has_a_zero_rate_branch(rows):
    df = rows([(1200.0, 0.0, 12), (1200.0, 12.0, 12), (None, 12.0, 12)], "a double, r double, n int")
    zero, paid, missing = one(df, fn.annuity_payment("a", "r", "n"))
    assert zero == 100.0 and missing is None
    assert paid == pytest.approx(1200 * 0.01 * 1.01**12 / (1.01**12 - 1))


def test_ordinal_position(rows):
    df = rows([("B",), ("Z",), (None,)], "g string")
    assert one(df, fn.ordinal_position("g", ["A", "B"])) == [1.0, -1.0, None]


def test_month_difference_ignores_days(rows):
    df = rows([("2014-03-01", "2013-12-31")], "a string, b string").select(*[F.col(c).cast("date").alias(c) for c in "ab"])
    assert one(df, fn.month_difference("a", "b")) == [3]


@pytest.mark.parametrize("values", [[1.0, 2.0, 7.0, 3.0, 9.5], [4.0, 4.0, 4.0, 4.0], [1.0, 2.0], [3.0], []])
def test_moments_equal_pandas(rows, values):
    df = rows([(v,) for v in values] + [(None,)], "x double")
    skew, kurt = df.agg(fn.skewness_corrected("x"), fn.kurtosis_corrected("x")).first()
    series = pd.Series(values, dtype="float64")
    for ours, theirs in ((skew, series.skew()), (kurt, series.kurtosis())):
        if math.isnan(theirs):
            assert ours is None
        else:
            assert ours == pytest.approx(theirs)


def _skewed_values(n, seed):
    rng = random.Random(seed)
    # One value holds a third of the rows; the others are far apart in size.
    return [5.0 if rng.random() < 1 / 3 else rng.lognormvariate(0, 4) for _ in range(n)]


@pytest.mark.parametrize("limits", [{"sketch": 8}, {"sketch": 200}, {}])
def test_quantiles_equal_numpy_with_any_sketch(spark, limits):
    values = _skewed_values(20_000, 1)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).withColumn("empty", F.lit(None).cast("double"))
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, ["x", "empty"], probabilities, **limits)
    assert got["x"] == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)
    assert got["empty"] == [None] * len(probabilities)


def test_order_statistics_keep_large_integers_exact(spark):
    base = 2**60
    df = spark.range(0, 5_000).select((F.lit(base) + F.col("id") * 3).alias("k"))
    got = order_statistics(df, {"k": F.col("k")}, {"k": [0, 1_234, 4_999]}, value_limit=10)
    assert got == {("k", 0): base, ("k", 1_234): base + 3_702, ("k", 4_999): base + 14_997}
    with pytest.raises(ValueError):
        order_statistics(df, {"k": F.col("k")}, {"k": [5_000]})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-50, 50).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=60), st.floats(0, 1))
def test_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [p], sketch=8)["x"][0]
    assert got == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [100, 10**9])
def test_running_sums_equal_one_window(spark, descending, rows_per_bucket):
    values = sorted(set(_skewed_values(3_000, 2)))
    pdf = pd.DataFrame({"v": values, "n": [i % 7 + 1 for i in range(len(values))], "g": [i % 2 for i in range(len(values))]})
    df = spark.createDataFrame(pdf)
    splits = range_splits(df, "v", rows_per_bucket)
    assert bool(splits) == (rows_per_bucket == 100)
    got = running_sums(df, "v", {"upto": "n"}, splits, descending, by=["g"], totals={"all": "n"}).toPandas()
    pdf = pdf.sort_values("v", ascending=not descending)
    pdf["upto"] = pdf.groupby("g")["n"].cumsum()
    pdf["all"] = pdf.groupby("g")["n"].transform("sum")
    merged = got.merge(pdf, on=["v", "g"], suffixes=("", "_expected"))
    assert len(merged) == len(pdf)
    assert (merged["upto"] == merged["upto_expected"]).all() and (merged["all"] == merged["all_expected"]).all()


def test_equal_values_share_a_range(spark):
    df = spark.createDataFrame([(v,) for v in _skewed_values(2_000, 3)], "v double")
    cut = with_range_bucket(df, "v", range_splits(df, "v", 100))
    assert cut.groupBy("v").agg(F.countDistinct(BUCKET).alias("k")).filter("k > 1").count() == 0
    assert cut.select(BUCKET).distinct().count() > 5


def test_broadcast_only_below_the_bound(spark):
    small, large = spark.range(5), spark.range(50)
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" in plan(broadcast_if_small(small, 10)) or "broadcast" in plan(broadcast_if_small(small, 10)).lower()
    assert "broadcast" not in plan(broadcast_if_small(large, 10)).lower()


def test_size_counts_text_bytes(spark):
    long = spark.createDataFrame([("x" * 1_000,)] * 20, "s string")
    assert is_small(long, 20, 50_000) and not is_small(long, 20, 10_000) and not is_small(long, 10, 50_000)


def test_lookup_join_is_the_same_broadcast_or_salted(spark):
    fact = spark.createDataFrame([(i, None if i % 10 == 0 else "hot" if i % 3 else f"k{i % 7}") for i in range(200)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1.0), ("k0", 2.0), ("k3", None)], "k string, v double")
    results = [sorted(map(tuple, lookup_join(fact, lookup, "k", max_rows=n).collect()), key=repr) for n in (100, 1)]
    assert results[0] == results[1] and len(results[0]) == 200
    assert lookup_join(fact, lookup, "k", max_rows=1).columns == lookup_join(fact, lookup, "k").columns


def test_files_go_to_the_folder_the_cluster_names(spark, monkeypatch):
    local = session.shared_dir(spark)
    assert local == session.shared_dir(spark)

    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/work" if key == "spark.checkpoint.dir" else default

    class Cluster:
        conf = Conf()

    assert session.shared_dir(Cluster()) == "hdfs://shared/work"
    assert session.shared_path(Cluster(), "x").startswith("hdfs://shared/work/x-")


@pytest.fixture
def scans(spark, tmp_path):
    """How often the rows of a file are read, counted in its only row filter."""

    def make(pdf):
        counter = spark.sparkContext.accumulator(0)
        spark.createDataFrame(pdf).coalesce(1).write.parquet(str(tmp_path / "rows"))

        def counted(batches):
            counter.add(1)
            yield from batches

        df = spark.read.parquet(str(tmp_path / "rows"))
        return df.mapInPandas(counted, df.schema), counter

    return make


def test_quantiles_and_moments_take_two_scans(scans):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": rng.lognormal(0, 3, 30_000), "y": rng.integers(0, 5, 30_000).astype(float)})
    df, counter = scans(pdf)
    exprs = {c: F.col(c) for c in pdf}
    got, sums, above = quantiles_with(df, exprs, [0.01, 0.25, 0.5, 0.99], F.sum, lambda _, e, total: e > total / len(pdf))
    assert counter.value == 2
    for c in pdf:
        assert got[c] == pytest.approx(list(np.quantile(pdf[c], [0.01, 0.25, 0.5, 0.99])), rel=1e-12)
        assert sums[c] == pytest.approx(pdf[c].sum()) and above[c] == (pdf[c] > sums[c] / len(pdf)).sum()


def test_unproven_intervals_are_widened(spark, monkeypatch):
    monkeypatch.setattr("ledgerline.functions.quantiles.MARGIN", 0.0)
    values = _skewed_values(30_000, 9)
    got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": values})), ["x"], [0.1, 0.5, 0.9], sketch=8)
    assert got["x"] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9])), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]} and exact_quantiles(df, [], [0.5]) == {}
