from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import ranking, split


@pytest.fixture(scope="module")
def loans(spark):
    """Monthly dates; one month holds half of the early rows and spans the 80 % mark."""
    rng = np.random.default_rng(0)
    months = pd.date_range("2014-01-01", "2016-12-01", freq="MS")
    early = np.concatenate([rng.choice(months[:20], 500), np.repeat(months[24], 600), rng.choice(months[25:], 100)])
    late = rng.choice(pd.date_range("2017-01-01", "2017-12-01", freq="MS"), 200)
    other = np.repeat(np.array(["2010-01-01"], dtype="datetime64[ns]"), 10)
    dates = np.concatenate([early, late, other])
    pdf = pd.DataFrame({"id": rng.permutation(len(dates)), "d": pd.to_datetime(dates).date, "y": rng.integers(0, 2, len(dates))})
    return spark.createDataFrame(pdf, "id bigint, d date, y int").repartition(7).cache()


YEARS = [2014, 2015, 2016]


def test_split_by_rank_equals_the_window(loans):
    got = split.time_split(loans, "d", YEARS, [2017])
    early = loans.filter(F.year("d").isin(YEARS)).withColumn("r", F.percent_rank().over(Window.orderBy("d")))
    expected = {r["id"]: "train" if r["r"] < 0.8 else "val" for r in early.collect()}
    actual = {r["id"]: r["split"] for r in got.collect()}
    assert {k: v for k, v in actual.items() if v != "test"} == expected
    assert sum(v == "test" for v in actual.values()) == 200 and len(actual) == 1_400


def test_split_by_position_cuts_inside_a_heavy_date(loans):
    got = split.time_split(loans, "d", YEARS, [2017], tie_key="id").filter("split <> 'test'")
    early = loans.filter(F.year("d").isin(YEARS)).toPandas().sort_values(["d", "id"])
    cutoff = int(len(early) * 0.8)
    assert {r["id"] for r in got.filter("split = 'train'").collect()} == set(early["id"][:cutoff])
    assert {r["id"] for r in got.filter("split = 'val'").collect()} == set(early["id"][cutoff:])


def test_position_order_statistic_path(loans, monkeypatch):
    monkeypatch.setattr("ledgerline.functions.quantiles.VALUE_LIMIT", 5)
    test_split_by_position_cuts_inside_a_heavy_date(loans)


def test_splits_are_disjoint_and_in_order(loans):
    got = split.split_summary(split.time_split(loans, "d", YEARS, [2017]), "split", "y", "d")
    parts = {r["split"]: r for r in got.collect()}
    assert sum(p["n"] for p in parts.values()) == 1_400
    assert parts["train"]["date_max"] < parts["val"]["date_min"] <= parts["val"]["date_max"] < parts["test"]["date_min"]


def test_percent_rank_of_one_row(spark):
    df = spark.sql("select date'2014-01-01' d")
    assert split.with_percent_rank(df, "d", "r").first()["r"] == 0.0


def test_percent_rank_of_fine_timestamps(spark, monkeypatch):
    df = spark.range(3_000).select(F.col("id"), (F.timestamp_seconds(F.col("id") * F.col("id") % 997)).alias("t"))
    monkeypatch.setattr("ledgerline.operators.split.range_splits", lambda d, c: [100e6, 400e6, 401e6])
    got = {r["id"]: r["r"] for r in split.with_percent_rank(df, "t", "r").collect()}
    expected = df.withColumn("r", F.percent_rank().over(Window.orderBy("t"))).collect()
    assert got == {r["id"]: r["r"] for r in expected}


def test_empty_training_years(loans):
    got = split.time_split(loans, "d", [1999], [2017])
    assert {r["split"] for r in got.select("split").distinct().collect()} == {"test"}


def test_most_recent_rows(loans):
    for n in (0, 1, 333, 5_000):
        expected = loans.toPandas().sort_values(["d", "id"])["id"].tail(n).tolist() if n else []
        assert sorted(r["id"] for r in split.most_recent(loans, "d", "id", n).collect()) == sorted(expected)


def test_small_tables_are_not_sampled(loans):
    assert split.stratified_sample(loans, 10_000, "y").count() == loans.count()


def test_samples_keep_the_class_shares(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    exact = split.stratified_sample(df, 10_000, "y", key="id")
    assert {r["y"]: r["count"] for r in exact.groupBy("y").count().collect()} == {0: 8_000, 1: 2_000}
    assert exact.exceptAll(split.stratified_sample(df.repartition(5), 10_000, "y", key="id")).isEmpty()
    for sample in (exact, split.hash_sample(df, "id", 0.25)):
        counts = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
        assert sum(counts.values()) == pytest.approx(10_000, rel=0.05)
        assert counts[1] / sum(counts.values()) == pytest.approx(0.2, abs=0.02)


def test_hash_sample_ignores_partitioning(spark):
    df = spark.range(5_000)
    ids = lambda d: {r["id"] for r in split.hash_sample(d, "id", 0.1).collect()}
    assert ids(df.repartition(3)) == ids(df.repartition(11)) != {r["id"] for r in split.hash_sample(df, "id", 0.1, seed=1).collect()}


def test_rankings(rows):
    df = rows([("a", -9.0), ("b", 5.0), ("c", None), ("d", 5.0)], "k string, v double")
    keys = lambda d: [r["k"] for r in d.collect()]
    assert keys(ranking.top_n(df, "v", 2, ["k"])) == ["b", "d"]
    assert keys(ranking.sort_by_abs(df, "v", ["k"])) == ["a", "b", "d", "c"]
    assert keys(ranking.best_row(df, "v", ["k"])) == ["b"]
    stacked = ranking.stack_tables([df, rows([(1,)], "other int")])
    assert stacked.columns == ["k", "v", "other"] and stacked.count() == 5
