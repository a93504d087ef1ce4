"""Odd values: free text in CSV, type suffixes, NaN and infinite scores, columns without values, rows without a date."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import to_double
from ledgerline.operators import clean, evaluate, profile, split
from ledgerline.plans import layers
from ledgerline.sources import read_csv, write_csv
from ledgerline.sources.records import record_parts


def test_free_text_survives_csv(spark, tmp_path):
    texts = ['say "hi", ok', "line one\nline two", " blanks ", 'a\\"b', "plain", None]
    write_csv(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), f"{tmp_path}/t")
    back = {int(r.id): r.text for r in read_csv(spark, f"{tmp_path}/t", null_tokens=(), multi_line=True).collect()}
    assert back == dict(enumerate(texts))


@pytest.mark.parametrize("block", [64, 700, 10**8])
def test_records_with_line_breaks_are_read_block_by_block(spark, tmp_path, block):
    """One file, cut into many blocks, some of them within a quoted field; the rows are those of the table."""
    rng = random.Random(block)
    pieces = ["plain ", 'say "hi", ok ', "line\nbreak\n\n", ",", "x" * 90, "é漢 ", "\r\n", '""', " "]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randrange(6))) or None, "end") for i in range(400)]
    rows += [(400, "\n" * 300 + '"' * 7, "end"), (401, "last\nwithout end", "open\nline")]
    path = f"{tmp_path}/t"
    write_csv(spark.createDataFrame(rows, "`the id` int, text string, last string").coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        raw = read_csv(spark, path, null_tokens=(), multi_line=True)
        assert raw.columns == ["the id", "text", "last"]
        back = sorted((int(r["the id"]), r.text, r.last) for r in raw.collect())
        tasks = record_parts(spark, path).select("start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert back == [(i, None if t is None else t, e) for i, t, e in rows]
    assert tasks > 20 if block < 1_000 else tasks == 1


def test_numbers_without_type_suffix(spark):
    cases = {"12d": None, "7f": None, "1e3": 1000.0, " 5 ": 5.0, "": None, ".5": 0.5, "5.": 5.0, "-2": -2.0, "0x10": None, "inf": math.inf, "nan": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", to_double("t").alias("v")).collect()
    assert {r.t: r.v for r in rows} == cases


@pytest.fixture
def scores(spark):
    rows = [(0.9, 1), (0.8, 0), (float("nan"), 0), (float("nan"), 1), (0.2, 0), (None, 1), (float("inf"), 1), (0.7, 1)]
    return spark.createDataFrame(rows, "s double, y int")


def test_nan_scores_do_not_count(scores):
    good = scores.filter("s is not null and not isnan(s)")
    for f in (
        lambda d: evaluate.confusion_at(d, "s", "y"), lambda d: evaluate.threshold_sweep(d, "s", "y", [0.1, 0.5, 0.85]),
        lambda d: evaluate.precision_recall_points(d, "s", "y"), lambda d: evaluate.evaluate(d, "s", "y"),
        lambda d: evaluate.normalized_confusion(d, "s", "y"),
    ):
        assert sorted(map(str, f(scores).collect())) == sorted(map(str, f(good).collect()))


def test_infinite_scores_in_ranges(spark):
    rows = [(math.inf if i % 3 == 0 else -math.inf if i % 3 == 1 else i / 100, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    whole = evaluate.ranking_metrics(df, "s", "y").collect()
    assert evaluate.ranking_metrics(df, "s", "y", rows_per_bucket=10).collect() == whole


def test_profiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "x double, k int")
    assert profile.numeric_summary(df, ["x"]).count() == 0
    assert profile.numeric_summary(df, ["absent"]).count() == 0
    assert profile.iqr_outliers(df, ["x"]).count() == 0
    assert profile.box_stats(df, ["x"]).count() == 0
    assert profile.consistency_report(df, [("rule", ["absent"], "absent > 0")]).count() == 0
    assert clean.count_impossible(df, {"absent": "absent < 0"}).count() == 0
    assert profile.numeric_summary(df, ["x", "k"]).columns == profile.numeric_summary(df, ["x"]).columns


def test_rows_without_a_date_stay(spark):
    df = spark.createDataFrame([(1, dt.date(2015, 1, 1)), (2, None), (3, dt.date(2016, 1, 1))], "id int, d date")
    ranked = {r.id: r.p for r in split.with_percent_rank(df, "d", "p").collect()}
    assert ranked == {1: 0.0, 2: None, 3: 1.0}


def test_samples_keep_every_class(spark):
    df = spark.range(20_000).withColumn("y", F.when(F.col("id") % 4 == 3, None).otherwise(F.col("id") % 4))
    drawn = {r.y: r["count"] for r in split.stratified_sample(df, 4_000, "y").groupBy("y").count().collect()}
    assert set(drawn) == {0, 1, 2, None} and all(850 <= n <= 1150 for n in drawn.values())


def test_gold_keeps_all_rows_unless_asked(monkeypatch, spark):
    rows = [(i, dt.date(2015 + i % 3, 1 + i % 12, 1), i % 2) for i in range(3000)]
    loans = spark.createDataFrame(rows, "id int, issue_d date, target int")
    from ledgerline import config as cfg

    loans = loans.withColumnRenamed("target", cfg.TARGET)
    whole = layers.gold(loans)
    kept = loans.filter(F.year("issue_d").isin([*cfg.TRAIN_YEARS, cfg.TEST_YEAR])).count()
    assert sum(p.count() for p in whole.values()) == kept
    assert layers.gold(loans, train_rows=100)["train"].count() < whole["train"].count()
