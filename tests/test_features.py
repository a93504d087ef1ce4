from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import features as fe
from ledgerline.operators import levels
from ledgerline.operators import models as md


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(0)
    n = 400
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "wide": rng.lognormal(sigma=1.5, size=n),
            "plain": rng.normal(size=n),
            "count": rng.integers(0, 3, n).astype(float),
            "constant": 4.0,
            "grade": rng.choice(["A", "B", "C"], n),
            "home": rng.choice(["RENT", "OWN", "MORTGAGE"], n, p=[0.6, 0.37, 0.03]),
            "y": rng.integers(0, 2, n),
        }
    )
    for c in ("wide", "plain", "count"):
        pdf.loc[rng.random(n) < 0.1, c] = np.nan
    for c in ("grade", "home"):
        pdf.loc[rng.random(n) < 0.1, c] = None
    schema = "id bigint, wide double, plain double, count double, constant double, grade string, home string, y bigint"
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), schema)
    return pdf.iloc[:300], pdf.iloc[300:], df.filter("id < 300"), df.filter("id >= 300")


SPEC = fe.FeatureSpec(
    skewed=["wide"], binarized=["count"], capped=["wide"], cap_quantile=0.9, ordinal={"grade": ["A", "B", "C"]},
    one_hot=["home"], rare=["home"], rare_threshold=20, exclude=["id", "y"],
)


def expected(train, rows):
    """The same treatment in pandas."""
    cap = train["wide"].quantile(0.9)
    median = train["wide"].clip(upper=cap).median()
    log = lambda p: np.log1p(p["wide"].clip(upper=cap).fillna(median))
    out = pd.DataFrame({"wide": (log(rows) - log(train).mean()) / log(train).std(ddof=0)})
    out["count"] = (rows["count"].fillna(0) > 0).astype(float)
    plain = lambda p: p["plain"].fillna(train["plain"].median())
    out["plain"] = (plain(rows) - plain(train).mean()) / plain(train).std(ddof=0)
    out["constant"] = 0.0
    grade = lambda p: p["grade"].fillna(train["grade"].mode()[0]).map({"A": 0, "B": 1, "C": 2})
    out["grade"] = (grade(rows) - grade(train).mean()) / grade(train).std(ddof=0)
    counts = train["home"].value_counts()
    rare = list(counts[counts < 20].index)
    home = lambda p: p["home"].replace(rare, "other")
    filled = home(rows).fillna(home(train).mode()[0])
    for level in sorted(home(train).fillna(home(train).mode()[0]).unique())[1:]:
        out[f"home_{level}"] = (filled == level).astype(float)
    return out


def test_chain_equals_pandas(frames):
    train, test, train_df, test_df = frames
    model = fe.fit_features(train_df, SPEC)
    for pdf, df in ((train, train_df), (test, test_df)):
        got = model.transform(df, ["id"]).toPandas().sort_values("id").reset_index(drop=True)
        want = expected(train, pdf).reset_index(drop=True)
        assert list(got.columns) == ["id", *want.columns] == ["id", *model.feature_names]
        pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False, rtol=1e-9)


def test_fit_does_not_see_other_rows(frames):
    _, _, train_df, test_df = frames
    alone = fe.fit_features(train_df, SPEC)
    odd = test_df.withColumn("wide", F.col("wide") * 1000).withColumn("home", F.lit("CASTLE"))
    together = fe.fit_features(train_df.unionByName(odd).filter("id < 300"), SPEC)
    assert alone == together


def test_unseen_levels(frames, rows):
    _, _, train_df, _ = frames
    model = fe.fit_features(train_df, SPEC)
    schema = "id bigint, wide double, plain double, count double, constant double, grade string, home string, y bigint"
    got = model.transform(rows([(1, None, None, None, None, "Z", "CASTLE", 0)], schema)).first()
    assert [got[c] for c in model.feature_names if c.startswith("home_")] == [0.0] * 2
    mean, deviation = model.scale["grade"]
    assert got["grade"] == pytest.approx((-1 - mean) / deviation)
    assert got["count"] == 0.0 and got["constant"] == 0.0


def test_saved_model_is_the_same(frames, spark, tmp_path):
    _, _, train_df, _ = frames
    model = fe.fit_features(train_df, SPEC)
    model.save(spark, str(tmp_path / "model"))
    assert fe.FeatureModel.load(spark, str(tmp_path / "model")) == model


def test_all_null_columns_are_left_out(rows):
    df = rows([(None, None, 1.0), (None, None, 3.0)], "gone double, void string, x double")
    model = fe.fit_features(df, fe.FeatureSpec(one_hot=["void"]))
    assert model.feature_names == ["x"]


@pytest.mark.parametrize("listed", [True, False])
def test_rare_merge_leaves_unseen_levels(rows, monkeypatch, listed):
    if not listed:
        monkeypatch.setattr(fe, "MAX_LEVELS", 0)
    train = rows([("a",)] * 60 + [("b",)] * 3 + [("c",)] * 50, "k string")
    rare = fe.rare_levels(train, ["k", "absent"], 50)
    got = fe.merge_rare(rows([("a",), ("b",), ("c",), ("new",), (None,)], "k string"), rare, ["k"], "other")
    assert sorted((r["k"] or "-") for r in got.collect()) == ["-", "a", "c", "new", "other"]


def test_many_levels_become_a_sparse_vector(spark, tmp_path, monkeypatch):
    """The same 0/1 values as with a column per level."""
    train = spark.createDataFrame([(f"k{i % 40:02d}" if i % 9 else None, float(i), "ab"[i % 2]) for i in range(400)], "k string, x double, s string")
    new = spark.createDataFrame([("k05", 1.0, "a"), ("k00", 2.0, "b"), ("unseen", 3.0, "a"), (None, 4.0, "b")], train.schema)
    spec = fe.FeatureSpec(one_hot=["k", "s"], rare=["k"], rare_threshold=9)
    short = fe.fit_features(train, spec)
    monkeypatch.setattr(fe, "MAX_LEVELS", 10)
    long = fe.fit_features(train, spec)
    long.save(spark, str(tmp_path / "model"))
    long = fe.FeatureModel.load(spark, str(tmp_path / "model"))
    assert long.feature_names == ["x", "s_b", fe.WIDE]
    own = [n for n in short.feature_names if n.startswith("k_")]
    want = {r["x"]: [r[n] for n in own] for r in short.transform(new).collect()}
    assert {r["x"]: r[fe.WIDE].toArray().tolist() for r in long.transform(new).collect()} == want and len(own) > 10
    assembled = md.assembler(long.feature_names).transform(long.transform(new))
    assert assembled.first()[md.FEATURES].size == 2 + len(own)


def test_levels_of_a_million_values(spark):
    train = spark.range(1_000_000).select(F.format_string("v%07d", "id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("h"))
    found = levels.fit_levels(train, ["k", "h"])
    assert found.sizes == {"k": 1_000_000, "h": 2} and found.modes == {"k": "v0000000", "h": "cold"}
    some = train.where("k in ('v0000007', 'v0999999')")
    got = {r["k"]: r["categories"] for r in found.encoded(some, max_rows=1).collect()}
    assert got["v0000007"].indices.tolist()[0] == 7 and got["v0999999"].indices.tolist()[0] == 999_999
    assert {v.size for v in got.values()} == {1_000_002}


def test_rare_levels_merge_in_the_dictionary(rows):
    train = rows([("a",)] * 60 + [("b",)] * 3 + [("c",)] * 50 + [("z",)], "k string")
    found = levels.fit_levels(train, ["k"], rare=["k"])
    got = found.merged(rows([("a",), ("b",), ("c",), ("z",), ("new",), (None,)], "k string"))
    assert sorted((r["k"] or "-") for r in got.collect()) == ["-", "a", "c", "new", "other", "other"]


def test_sparse_one_hot_ignores_unseen_levels(rows):
    train = rows([("a", "x"), ("b", "y"), ("a", "y")], "k string, l string")
    fitted = fe.sparse_one_hot(["k", "l"]).fit(train)
    got = [r["categories"].toArray().tolist() for r in fitted.transform(rows([("b", "x"), ("new", "y")], "k string, l string")).collect()]
    assert got == [[0, 1, 1, 0], [0, 0, 0, 1]]


def test_date_parts(rows):
    df = rows([("2014-03-01", "2013-12-31"), ("2014-03-01", "2015-01-01"), (None, "2013-01-01")], "i string, c string")
    typed = df.select(*[F.col(c).cast("date").alias(c) for c in ("i", "c")])
    got = [tuple(r) for r in fe.add_date_parts(typed, "i", "c").collect()]
    assert got == [(2014.0, 3.0, 3.0), (2014.0, 3.0, 0.0), (None, None, None)]


def test_ratios_never_divide_by_zero(rows):
    df = rows([(1000.0, -1.0, 0.0, 10, 1.0, -1.0)], "loan_amnt double, annual_inc double, int_rate double, term int, delinq_2yrs double, total_acc double")
    got = fe.add_loan_ratios(df).first()
    assert got["loan_to_income"] is None and got["delinq_rate"] is None
    assert got["monthly_payment_to_income"] == pytest.approx(100 / (-1 / 12 + 1))
