"""The loan tables end to end, from files to scores, on generated loans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import config as cfg
from ledgerline.operators import models as md
from ledgerline.plans import layers
from ledgerline.plans.tables import LoanTables, build
from ledgerline.streaming import score_stream
from ledgerline.streaming.scoring import rejected, score_batch

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
HEADER = (
    "Unnamed: 0,id,loan_amnt,term,int_rate,sub_grade,grade,emp_length,home_ownership,annual_inc,verification_status,"
    "issue_d,loan_status,purpose,addr_state,dti,delinq_2yrs,earliest_cr_line,fico_range_low,fico_range_high,"
    "inq_last_6mths,mths_since_recent_inq,open_acc,pub_rec,revol_bal,revol_util,total_acc,initial_list_status,"
    "total_pymnt,desc,tot_coll_amt"
).split(",")


def loan(rng: random.Random, i: int) -> list:
    rate = rng.uniform(5, 28)
    status = "Charged Off" if rng.random() < rate / 60 else "Fully Paid"
    status = "Current" if rng.random() < 0.1 else status
    grade = "ABCDEFG"[min(6, int((rate - 5) / 3.4))]
    return [
        i, 10_000 + i, rng.randrange(1000, 40000, 25), f" {rng.choice([36, 60])} months", f"{rate:.2f}%",
        f"{grade}{rng.randint(1, 5)}", grade, rng.choice(["< 1 year", "5 years", "10+ years", ""]),
        rng.choices(["RENT", "OWN", "MORTGAGE", "ANY"], [60, 20, 19, 1])[0], rng.choice([-1, *range(20000, 150000, 500)]),
        rng.choice(["Verified", "Not Verified"]), f"{rng.choice(MONTHS)}-{rng.choice([2013, 2014, 2015, 2016, 2016, 2017])}",
        status, rng.choices(["credit_card", "car", "wedding"], [70, 29, 1])[0], rng.choice(["CA", "TX", "NY", "WA"]),
        rng.choice([999, -1, *range(0, 40)]), rng.choice([0, 0, 1]), f"{rng.choice(MONTHS)}-{rng.randint(1980, 2010)}",
        rng.randrange(660, 850, 5), 0, rng.randint(0, 4), rng.choice(["", 1, 5, 12]), rng.randint(1, 30), rng.choice([0, 0, 0, 1]),
        rng.randint(0, 50000), f"{rng.uniform(0, 120):.1f}%", rng.randint(5, 60), rng.choice("wf"), 123.4, "", rng.choice([0, 0, 10]),
    ]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(0)
    with open(folder / "loans.csv", "w") as f:
        f.write(",".join(HEADER) + "\n")
        f.writelines(",".join(str(v) for v in loan(rng, i)) + "\n" for i in range(3_000))
    series = folder / "series"
    series.mkdir()
    for k, name in enumerate([*cfg.NATIONAL_SERIES, *cfg.STATE_SERIES.values()]):
        lines = [f"{y}-{m:02d}-01,{0.3 + k + 0.01 * (12 * (y - 2012) + m)}" for y in range(2012, 2018) for m in range(1, 13)]
        (series / f"{name}.csv").write_text("DATE,VALUE\n" + "\n".join(lines) + "\n")
    return folder


@pytest.fixture(scope="module")
def tables(spark, files):
    return build(spark, str(files / "loans.csv"), str(files / "series"), LoanTables("t_", folder=str(files / "tables")))


def test_bronze_keeps_the_period_and_types(tables):
    bronze = tables["bronze_loans"]
    assert bronze.agg(F.min(F.year("issue_d")), F.max(F.year("issue_d"))).first() == (2014, 2017)
    assert isinstance(bronze.schema["loan_amnt"].dataType, T.DoubleType) and "unnamed_0" in bronze.columns


def test_silver_is_clean(tables):
    silver = tables["silver_loans"]
    kinds = {f.name: f.dataType.simpleString() for f in silver.schema.fields}
    assert kinds["term"] == "int" and kinds["int_rate"] == "double" and kinds["emp_length"] == "int"
    assert kinds["issue_d"] == kinds["earliest_cr_line"] == "date" and kinds[cfg.TARGET] == "int"
    gone = set(cfg.LEAKAGE_COLUMNS) | set(cfg.UNINFORMATIVE_COLUMNS) | {"loan_status", "desc"}
    assert not gone & set(silver.columns)
    assert silver.filter("dti < 0 or annual_inc < 0 or revol_util > 200").count() == 0
    assert silver.filter("emp_length = -1").count() > 0


def test_gold_parts_are_complete_and_ordered(tables):
    parts = {n: tables[f"gold_loans_{n}"] for n in ("train", "val", "test")}
    assert sum(p.count() for p in parts.values()) == tables["silver_loans"].count()
    assert parts["train"].agg(F.max("issue_d")).first()[0] < parts["val"].agg(F.min("issue_d")).first()[0]
    assert parts["test"].select(F.year("issue_d")).distinct().collect() == [(2017,)]


def test_combined_loans(tables):
    combined = tables["gold_loans_macro"]
    assert combined.count() == tables["silver_loans"].count()
    assert not set(cfg.STATE_SERIES.values()) & set(combined.columns)
    assert set(cfg.MACRO_FEATURES) <= set(combined.columns)
    other = combined.filter("addr_state = 'WA' and state_unrate <> UNRATE").count()
    assert other == 0 and combined.filter("addr_state = 'CA' and state_unrate = UNRATE").count() == 0
    assert tables["insight2_subgrade_regime"].agg(F.sum("n")).first()[0] == combined.count()


def test_silver_is_stored_by_month(spark, tables):
    plan = tables["silver_loans"].filter("issue_month = date'2016-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(issue_month" in plan


@pytest.fixture(scope="module")
def fitted(spark, tables):
    unemployment = tables["bronze_macro"].filter("series_id = 'UNRATE'")
    features = layers.fit_loan_features(tables["gold_loans_train"], unemployment)
    frame = lambda part: layers.feature_frame(features, tables[f"gold_loans_{part}"], unemployment)
    return features, frame("train").cache(), frame("val").cache(), frame("test")


def test_features_and_selection(spark, fitted, monkeypatch):
    features, train, val, test = fitted
    assert {"unemployment_rate", "mths_since_recent_inq_missing", "loan_to_income", "purpose_other"} <= set(features.feature_names)
    assert train.columns == [cfg.TARGET, *features.feature_names]
    assert train.dropna().count() == train.count()
    monkeypatch.setitem(md.BOOSTED_SPACE, "trees", md.whole(2, 3))
    monkeypatch.setitem(md.HISTOGRAM_BOOSTED_SPACE, "trees", md.whole(2, 3))
    monkeypatch.setitem(md.TREE_SPACE, "max_depth", md.whole(2, 4))
    monkeypatch.setitem(md.BOOSTED_SPACE, "max_depth", md.whole(2, 3))
    monkeypatch.setitem(md.HISTOGRAM_BOOSTED_SPACE, "max_depth", md.whole(2, 3))
    models = layers.select_model(train, val, features.feature_names, trials=1)
    assert [m.kind for m in models] == ["baseline", "tuned", "tuned", "tuned"]
    assert models[0].metrics["auc_roc"] > 0.55
    assert md.validation_metrics(md.best_tuned(models).model, test, cfg.TARGET)["auc_roc"] > 0.5


def test_batch_and_stream_scores_agree(spark, fitted, tables, tmp_path):
    unemployment = tables["bronze_macro"].filter("series_id = 'UNRATE'")
    features, train, _, _ = fitted
    model = md.fit_logistic(train, features.feature_names, cfg.TARGET, max_iter=20)
    columns = list(cfg.SCENARIOS["Safe (A2, FICO 760)"])
    profiles = [(name, *[s[c] for c in columns]) for name, s in cfg.SCENARIOS.items()]
    broken = ("Broken", *[{**cfg.SCENARIOS["Safe (A2, FICO 760)"], "term": 12}[c] for c in columns])
    applicants = spark.createDataFrame([*profiles, broken], ["name", *columns])
    batch = {r["name"]: r for r in score_batch(applicants, "name", features, model, "2017-06", "Logit", unemployment).collect()}
    assert set(batch) == set(cfg.SCENARIOS)
    assert batch["Safe (A2, FICO 760)"]["default_probability"] < batch["Risky (E4, FICO 620)"]["default_probability"]
    assert [r["error"] for r in rejected(applicants, "name").collect()] == ["term must be 36 or 60 months."]

    applicants.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(applicants.schema).json(str(tmp_path / "in"))
    args = (stream, "name", features, model, "2017-06", "Logit", str(tmp_path / "out"), str(tmp_path / "state"), unemployment)
    for _ in range(2):  # a restart scores nothing twice
        score_stream(*args).awaitTermination(120)
    streamed = {r["name"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == batch and spark.read.parquet(str(tmp_path / "out")).count() == 3
