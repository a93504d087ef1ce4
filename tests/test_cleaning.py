from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean, filters
from ledgerline.sources import (
    EmptyResultError,
    MissingColumnError,
    filtered_loans,
    macro_series,
    read_csv,
    schema_report,
    table_report,
    write_csv,
    write_table,
)


def test_names_do_not_collide():
    assert clean.sanitized_names(["Unnamed: 0", "unnamed_0", "%%", "a.b", "A B"]) == ["unnamed_0", "unnamed_0_2", "col", "a_b", "a_b_2"]


def test_sparse_threshold_is_strict(rows):
    data = [(1, None if i < 3 else 1.0, None if i < 4 else "x", float("nan") if i < 5 else 1.0) for i in range(10)]
    df = rows(data, "a int, at_limit double, above string, nan_above double")
    assert clean.drop_sparse_columns(df, 0.30).columns == ["a", "at_limit"]


def test_sparse_columns_of_an_empty_table(rows):
    assert clean.drop_sparse_columns(rows([], "a int, b string")).columns == ["a", "b"]


def test_impossible_values(rows):
    df = rows([(-1.0, 201.0), (0.0, 200.0), (None, None)], "dti double, revol_util double")
    rules = {"dti": "dti < 0", "revol_util": "revol_util > 200", "absent": "absent < 0"}
    assert [tuple(r) for r in clean.null_impossible(df, rules).collect()] == [(None, None), (0.0, 200.0), (None, None)]
    assert {r["column"]: r["fixes"] for r in clean.count_impossible(df, rules).collect()} == {"dti": 1, "revol_util": 1}


def test_steps_skip_absent_and_typed_columns(rows):
    df = rows([(36, 12.5)], "term int, int_rate double")
    assert clean.parse_numeric_text(df, ["term", "x"], ["int_rate"]).first() == (36, 12.5)
    assert clean.map_ordinal_text(df, "emp_length", {}).columns == df.columns
    assert clean.parse_dates(df, ["a"], ["b"]).columns == df.columns


def test_normalize_missing(rows):
    assert clean.normalize_missing(rows([(float("nan"), 1)], "x double, i int")).first() == (None, 1)


def test_column_names_with_dots(rows):
    df = rows([(" 1 ", "x")], "`a.b` string, c string")
    assert clean.cast_doubles(df, ["a.b"]).first()[0] == 1.0
    assert [r["column"] for r in clean.column_overview(df).collect()] == ["a.b", "c"]


def test_years_become_date_ranges(spark):
    df = spark.sql("select cast('2014-12-31' as date) d union all select date'2015-01-01' union all select date'2017-06-01' union all select null")
    assert sorted(r[0] for r in filters.in_years(df, "d", [2014, 2017]).collect()) == [dt.date(2014, 12, 31), dt.date(2017, 6, 1)]
    assert filters.in_years(df, "d", [2014, 2015]).count() == 2
    assert filters.in_years(df, "d", []).count() == 0


@pytest.fixture
def loans_csv(tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text("id,issue_d,amount\n1,Jan-2014,5\n2,Dec-2017,NaN\n3,Jan-2018,7\n4,junk,8\n5,,None\n6,Mar-2015, \n")
    return str(path)


def test_csv_scan_keeps_the_period(spark, loans_csv):
    got = filtered_loans(spark, loans_csv, "2014-01-01", "2017-12-31")
    assert {r["id"]: r["amount"] for r in got.collect()} == {"1": "5", "2": None, "6": " "}


def test_csv_scan_fails_loudly(spark, loans_csv):
    with pytest.raises(MissingColumnError):
        filtered_loans(spark, loans_csv, "2014-01-01", "2017-12-31", date_column="issued")
    with pytest.raises(EmptyResultError):
        filtered_loans(spark, loans_csv, "1990-01-01", "1990-12-31", require_rows=True)
    with pytest.raises(Exception, match="(?i)not.exist|PATH_NOT_FOUND"):
        read_csv(spark, loans_csv + ".absent")


def test_csv_types_only_when_asked(spark, loans_csv):
    assert set(dict(read_csv(spark, loans_csv).dtypes).values()) == {"string"}
    assert dict(read_csv(spark, loans_csv, infer=True).dtypes)["id"] == "int"


def test_csv_sink_writes_null_as_empty(spark, rows, tmp_path):
    write_csv(rows([(1, None), (2, "x")], "a int, b string"), str(tmp_path / "out"))
    assert sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "out")).collect()) == [("1", None), ("2", "x")]


def test_series_files_and_folders(spark, tmp_path):
    (tmp_path / "UNRATE.csv").write_text("DATE,UNRATE\n2014-01-01,6.6\n2014-02-01,.\n")
    part = tmp_path / "CPIAUCSL.csv"
    part.mkdir()
    (part / "part-0.csv").write_text("observation_date,value\n2014-01-01,235\n")
    got = {(r["series_id"], str(r["observation_date"])): r["value"] for r in macro_series(spark, str(tmp_path)).collect()}
    assert got == {("UNRATE", "2014-01-01"): 6.6, ("UNRATE", "2014-02-01"): None, ("CPIAUCSL", "2014-01-01"): 235.0}


def test_second_table_write_replaces_the_first(spark, rows, tmp_path):
    write_table(rows([(1, "a", 0)], "x int, y string, z int"), "written_twice", path=str(tmp_path / "t"))
    write_table(rows([(2, 3.0, 0), (4, 5.0, 0)], "x int, w double, z int"), "written_twice", drop=["z"], path=str(tmp_path / "t"))
    assert spark.table("written_twice").columns == ["x", "w"]
    report = table_report(spark, "written_twice").first()
    assert report["n_rows"] == 2 and report["provider"] == "parquet"
    assert "x: integer" in schema_report(spark.table("written_twice"))


def test_relabel_leaves_unknown_codes(rows):
    got = clean.relabel(rows([(0,), (7,)], "k int"), "k", {0: "zero"}, "t").collect()
    assert [r["t"] for r in got] == ["zero", "7"]


def test_filter_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    for df in (filters.in_years(orders, "o_orderdate", [1996, 1997]), filters.in_date_range(orders, "o_orderdate", "1996-01-01", "1996-02-01")):
        plan = df.select(F.count("*"))._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters:")[1].split("]")[0]
        assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan" in pushed
