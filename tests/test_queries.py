"""Every query against its SQL, run by DuckDB on the same files; the rest must give rows."""

from __future__ import annotations

import math

import duckdb
import pytest

from ledgerline.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_NAMES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(rows, columns):
    return sorted([tuple(_plain(r[c]) for c in columns) for r in rows], key=repr)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_equals_sql(spark, sf_dir, duck, name):
    df = REGISTRY[name].run(spark, sf_dir)
    cursor = duck.execute(REGISTRY[name].sql)
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    types = {d[0]: SPARK_NAMES.get(str(d[1]), str(d[1])) for d in cursor.description}
    assert types == {f.name: f.dataType.simpleString() for f in df.schema.fields}
    actual = _sorted([r.asDict() for r in df.collect()], columns)
    assert actual == _sorted(expected, columns)
    assert actual


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_gives_rows(spark, sf_dir, name):
    assert REGISTRY[name].run(spark, sf_dir).count() > 0
