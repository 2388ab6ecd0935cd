"""The driver's entry points, and all queries against their oracles on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from sparquern import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def shown(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda x: repr(round(x, 9)) if isinstance(x, float) else str(x)
    return sorted(tuple(one(r[i]) for i in order) for r in rows)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"lang", "n_chunks", "n_tokens"}


def test_oracles_belong_to_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLES:
        assert rows
        return
    found = duck.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert {c: KINDS[k] for c, k in df.dtypes} == dict(zip(found.columns, map(str, found.types), strict=True))
    assert shown(rows, df.columns) == shown(found.fetchall(), found.columns)
