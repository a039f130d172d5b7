"""Every registered query against its SQL on the smallest scale folder."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from larkspar.catalog import JOBS, SQL
from larkspar.tables import NAMES

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {"ml_chi_select", "ml_pca"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(names, rows):
    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value
        return value.isoformat() if hasattr(value, "isoformat") else value

    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql_or_is_listed():
    assert set(JOBS) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(JOBS) <= set(queries())
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["nation", "year", "sum_amount", "avg_amount"]


@pytest.mark.parametrize("key", sorted(JOBS))
def test_query(key, spark, db):
    df = queries()[key](spark, FOLDER)
    rows = df.collect()
    assert rows
    if key in ROWS_ONLY:
        return
    cursor = db.execute(SQL[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert comparable(df.columns, rows) == comparable(names, cursor.fetchall())
