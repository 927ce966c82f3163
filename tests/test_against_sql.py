"""Every registered query against its SQL, over the whole test tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as registered
from conftest import SF_DIR
from registry.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(registered.queries())
    assert set(QUERIES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, db):
    df = registered.queries()[name](spark, SF_DIR)
    result = db.execute(registered.oracle_sql()[name])
    columns = sorted(df.columns)
    positions = {c[0]: i for i, c in enumerate(result.description)}
    assert columns == sorted(positions)
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[k] for c, k in df.dtypes} == kinds
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[positions[c]]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert registered.entry(spark).count() > 0
