"""Every registered query against its SQL, on whole tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from streamlog.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value.item() if hasattr(value, "item") else value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    result = QUERIES[name](spark, SF_DIR)
    wanted = db.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(wanted.columns)
    got = [tuple(r) for r in result.collect()]
    assert rows(result.columns, got) == rows(wanted.columns, wanted.fetchall())
