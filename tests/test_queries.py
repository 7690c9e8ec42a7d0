"""Every registered batch query against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from modelstream.plans.catalog import QUERIES
from modelstream.plans.oracle import ORACLE

TABLES = "/root/testdata/sf0.001"
STREAMS = [name for name in QUERIES if name.startswith("stream_") or name == "state_reader"]
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS)) + ["stream_arrivals", "state_reader"])
def test_query(spark, db, name):
    frame = QUERIES[name](spark, TABLES)
    columns = sorted(frame.columns)
    cursor = db.execute(ORACLE[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    expected = [dict(zip(found, row)) for row in cursor.fetchall()]
    mine = sorted(tuple(normal(r[c]) for c in columns) for r in frame.collect())
    assert mine == sorted(tuple(normal(r[c]) for c in columns) for r in expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
