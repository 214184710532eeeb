"""Every registered query against its SQL, on the smallest given tables."""

import os
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
from eventlens.plans.queries import ORACLES, QUERIES

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(n) for n in columns]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == expected
    assert expected
