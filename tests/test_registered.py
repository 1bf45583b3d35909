"""Every registered query next to its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, rows = table(df.columns, df.collect())
    if name not in ORACLES:
        assert rows
        return
    result = db.execute(ORACLES[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert columns == expected[0]
    assert repr(rows) == repr(expected[1])


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
