"""The registered queries of the subpackage: next to their SQL, or whole results of the right shape."""

import glob
import os

import duckdb
import pytest

from lectern.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    if name not in ORACLES:
        ids = {r.doc_id for r in rows}
        assert ids == {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        return
    db = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(dict(zip(columns, r, strict=True))[c] for c in df.columns) for r in result.fetchall()), key=repr)
    assert sorted(map(tuple, rows), key=repr) == want


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
