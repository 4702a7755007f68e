"""Every query with SQL against DuckDB on the smallest tables, the others for their rows."""

import glob
import os

import duckdb
import pytest

from concordance.plans import fusion, problems, records

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def comparable(rows):
    return sorted(tuple("" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


QUERIES, SQL = fusion.QUERIES | problems.QUERIES | records.QUERIES, fusion.SQL | problems.SQL | records.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = got.collect()
    if name not in SQL:
        assert got.columns
        return
    want = duck.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    order = [columns.index(c) for c in got.columns]
    assert comparable(rows) == comparable([[r[k] for k in order] for r in want.fetchall()])


def test_names_do_not_clash():
    assert len(QUERIES) == len(fusion.QUERIES) + len(problems.QUERIES) + len(records.QUERIES)
    assert set(SQL) <= set(QUERIES)
