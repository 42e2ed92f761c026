import glob
import os

import pytest

from tessella.plans import queries

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"


def plain(v):
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_gives_the_oracles_rows(spark, oracle, name):
    got = queries.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = oracle.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
