"""Every query of the record engine against its SQL in DuckDB."""

import os

import pytest

from recordlake import queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return round(float(v), 9) if isinstance(v, (int, float)) or hasattr(v, "as_tuple") else v


def sorted_rows(rows):
    return sorted(([plain(x) for x in r] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = [[r[c] for c in cols] for r in df.collect()]
    want = con.sql(queries.SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted_rows(got) == sorted_rows([r[i] for i in at] for r in want.fetchall())
