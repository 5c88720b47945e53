"""Every registered reference query against its SQL in DuckDB."""

import duckdb
import pytest

from riskloom import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def values(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    show = lambda x: repr(round(x, 9)) if isinstance(x, float) else str(x)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    want = duck.sql(Q.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert values(df.columns, [tuple(r) for r in df.collect()]) == values(want.columns, want.fetchall())
