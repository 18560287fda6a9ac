"""Each query against its SQL on the same tables."""

import glob
import math
import os

import duckdb
import pytest

from navlattice.plans import oracle, queries

SQL = oracle.oracle_sql()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
    return a == b


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in values), key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}{'/*.parquet' if os.path.isdir(f) else ''}')")
    got = con.execute(SQL[name])
    want = rows([d[0] for d in got.description], got.fetchall())
    df = queries.queries()[name](spark, sf)
    have = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(d[0] for d in got.description)
    assert len(have) == len(want)
    assert all(same(x, y) for a, b in zip(have, want) for x, y in zip(a, b)), next((a, b) for a, b in zip(have, want) if not all(map(same, a, b)))
