"""The queries of the training-data operators that SQL can state, against DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from navlattice.llm import queries

SQL = queries.oracle_sql()


def same(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) if isinstance(a, float) and isinstance(b, float) else a == b


def ordered(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in values), key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}{'/*.parquet' if os.path.isdir(f) else ''}')")
    got = con.execute(SQL[name])
    columns = [d[0] for d in got.description]
    want = ordered(columns, got.fetchall())
    df = queries.queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    have = ordered(df.columns, [tuple(r) for r in df.collect()])
    assert len(have) == len(want) and all(same(x, y) for a, b in zip(have, want) for x, y in zip(a, b))
