"""The hexagonal grid H3: identifiers by bit arithmetic, geometry by the `h3` package where it is installed.

An identifier has its resolution in bits 52 to 55 and a digit of three bits
for each of 15 resolutions below its base cell; unused digits are 7.
"""

from __future__ import annotations

from importlib.util import find_spec

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FINEST = 5


def available() -> bool:
    """Whether points can be turned into cells here."""
    return find_spec("h3") is not None


def parent(cell: Column, res: int) -> Column:
    """The cell of a coarser resolution around a cell: its digits below are unused."""
    bare = cell.bitwiseAND(F.lit(~(15 << 52)))
    return bare.bitwiseOR(F.lit(res << 52 | (1 << 3 * (15 - res)) - 1))


def _udf(kind: str, each):
    """A function of whole columns; equal inputs of a batch are computed once."""

    def run(*columns: pd.Series) -> pd.Series:
        from h3.api import basic_int as h3

        known = {}
        return pd.Series([known[k] if k in known else known.setdefault(k, None if any(pd.isna(x) for x in k) else each(h3, *k)) for k in zip(*columns, strict=True)], dtype=object)

    return F.pandas_udf(run, kind)


def cell(lat: Column, lon: Column) -> Column:
    return _udf("long", lambda h3, a, b: h3.latlng_to_cell(a, b, FINEST))(lat, lon)


def disk(cell: Column) -> Column:
    """The cell and its neighbours, six or, round a pentagon, five."""
    return _udf("array<long>", lambda h3, c: sorted(h3.grid_disk(int(c), 1)))(cell)


def center(cell: Column) -> Column:
    pair = _udf("array<double>", lambda h3, c: list(h3.cell_to_latlng(int(c))))(cell)
    return F.struct(pair[0].alias("lat"), pair[1].alias("lon"))


def boundary(cell: Column) -> Column:
    pairs = _udf("array<array<double>>", lambda h3, c: [list(p) for p in h3.cell_to_boundary(int(c))])(cell)
    return F.transform(pairs, lambda p: F.struct(p[0].alias("lat"), p[1].alias("lon")))
