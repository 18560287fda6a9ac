"""A nested latitude-longitude grid in pure Column arithmetic.

Resolution 5 has cells of 0.125 degrees, and each coarser one is three times
as wide.  An id is 7<<59 | resolution<<52 | row<<20 | column, so the
resolution lies where hexagonal ids have it; ids are not such ids.  `use`
turns to the hexagonal grid instead, where its package is installed; all
operators go through the functions here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import hexgrid

BASE = 7 << 59
ROWS, COLS = {5: 1440, 4: 480, 3: 160}, {5: 2880, 4: 960, 3: 320}
DEGREES = {5: 0.125, 4: 0.375, 3: 1.125}
MASK = (1 << 20) - 1
_kind = "square"


def use(kind: str) -> None:
    """Sets the grid of all plans made from now on: square or hexagonal."""
    global _kind
    if kind not in ("square", "hexagonal"):
        raise ValueError(kind)
    if kind == "hexagonal" and not hexgrid.available():
        raise ModuleNotFoundError("the hexagonal grid needs the package h3")
    _kind = kind


def make(row: Column, col: Column, res: int) -> Column:
    return F.lit(BASE - (1 << 64) if BASE >= 1 << 63 else BASE).bitwiseOR(F.lit(res << 52)).bitwiseOR(F.shiftleft(row.cast("long"), 20)).bitwiseOR(col.cast("long"))


def row_of(cell: Column) -> Column:
    return F.shiftright(cell, 20).bitwiseAND(F.lit(MASK))


def col_of(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(MASK))


def cell(lat: Column, lon: Column) -> Column:
    """The finest cell of a point."""
    if _kind == "hexagonal":
        return hexgrid.cell(lat, lon)
    row = F.least(F.floor((lat + 90.0) / 0.125), F.lit(ROWS[5] - 1))
    return make(row, F.pmod(F.floor((lon + 180.0) / 0.125), F.lit(COLS[5])), 5)


def parent(cell: Column, res: int) -> Column:
    """The cell of resolution res around a finest cell."""
    if _kind == "hexagonal":
        return cell if res == hexgrid.FINEST else hexgrid.parent(cell, res)
    step = 3 ** (5 - res)
    return cell if res == 5 else make(F.floor(row_of(cell) / step), F.floor(col_of(cell) / step), res)


def resolution(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(F.lit(15)).cast("int")


def text(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def number(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def center(cell: Column, res: int) -> Column:
    if _kind == "hexagonal":
        return hexgrid.center(cell)
    d = DEGREES[res]
    return F.struct(((row_of(cell) + 0.5) * d - 90.0).alias("lat"), ((col_of(cell) + 0.5) * d - 180.0).alias("lon"))


def boundary(cell: Column, res: int) -> Column:
    if _kind == "hexagonal":
        return hexgrid.boundary(cell)
    d = DEGREES[res]
    s, w = row_of(cell) * d - 90.0, col_of(cell) * d - 180.0
    return F.array(*(F.struct(a.alias("lat"), b.alias("lon")) for a, b in ((s, w), (s, w + d), (s + d, w + d), (s + d, w))))


def disk(cell: Column, res: int = 5) -> Column:
    """The cell and those that touch it: columns wrap, rows end at the poles."""
    if _kind == "hexagonal":
        return hexgrid.disk(cell)
    near = [F.when((row_of(cell) + i).between(0, ROWS[res] - 1), make(row_of(cell) + i, F.pmod(col_of(cell) + j, F.lit(COLS[res])), res)) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return F.array_compact(F.array(*near))


def node(hour: Column, cell: Column) -> Column:
    """A number of its own for every hour and finest cell."""
    if _kind == "hexagonal":
        return F.xxhash64(F.unix_seconds(hour), cell)
    return F.shiftleft(F.floor(F.unix_seconds(hour) / 3600), 23).bitwiseOR(F.shiftleft(row_of(cell), 12)).bitwiseOR(col_of(cell))
