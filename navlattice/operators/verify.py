"""Checks of stored results against recomputed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from . import avionics, geo, rollup
from .graph import settled
from .regions import Box

KEYS = ["hour", "h3", "icao24"]


def compare(stored: DataFrame, again: DataFrame, columns: list[str]) -> DataFrame:
    """One row: keys on one side only, keys whose values differ, keys that agree."""
    left = stored.select(*KEYS, F.struct(*columns).alias("a"))
    right = again.select(*KEYS, F.struct(*columns).alias("b"))
    both = left.join(right, KEYS, "full_outer")
    a, b = F.col("a").isNull(), F.col("b").isNull()
    same = F.col("a").eqNullSafe(F.col("b"))
    return both.agg(F.count_if(b).alias("only_stored"), F.count_if(a).alias("only_recomputed"), F.count_if(~a & ~b & ~same).alias("different"), F.count_if(~a & ~b & same).alias("equal"))


def transitions(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many cells went from one level to another; a cell that is gone has none."""
    b = before.select("h3", F.col("level").alias("before"))
    a = after.select("h3", F.col("level").alias("after"))
    return b.join(a, "h3", "left").groupBy("before", F.coalesce("after", F.lit("noData")).alias("after")).count()


def keep_cells(hourly: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of the rollup whose cell is listed."""
    return hourly.join(cells.select("h3").distinct(), "h3", "left_semi")


def inner_cells(hourly: DataFrame, box: Box) -> DataFrame:
    """The rollup's cells that lie wholly in the box, shrunk by the margin."""
    return hourly.select("h3").distinct().where(geo.inside(grid.boundary(F.col("h3"), 5), *box))


def verify_day(stored: DataFrame, positions: DataFrame, box: Box) -> DataFrame:
    """One row: the cells and rows compared inside the box, the differences from the rollup of the positions, and whether the faulty aircraft are the same."""
    cells, again = settled(inner_cells(stored, box)), settled(rollup.rollup(positions))
    found = compare(keep_cells(stored, cells), keep_cells(again, cells), [c for c in stored.columns if c not in KEYS])
    one = F.lit(1).alias("_one")
    n = cells.agg(F.count("*").alias("cells_compared")).select("*", one)
    mine, fresh = (avionics.verdicts(h).where("faulty").select("icao24", F.lit(side).alias("side")) for h, side in ((stored, 1), (again, 2)))
    sides = mine.unionByName(fresh).groupBy("icao24").agg(F.sum("side").alias("sides"))
    same = sides.agg((F.count_if(F.col("sides") != 3) == 0).alias("avionics_same")).select("*", one)
    return found.select("*", one).join(n, "_one").join(same, "_one").select("cells_compared", "only_stored", "only_recomputed", "different", "equal", "avionics_same")
