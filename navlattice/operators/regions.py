"""Boxes, time ranges, and the places that cells lie in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from . import geo

Box = tuple[float, float, float, float]
# South, west, north, east.
MAP_REGION: Box = (28.0, 16.0, 48.0, 52.0)
FOCUS_BOX: Box = (28.0, 20.0, 48.0, 52.0)
ARCHIVE_BOX: Box = (25.0, -12.0, 72.0, 65.0)


def parse(text: str) -> Box:
    """south,west,north,east as written on a command line."""
    south, west, north, east = map(float, text.split(","))
    return south, west, north, east


def contains(box: Box, lat: Column, lon: Column) -> Column:
    """Inside the box or on its edge."""
    return lat.between(box[0], box[2]) & lon.between(box[1], box[3])


def in_time(df: DataFrame, start: str, end: str, column: str = "ts") -> DataFrame:
    """The rows of [start, end); a plain range, so files and row groups outside it are not read."""
    return df.where((F.col(column) >= F.to_timestamp(F.lit(start))) & (F.col(column) < F.to_timestamp(F.lit(end))))


def whole_hours(start: str, end: str) -> tuple[Column, Column]:
    """[start, end) widened to whole hours."""
    last = F.to_timestamp(F.lit(end)) - F.expr("interval 1 microsecond")
    return F.date_trunc("hour", F.to_timestamp(F.lit(start))), F.date_trunc("hour", last) + F.expr("interval 1 hour")


def in_hours(hourly: DataFrame, start: str, end: str) -> DataFrame:
    first, last = whole_hours(start, end)
    return hourly.where((F.col("hour") >= first) & (F.col("hour") < last))


def centred(cells: DataFrame, box: Box | None, res: int, key: str = "h3") -> DataFrame:
    """The cells whose centre lies in the box (None: the world)."""
    if box is None:
        return cells
    at = grid.center(F.col(key), res)
    return cells.where(contains(box, at["lat"], at["lon"]))


def place_of_cells(cells: DataFrame, places: DataFrame, res: int, key: str = "h3") -> DataFrame:
    """(cell, ord) for the distinct cells that lie in a place: by their centre, else by most of their corners (of equals the one met first)."""
    cells = cells.select(F.col(key).alias("cell")).distinct()
    four = lambda p: (F.round(p["lat"], 4).alias("lat"), F.round(p["lon"], 4).alias("lon"))
    middle = geo.places_of(cells.select("cell", *four(grid.center(F.col("cell"), res))), places, "cell")
    rest = cells.join(middle, "cell", "left_anti").select("cell", F.posexplode(grid.boundary(F.col("cell"), res)).alias("at", "p"))
    corners = rest.select(F.struct("cell", "at").alias("corner"), *four(F.col("p")))
    found = geo.places_of(corners, places, "corner").groupBy("corner.cell", "ord").agg(F.count("*").alias("n"), F.min("corner.at").alias("first"))
    return middle.unionByName(found.groupBy("cell").agg(F.max_by("ord", F.struct("n", -F.col("first"))).alias("ord")))


def place_totals(cells: DataFrame, places: DataFrame, res: int, kind: str | None = None) -> DataFrame:
    """Per place (of one kind): the aircraft and affected aircraft of its cells, an aircraft counted once a cell."""
    named = place_of_cells(cells, places, res).join(places.select("ord", "kind", "id", "name"), "ord")
    if kind is not None:
        named = named.where(F.col("kind") == kind)
    found = cells.join(named, cells["h3"] == named["cell"])
    return found.groupBy("id", "name").agg(F.sum("n_total").alias("aircraft"), F.sum("n_bad").alias("affected"))
