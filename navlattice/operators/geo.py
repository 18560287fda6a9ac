"""Points in polygons with holes, and the places that cells lie in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import EDGE_MARGIN_DEG



def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule; half-open in y, strict in x. A ring is an array of (x, y)."""

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, F.size(ring)))
        at = F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"]
        return ((a["y"] > y) != (b["y"] > y)) & F.coalesce(x < at, F.lit(False))

    n = F.size(ring)
    return F.when(n < 3, False).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(False), lambda acc, i: acc != crosses(i)))


def in_polygons(x: Column, y: Column, polygons: Column) -> Column:
    """In the first ring of some polygon and in none of its holes."""
    return F.exists(polygons, lambda p: in_ring(x, y, F.get(p, F.lit(0))) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda hole: in_ring(x, y, hole)))


def ring_area(ring: Column) -> Column:
    """Twice the signed area of a closed ring, halved: positive where it runs counter-clockwise."""
    pairs = F.sequence(F.lit(0), F.greatest(F.size(ring) - 2, F.lit(0)))
    cross = lambda i: F.get(ring, i)["x"] * F.get(ring, i + 1)["y"] - F.get(ring, i + 1)["x"] * F.get(ring, i)["y"]
    return F.when(F.size(ring) < 2, 0.0).otherwise(F.aggregate(pairs, F.lit(0.0), lambda acc, i: acc + cross(i)) / 2)


def outer_area(polygons: Column) -> Column:
    """The sum of the areas of the outer rings."""
    return F.aggregate(polygons, F.lit(0.0), lambda acc, p: acc + F.abs(ring_area(F.get(p, F.lit(0)))))


def places_of(points: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """(key, ord) of the place each point lies in: a country before a sea, the first country, the smallest sea.

    places: ord, kind, area, minx, miny, maxx, maxy, polygons.  Points meet the
    boxes on one-degree tiles, which carry numbers and bounds only; polygons
    come in afterwards, once for each pair that a box leaves.
    """
    tile = lambda c: F.floor(c).cast("int")
    tiles = places.select("ord", "minx", "maxx", "miny", "maxy", F.explode(F.sequence(tile(F.col("minx")), tile(F.col("maxx")))).alias("tx"))
    tiles = tiles.select("*", F.explode(F.sequence(tile(F.col("miny")), tile(F.col("maxy")))).alias("ty"))
    p = points.select(key, "lon", "lat", tile(F.col("lon")).alias("tx"), tile(F.col("lat")).alias("ty"))
    near = p.join(tiles, ["tx", "ty"]).where(F.col("lon").between(F.col("minx"), F.col("maxx")) & F.col("lat").between(F.col("miny"), F.col("maxy"))).select(key, "lon", "lat", "ord")
    found = near.join(places.select("ord", "kind", "area", "polygons"), "ord").where(in_polygons(F.col("lon"), F.col("lat"), F.col("polygons")))
    sea = F.coalesce(F.col("kind") == "sea", F.lit(False))
    return found.groupBy(key).agg(F.min_by("ord", F.struct(sea, F.when(sea, F.col("area")).otherwise(0.0), F.col("ord"))).alias("ord"))


def inside(boundary: Column, south: float, west: float, north: float, east: float) -> Column:
    """All corners of a cell lie in the box, shrunk by the margin."""
    m = EDGE_MARGIN_DEG
    return F.forall(boundary, lambda v: v["lat"].between(south + m, north - m) & v["lon"].between(west + m, east - m))
