"""Builders of the static dimensions: airports, places and flight information regions."""

from __future__ import annotations

import json
import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.geo import outer_area, ring_area
from . import files

# West, south, east, north of the dimensions, and the tolerance of outlines in degrees.
BOX, TOLERANCE = (15.0, 24.0, 57.0, 52.0), 0.02
AIRPORT_TYPES = {"large_airport": "large", "medium_airport": "medium"}
NOT_REAL_FIRS = ("UUUUFIR", "OOOOFIR", "PPPPFIR")
MERGED = {"N. Cyprus": "Cyprus", "Cyprus": "Cyprus", "Akrotiri": "Cyprus", "Dhekelia": "Cyprus", "Turkey": "Türkiye"}
POINTS = "array<struct<x: double, y: double>>"
POLYGONS = f"array<array<{POINTS}>>"
SHAPES = f"ord int, kind string, id string, name string, polygons {POLYGONS}"
PLACES = f"ord int, kind string, id string, name string, minx double, miny double, maxx double, maxy double, polygons {POLYGONS}"


def airports(table: DataFrame, box: tuple = BOX) -> DataFrame:
    """Scheduled airports of the box from a table of (ident, type, name, latitude_deg, longitude_deg, scheduled_service, icao_code, iata_code, iso_country), large ones first, then by code."""
    t = table.withColumns({"lat": F.expr("try_cast(latitude_deg as double)"), "lon": F.expr("try_cast(longitude_deg as double)")})
    kind = F.create_map(*(F.lit(x) for pair in AIRPORT_TYPES.items() for x in pair))[F.col("type")]
    t = t.where(F.col("type").isin(*AIRPORT_TYPES) & (F.col("scheduled_service") == "yes") & F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3]))
    code = F.coalesce(F.nullif("icao_code", F.lit("")), F.col("ident"))
    out = t.select(code.alias("icao"), F.coalesce("iata_code", F.lit("")).alias("iata"), "name", kind.alias("kind"), F.col("iso_country").alias("country"), F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))
    return out.orderBy(F.col("kind") != "large", "icao", "name")


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").option("escape", '"').csv(path)


def airport_features(airports: DataFrame) -> DataFrame:
    """(path, body) of the airports as one GeoJSON document: a dimension of some hundred rows."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct("icao", "iata", "name", "kind", "country").alias("properties"))
    order = F.array_sort(F.collect_list(F.struct(F.col("kind") != "large", "icao", "name", feature.alias("f"))))
    body = F.struct(F.lit("FeatureCollection").alias("type"), F.transform(order, lambda x: x["f"]).alias("features"))
    return airports.agg(F.to_json(body).alias("body")).select(F.lit("airports.geojson").alias("path"), "body")


def simplified(ring: Column, tolerance: float = TOLERANCE) -> Column:
    """A ring rounded to hundredths, without points that are nearer than the tolerance, in both directions, to the last one kept, and closed."""
    rounded = F.transform(ring, lambda p: F.struct(F.round(p["x"], 2).alias("x"), F.round(p["y"], 2).alias("y")))
    last = lambda acc: F.element_at(F.when(F.size(acc) > 0, acc), -1)
    far = lambda acc, p: F.coalesce(F.greatest(F.abs(p["x"] - last(acc)["x"]), F.abs(p["y"] - last(acc)["y"])) >= tolerance, F.lit(True))
    kept = F.aggregate(rounded, F.array().cast(POINTS), lambda acc, p: F.when(far(acc, p), F.concat(acc, F.array(p))).otherwise(acc))
    return F.when((F.size(kept) > 0) & (last(kept) != F.get(kept, F.lit(0))), F.concat(kept, F.slice(kept, 1, 1))).otherwise(kept)


def _bounds(points: Column) -> dict[str, Column]:
    side = lambda f, c: f(F.transform(points, lambda p: p[c]))
    return {"minx": side(F.array_min, "x"), "miny": side(F.array_min, "y"), "maxx": side(F.array_max, "x"), "maxy": side(F.array_max, "y")}


def bounded(shapes: DataFrame) -> DataFrame:
    """shapes (…, polygons) with the bounds and the area of their outer rings."""
    outer = F.flatten(F.transform("polygons", lambda p: F.get(p, F.lit(0))))
    return shapes.withColumns(_bounds(outer) | {"area": outer_area(F.col("polygons"))})


def places(shapes: DataFrame, merged: dict[str, str] | None = None, box: tuple = BOX) -> DataFrame:
    """Places from shapes (ord, kind, id, name, polygons): the polygons that meet the box, simplified, with outer rings of four points or more; names as merged, each shape a place of its own."""

    def meets(p: Column) -> Column:
        b = _bounds(F.get(p, F.lit(0)))
        return (b["maxx"] >= box[0]) & (b["minx"] <= box[2]) & (b["maxy"] >= box[1]) & (b["miny"] <= box[3])

    name = lambda c: F.coalesce(F.create_map(*(F.lit(x) for pair in merged.items() for x in pair))[F.col(c)], F.col(c)) if merged else F.col(c)
    near = F.transform(F.filter("polygons", meets), lambda p: F.transform(p, lambda r: simplified(r)))
    whole = F.transform(F.filter(near, lambda p: F.size(F.get(p, F.lit(0))) >= 4), lambda p: F.filter(p, lambda r: F.size(r) >= 4))
    kept = shapes.select("ord", "kind", name("id").alias("id"), name("name").alias("name"), whole.alias("polygons"))
    return bounded(kept.where(F.size("polygons") > 0))


def polygons_of(rings: Column) -> Column:
    """Polygons from the loose rings of a shape: a clockwise ring begins one, a counter-clockwise ring is a hole of the one before."""
    hole = lambda r: ring_area(r) > 0
    none = F.array().cast(POLYGONS)
    add = lambda acc, r: F.when(hole(r) & (F.size(acc) > 0), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat(F.element_at(F.when(F.size(acc) > 0, acc), -1), F.array(r))))).otherwise(F.concat(acc, F.array(F.array(r))))
    return F.aggregate(rings, none, add)


def regions(shapes: DataFrame, not_real: tuple[str, ...] = NOT_REAL_FIRS, box: tuple = BOX) -> DataFrame:
    """Flight information regions from (ord, code, name, rings): codes that end in FIR, without placeholders; holes found by direction, names without their kind."""
    s = shapes.where(F.col("code").endswith("FIR") & ~F.col("code").isin(*not_real))
    name = F.trim(F.initcap(F.lower(F.regexp_replace(F.regexp_replace("name", " FIR$", ""), " UIR$", ""))))
    return places(s.select("ord", F.lit("fir").alias("kind"), F.regexp_replace("code", "FIR$", "").alias("id"), name.alias("name"), polygons_of(F.col("rings")).alias("polygons")), box=box)


def document(places: DataFrame, kind: str, source: str) -> str:
    """The JSON file of a dimension (places or firs), in order; read back by read_places."""
    rows = []
    for r in places.orderBy("ord").collect():  # some hundred rows
        names = {"icao": r.id, "name": r.name} if kind == "firs" else {"kind": r.kind, "en": r.id, "tr": r.name}
        rows.append(names | {"bbox": [r.minx, r.miny, r.maxx, r.maxy], "polygons": [[[[p.x, p.y] for p in ring] for ring in poly] for poly in r.polygons]})
    return json.dumps({"source": source, kind: rows}, ensure_ascii=False, separators=(",", ":"))


def geojson_shapes(spark: SparkSession, text: str, kind: str, id_key: str, name_key: str, first: int = 0) -> DataFrame:
    """Shapes from a GeoJSON document of polygons and multipolygons; a dimension, read whole."""
    rows = []
    for i, f in enumerate(json.loads(text)["features"]):
        g = f["geometry"]
        polygons = [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]
        shape = [[[(float(p[0]), float(p[1])) for p in ring] for ring in poly] for poly in polygons]
        id_ = f["properties"].get(id_key)
        rows.append((first + i, kind, id_, f["properties"].get(name_key) or id_, shape))
    return spark.createDataFrame(rows, SHAPES)


def shapefile_rings(shp: bytes) -> list[list[list[tuple[float, float]]]]:
    """The rings of every polygon record of a shapefile; other records have none."""
    out, at = [], 100
    while at + 8 <= len(shp):
        size = struct.unpack_from(">i", shp, at + 4)[0] * 2
        body, at = at + 8, at + 8 + size
        rings = []
        if struct.unpack_from("<i", shp, body)[0] in (5, 15, 25):
            parts, points = struct.unpack_from("<2i", shp, body + 36)
            starts = [*struct.unpack_from(f"<{parts}i", shp, body + 44), points]
            xy = struct.unpack_from(f"<{2 * points}d", shp, body + 44 + 4 * parts)
            rings = [[(xy[2 * k], xy[2 * k + 1]) for k in range(a, z)] for a, z in zip(starts, starts[1:], strict=False)]
        out.append(rings)
    return out


def table_records(dbf: bytes) -> list[dict[str, str]]:
    """The records of a dBase table, as text; deleted ones keep their place."""
    count, head, size = struct.unpack_from("<IHH", dbf, 4)
    fields, at = [], 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode(), dbf[at + 16]))
        at += 32
    out = []
    for k in range(count):
        row, at = {}, head + k * size + 1
        for name, width in fields:
            row[name] = dbf[at : at + width].decode("utf-8", "replace").strip()
            at += width
        out.append(row)
    return out


def fir_shapes(spark: SparkSession, shp: bytes, dbf: bytes) -> DataFrame:
    """(ord, code, name, rings) of a shapefile of airspaces."""
    rows = [(i, r["AV_AIRSPAC"], r["AV_NAME"], rings) for i, (r, rings) in enumerate(zip(table_records(dbf), shapefile_rings(shp), strict=True))]
    return spark.createDataFrame(rows, f"ord int, code string, name string, rings array<{POINTS}>")


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """Places or regions from their JSON file, in file order; a small dimension, read whole."""
    doc = json.loads(files.get(path))
    rows = []
    for i, p in enumerate(doc.get("places") or doc.get("firs")):
        shape = [[[tuple(map(float, xy)) for xy in ring] for ring in poly] for poly in p["polygons"]]
        rows.append((i, p.get("kind", "fir"), p.get("icao") or p["en"], p.get("name") or p.get("tr"), *map(float, p["bbox"]), shape))
    return spark.createDataFrame(rows, PLACES).withColumn("area", outer_area(F.col("polygons")))
