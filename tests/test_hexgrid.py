"""The hexagonal grid: identifiers against known ones, and operators over a stand-in for its package."""

import sys

import pytest
from pyspark.sql import functions as F

from navlattice.functions import grid, hexgrid
from navlattice.operators import events, rollup, serve
from navlattice.sources import fixtures

STAND_IN = '''
def latlng_to_cell(lat, lng, res):
    row, col = int((lat + 90) * 4), int((lng + 180) * 4)
    return 1 << 59 | res << 52 | (row % 64) << 45 | (row // 64 * 1440 + col) << 30 | (1 << 30) - 1


def _at(cell):
    rest = cell >> 30 & (1 << 15) - 1
    return ((rest // 1440 * 64 + (cell >> 45 & 63)) / 4 - 90, rest % 1440 / 4 - 180)


def cell_to_latlng(cell):
    lat, lng = _at(cell)
    return lat + 0.125, lng + 0.125


def cell_to_boundary(cell):
    lat, lng = cell_to_latlng(cell)
    return [(lat + a, lng + b) for a, b in ((0.1, 0), (0.05, 0.1), (-0.05, 0.1), (-0.1, 0), (-0.05, -0.1), (0.05, -0.1))]


def grid_disk(cell, k):
    lat, lng = cell_to_latlng(cell)
    return [latlng_to_cell(lat + a, lng + b, cell >> 52 & 15) for a, b in ((0, 0), (0.25, 0), (-0.25, 0), (0, 0.25), (0, -0.25), (0.25, 0.25), (-0.25, -0.25))]
'''


@pytest.fixture
def stand_in(spark, tmp_path, monkeypatch):
    import zipfile

    path = str(tmp_path / "standin.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("h3/__init__.py", "")
        z.writestr("h3/api/__init__.py", "")
        z.writestr("h3/api/basic_int.py", STAND_IN)
    spark.sparkContext.addPyFile(path)
    monkeypatch.syspath_prepend(path)
    grid.use("hexagonal")
    yield
    grid.use("square")
    for name in [n for n in sys.modules if n == "h3" or n.startswith("h3.")]:
        del sys.modules[name]


def test_identifiers(spark):
    """A known cell of resolution 5, its parents, and its text."""
    cell = F.lit(0x85283473FFFFFFF)
    r = spark.range(1).select(*(grid.text(hexgrid.parent(cell, k)).alias(f"p{k}") for k in (3, 4, 5)), grid.resolution(cell).alias("res"), grid.number(grid.text(cell)).alias("same")).first()
    assert (r.p3, r.p4, r.p5, r.res, r.same) == ("832834fffffffff", "8428347ffffffff", "85283473fffffff", 5, 0x85283473FFFFFFF)


def test_needs_its_package():
    if not hexgrid.available():
        with pytest.raises(ModuleNotFoundError):
            grid.use("hexagonal")
    with pytest.raises(ValueError):
        grid.use("round")


def test_operators_on_hexagons(spark, sf, stand_in):
    h = rollup.rollup(fixtures.positions(spark, sf)).cache()
    assert {r.res for r in h.select(grid.resolution(F.col("h3")).alias("res")).distinct().collect()} == {5}
    three = rollup.resolutions(h)
    assert {r.res for r in three.where("resolution = 3").select(grid.resolution(F.col("h3")).alias("res")).distinct().collect()} == {3}
    cells = serve.cells(h, 4)
    assert cells.agg(F.sum("n_total")).first()[0] >= h.select("icao24").distinct().count()
    at = h.select("h3").distinct().select(grid.center(F.col("h3"), 5).alias("c"), F.size(grid.boundary(F.col("h3"), 5)).alias("corners"), F.size(grid.disk(F.col("h3"))).alias("near")).collect()
    assert all(r.corners == 6 and r.near == 7 and -90 <= r.c.lat <= 90 for r in at)
    found = events.jamming_events(h, 1).collect()
    assert found and all(e.region_h3 in e.cells for e in found)
