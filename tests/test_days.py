"""Files, manifests, archives, plans, export, serving tables and commands on small folders."""

import datetime as dt
import gzip
import io
import json
import tarfile
import urllib.error

import pytest
from pyspark.sql import functions as F

from navlattice import cli
from navlattice.operators import export, regions, rollup, store
from navlattice.plans import backfill
from navlattice.sources import archive, days, dimensions, files, fixtures, ingest, live

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def day_folder(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("archive"))
    p = fixtures.positions(spark, sf)
    days.write_day(p, rollup.rollup(p), root, cli.SOURCE, DAY, (20.0, -10.0, 60.0, 60.0))
    return root


def test_manifest(spark, day_folder):
    folder = days.day_dir(day_folder, cli.SOURCE, DAY)
    m = days.read_manifest(folder)
    assert m["stats"]["positions"]["rows"] == spark.read.parquet(f"{folder}/positions").count()
    days.check_day(spark, folder)
    days.require_rows(spark, folder)
    assert days.archived(day_folder, cli.SOURCE, dt.date(2023, 12, 1), dt.date(2024, 2, 1)) == {DAY}
    assert days.differences(spark, folder).count() == 0


def test_damaged_day(spark, day_folder, tmp_path):
    folder, to = days.day_dir(day_folder, cli.SOURCE, DAY), str(tmp_path / "copy")
    days.copied(spark, folder, to)
    name = days.read_manifest(to)["files"][0]["name"]
    files.put(f"{to}/{name}", b"x")
    with pytest.raises(ValueError, match="size"):
        days.check_day(spark, to)
    with pytest.raises(FileNotFoundError):
        days.require_rows(spark, str(tmp_path / "none"))
    spark.createDataFrame([], "hour timestamp").write.parquet(str(tmp_path / "empty" / "hourly"))
    with pytest.raises(ValueError):
        days.require_rows(spark, str(tmp_path / "empty"))


def _trace(icao, n, **more):
    return {"icao": icao, "timestamp": 1704067200, "trace": [[60 * i, 41 + i / 100, 29.0, 30000, None, None, 0, None, {"nic": 8, "flight": "AB1"}, "adsb_icao"] for i in range(n)]} | more


def _tar(path, documents):
    with tarfile.open(path, "w") as tar:
        for name, raw in documents.items():
            entry = tarfile.TarInfo(name)
            entry.size = len(raw)
            tar.addfile(entry, io.BytesIO(raw))


def test_archive_in_parts(spark, tmp_path):
    documents = {"./traces/00/trace_a.json": gzip.compress(json.dumps(_trace("~ABC", 3)).encode()), "traces/01/trace_b.json": json.dumps(_trace("def", 2)).encode(), "other.json": b"{}", "traces/02/trace_c.json": b"\x1f\x8bdamaged"}
    _tar(tmp_path / "day.tar", documents)
    raw = (tmp_path / "day.tar").read_bytes()
    parts = [str(tmp_path / f"day.tar.{s}") for s in ("aa", "ab")]
    for part, piece in zip(parts, (raw[:777], raw[777:]), strict=True):
        with open(part, "wb") as f:
            f.write(piece)
    got = archive.documents(spark, [parts, [str(tmp_path / "day.tar")]])
    assert got.count() == 6 and got.where("document is null").count() == 2
    reports = ingest.traces(got)
    assert {(r.icao24, r["count"]) for r in reports.groupBy("icao24").count().collect()} == {("abc", 6), ("def", 4)}
    with pytest.raises(ValueError):
        ingest.gate(got)
    ingest.gate(got.where("document is not null"))
    loose = tmp_path / "loose" / "x"
    loose.mkdir(parents=True)
    (loose / "trace_a.json").write_bytes(documents["./traces/00/trace_a.json"])
    assert ingest.traces(archive.loose_documents(spark, str(tmp_path / "loose"))).count() == 3


def test_releases():
    listing = "http://h/r/v2024.01.02-x.tar\nhttp://h/r/v2024.01.01-x.tar.aa, http://h/r/v2024.01.01-x.tar.ab\n"
    assert archive.listed_release(DAY, listing) == ["http://h/r/v2024.01.01-x.tar.aa", "http://h/r/v2024.01.01-x.tar.ab"]
    tag = "v2024.01.01-planes-readsb-"
    assert archive.pick_tag(DAY, [f"{tag}staging-0", f"{tag}prod-0tmp"]) == f"{tag}staging-0"
    there = {"u.tar.aa", "u.tar.ab", "u.tar.ad"}
    assert archive.release_parts("u", there.__contains__) == ["u.tar.aa", "u.tar.ab"]

    def tags(year):
        if year == 2024:
            raise OSError("no such repository")
        return [f"{tag}prod-0"] if year == 2025 else []

    assert archive.resolve(DAY, "", tags, lambda year, t: f"{year}/{t}", lambda u: u.endswith(".tar")) == [f"2025/{tag}prod-0.tar"]
    with pytest.raises(archive.NotPublished):
        archive.resolve(DAY, "", lambda year: [], lambda year, t: t, lambda u: True)


class _Answer(io.BytesIO):
    def __init__(self, data, **headers):
        super().__init__(data)
        self.headers = headers


def test_download(tmp_path):
    calls = []

    def opened(url):
        calls.append(url)
        return _Answer(b"abc", **{"Content-Length": "4" if len(calls) == 1 else "3"})

    path = str(tmp_path / "d" / "f")
    assert archive.download("u", path, opened, pause_s=0) == path and len(calls) == 2 and open(path, "rb").read() == b"abc"
    archive.download("u", path, opened)
    assert len(calls) == 2
    with pytest.raises(OSError):
        archive.download("u", path + "2", lambda u: _Answer(b"a", **{"Content-Length": "2"}), pause_s=0)


def test_live_poll(spark):
    waited = []

    def limited(url, state=[]):
        state.append(url)
        if len(state) == 1:
            raise urllib.error.HTTPError(url, 429, "slow", {"Retry-After": "7"}, None)
        return _Answer(b'{"ac": []}')

    assert live.fetch("u", limited, sleep=waited.append) == {"ac": []} and waited == [7.0]
    box = (28.0, 20.0, 48.0, 52.0)

    def get(url):
        i = int(url)
        if i == 1:
            raise OSError("away")
        return {"ac": [{"hex": "AB", "lat": 30.0 + i, "lon": 30.0, "alt_baro": 100}, {"hex": f"c{i}", "lat": 60.0, "lon": 30.0}, {"hex": "d", "lat": 31.0, "lon": 31.0, "seen_pos": 99}]}

    centres = live.cover(box)
    got = live.poll(box, lambda lat, lon, r: str(centres.index((lat, lon))), get, now=lambda: 1000.0)
    assert [i for i, _, _ in got] == [i for i in range(len(centres)) if i != 1]
    assert [(r.icao24, r.lat) for r in live.snapshot(live.answers(spark, got), box).collect()] == [("ab", 30.0)]


def test_cover_leaves_no_gap():
    import math

    box = (28.0, 20.0, 48.0, 52.0)
    centres = live.cover(box)
    for lat in range(28, 49):
        for lon in range(20, 53):
            near = min(math.hypot((lat - a) * 60, (lon - b) * 60 * math.cos(math.radians(max(abs(lat), abs(a)) if abs(lat) < abs(a) else min(abs(lat), abs(a))))) for a, b in centres)
            assert near <= 262


def test_json_lines(spark, sf, tmp_path):
    p = fixtures.positions(spark, sf)
    for i in range(2):
        ingest.write_json_lines(p.limit(20 + i), str(tmp_path / "out" / "deep"))
    assert ingest.json_lines(spark, str(tmp_path / "out")).count() == 41


def test_ledger(tmp_path):
    now = dt.datetime(2024, 5, 1)
    ledger = backfill.Ledger.load(str(tmp_path))
    assert [ledger.failed(DAY, "e" * 400, now) for _ in range(3)] == [False, False, True]
    ledger.save(str(tmp_path))
    again = backfill.Ledger.load(str(tmp_path))
    assert len(again.entries[str(DAY)]["error"]) == 300
    assert not again.failed(DAY, "later", now + dt.timedelta(days=3)) and again.entries[str(DAY)]["count"] == 1
    again.succeeded(DAY)
    assert again.entries == {}
    files.put(f"{tmp_path}/{backfill.LEDGER}", b"[]")
    with pytest.raises(ValueError):
        backfill.Ledger.load(str(tmp_path))


def test_matrix_and_fingerprint():
    todo = [DAY + dt.timedelta(days=i) for i in range(13)]
    m = backfill.matrix(todo)
    assert [len(x["days"].split()) for x in m] == [6, 6, 1] and m[0]["label"] == "2024-01-13 … 2024-01-08" and m[2]["label"] == "2024-01-01"
    assert len(backfill.matrix([DAY + dt.timedelta(days=i) for i in range(2000)])) <= 256
    assert backfill.parallel() == 8 and backfill.parallel(99) == 20 and backfill.parallel(0) == 1
    assert len(backfill.fingerprint()) == 12


def test_exported(tmp_path):
    for name in backfill.REQUIRED:
        files.put(f"{tmp_path}/2024-01-01/{name}", b"{}")
    files.put(f"{tmp_path}/2024-01-02/timeline.json", b"{}")
    files.put(f"{tmp_path}/notes/timeline.json", b"{}")
    assert backfill.exported(str(tmp_path)) == {DAY}


def test_export_day(spark, sf, tmp_path):
    h = rollup.rollup(fixtures.positions(spark, sf))
    places, firs = fixtures.shapes(spark, fixtures.PLACES), fixtures.shapes(spark, fixtures.FIRS)
    manifest = export.export_day(h, DAY, str(tmp_path), places, firs)
    got = {name: json.loads(files.get(f"{tmp_path}/{DAY}/{name}")) for name, _ in files.listed(f"{tmp_path}/{DAY}")}
    assert manifest == got.pop("manifest.json") and manifest["files"] == len(got)
    assert {"jamming-r3.json", "jamming-r4.json", "jamming-r5.json", "analytics.json", "route-hours-r4.json", "timeline.json"} <= set(got)
    assert len(got["timeline.json"]["hours"]) == 24
    details = {n: d for n, d in got.items() if n.startswith("cells/")}
    assert details
    cells = {c["h3"]: c for r in (3, 4, 5) for c in got[f"jamming-r{r}.json"]["cells"]}
    for d in details.values():
        c = cells[d["h3"]]
        assert d["level"] in ("medium", "high") and all(d[k] == c[k] for k in ("n_total", "n_bad", "ratio_bad", "level"))
        assert len(d["aircraft"]) == min(100, d["n_total"]) and sum(a["affected"] for a in d["aircraft"]) <= d["n_bad"]
        assert len(d["nic_histogram"]) == 12 and all(a["icao24"] is None for a in d["aircraft"] if a["anonymous"])
        worst = max(d["hours"], key=lambda x: x["n_affected"])
        assert d["peak_hour"] == (worst["hour"] if worst["n_affected"] else None)
    with pytest.raises(ValueError):
        export.refuse_world(None, "/x/public/data")


def test_serving_tables(spark, sf):
    assert store.statements("-- a; b\nSELECT ';' ; SELECT 'it''s -- x'") == ["SELECT ';'", "SELECT 'it''s -- x'"]
    try:
        assert store.migrate(spark, "nav_test") == store.migrate(spark, "nav_test") == 3
        h = rollup.rollup(fixtures.positions(spark, sf))
        for _ in range(2):
            store.replace_days(store.hourly_rows(h), "nav_test.hourly")
        n = {r.resolution: r["count"] for r in spark.table("nav_test.hourly").groupBy("resolution").count().collect()}
        assert n == {res: rollup.coarsen(h, res).count() for res in (3, 4, 5)}
        assert store.query(spark, "SELECT count(*) FROM nav_test.hourly WHERE resolution = :res", res=4).first()[0] == n[4]
    finally:
        spark.sql("DROP DATABASE IF EXISTS nav_test CASCADE")


RING = [(0.0, 0.0), (0.001, 0.001), (0.0, 5.0), (5.0, 5.0), (5.0, 0.0), (0.0, 0.0)]  # clockwise
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
SPECK = [(3.0, 3.0), (3.0, 3.001), (3.001, 3.001), (3.0, 3.0)]


def test_dimensions(spark):
    rows = [(0, "AAAAFIR", "ALPHA FIR", [RING, HOLE, SPECK]), (1, "OOOOFIR", "None", [RING]), (2, "BBBBFIR", "BETA BAY UIR", [[(x + 10, y) for x, y in RING], [(x + 90, y) for x, y in RING]]), (3, "CCCCUIR", "Gamma", [RING])]
    shapes = spark.createDataFrame(rows, f"ord int, code string, name string, rings array<{dimensions.POINTS}>")
    a, b = dimensions.regions(shapes, box=(-1.0, -1.0, 20.0, 20.0)).orderBy("ord").collect()
    assert (a.id, a.name, a.minx, a.maxx, b.id, b.name, b.minx, b.maxx) == ("AAAA", "Alpha", 0.0, 5.0, "BBBB", "Beta Bay", 10.0, 15.0)
    assert [len(p) for p in a.polygons] == [2] and len(a.polygons[0][0]) == 5 and a.area == pytest.approx(25.0) and len(b.polygons) == 1


def test_shapefile(spark, tmp_path):
    import struct

    def record(number, rings):
        points = [xy for r in rings for xy in r]
        starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
        body = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *xy) for xy in points)
        return struct.pack(">2i", number, len(body) // 2) + body

    north = lambda r: [(x + 30, y + 40) for x, y in r]
    shp = b"\0" * 100 + record(1, [north(RING), north(HOLE)]) + struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    fields = b"".join(n.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in ((b"AV_AIRSPAC", 8), (b"AV_NAME", 12))) + b"\r"
    dbf = struct.pack("<4BIHH", 3, 0, 0, 0, 2, 32 + len(fields), 21) + b"\0" * 20 + fields + b" AAAAFIR ALPHA FIR   " + b" BBBBFIR BETA        "
    (tmp_path / "a.shp").write_bytes(shp)
    (tmp_path / "a.dbf").write_bytes(dbf)
    assert cli.main(["build-firs", str(tmp_path / "a.shp"), str(tmp_path / "a.dbf"), "--out", str(tmp_path)], spark) == cli.OK
    (r,) = dimensions.read_places(spark, str(tmp_path / "firs.json")).collect()
    assert (r.kind, r.id, r.name, r.minx, r.area) == ("fir", "AAAA", "Alpha", 30.0, pytest.approx(25.0)) and len(r.polygons[0]) == 2


def test_places_and_airports(spark, tmp_path):
    north = lambda r: [[x + 30, y + 40] for x, y in r]
    feature = lambda props, kind, c: {"properties": props, "geometry": {"type": kind, "coordinates": c}}
    land = [feature({"NAME": "Turkey", "NAME_TR": "T"}, "Polygon", [north(RING)]), feature({"NAME": "Far", "NAME_TR": "F"}, "MultiPolygon", [[[[x + 100, y] for x, y in RING]]]), feature({"NAME": "Tiny", "NAME_TR": None}, "Polygon", [north(SPECK)])]
    seas = [feature({"name": "Sea", "name_tr": "Deniz"}, "MultiPolygon", [[north(RING)], [north(HOLE)]])]
    for name, features in (("land", land), ("seas", seas)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"features": features}))
    assert cli.main(["build-places", str(tmp_path / "land.json"), str(tmp_path / "seas.json"), "--out", str(tmp_path)], spark) == cli.OK
    got = dimensions.read_places(spark, str(tmp_path / "places.json")).orderBy("ord").collect()
    assert [(r.kind, r.id, r.name, len(r.polygons)) for r in got] == [("country", "Türkiye", "T", 1), ("sea", "Sea", "Deniz", 2)]
    (tmp_path / "a.csv").write_text('ident,type,name,latitude_deg,longitude_deg,scheduled_service,icao_code,iata_code,iso_country\nX1,medium_airport,"B, ""b""",41.00001,29,yes,,,TR\nX2,large_airport,A,41,29,yes,LTXX,IST,TR\nX3,large_airport,C,41,29,no,,,TR\nX4,heliport,D,41,29,yes,,,TR\nX5,large_airport,E,bad,29,yes,,,TR\n')
    assert cli.main(["build-airports", str(tmp_path / "a.csv"), "--out", str(tmp_path)], spark) == cli.OK
    found = json.loads((tmp_path / "airports.geojson").read_text())["features"]
    assert [(f["properties"]["icao"], f["properties"]["name"], f["geometry"]["coordinates"]) for f in found] == [("LTXX", "A", [29.0, 41.0]), ("X1", 'B, "b"', [29.0, 41.0])]


def test_calibration(spark, sf, tmp_path, capsys):
    """Two days of equal events: each comes back on one other day."""
    import datetime

    from navlattice.operators import calibrate

    p = fixtures.positions(spark, sf)
    later = p.withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    for d, x in ((DAY, p), (DAY + datetime.timedelta(days=1), later)):
        days.write_day(x, rollup.rollup(x), str(tmp_path), cli.SOURCE, d)
    found = [calibrate.day_events(spark.read.parquet(f"{days.day_dir(str(tmp_path), cli.SOURCE, DAY + datetime.timedelta(days=i))}/hourly"), str(i)) for i in (0, 1)]
    r = calibrate.repeats(found[0][0].unionByName(found[1][0])).collect()
    assert r and {x.days for x in r} == {1}
    assert found[0][1].first()["hot"] == found[1][1].first()["hot"] > 0
    assert cli.main(["calibrate", "--archive", str(tmp_path), "--end", "2024-01-05"], spark) == cli.OK
    out = capsys.readouterr().out
    assert all(k in out for k in ("candidates", "observed", "confidence", "scale", "level", "cells"))


def test_regions(spark):
    assert regions.parse("1,2,3.5,4") == (1.0, 2.0, 3.5, 4.0)
    points = spark.createDataFrame([(1.0, 2.0), (3.5, 4.0), (3.6, 4.0)], "lat double, lon double")
    assert points.where(regions.contains((1.0, 2.0, 3.5, 4.0), F.col("lat"), F.col("lon"))).count() == 2


def test_commands(spark, day_folder, tmp_path, capsys):
    common = ["--date", str(DAY), "--archive", day_folder]
    assert cli.main(["check-contract", *common], spark) == cli.OK
    assert cli.main(["check-contract", "--date", "2024-01-02", "--archive", day_folder], spark) == cli.CONTRACT
    assert cli.main(["verify", *common], spark) == cli.OK
    assert cli.main(["events", *common, "--json", str(tmp_path / "events")], spark) == cli.OK
    assert cli.main(["spoofing", *common], spark) == cli.OK
    assert cli.main(["avionics", *common, "--res", "4"], spark) == cli.OK
    assert cli.main(["publish", *common, "--to", str(tmp_path / "published")], spark) == cli.OK
    state = ["--state", str(tmp_path / "state")]
    assert [cli.main(["mark", "--date", "2024-01-03", "--failed", "--error", "x", *state], spark) for _ in range(3)] == [0, 0, cli.QUARANTINED]
    capsys.readouterr()
    assert cli.main(["plan", "--archive", day_folder, *state, "--start", "2024-01-01", "--end", "2024-01-03", "--static", str(tmp_path / "static")], spark) == cli.OK
    assert capsys.readouterr().out.split("\n")[:2] == ["2024-01-02 process", "2024-01-01 export"]
    assert cli.main(["matrix", "--archive", day_folder, "--start", "2024-01-01", "--end", "2024-01-03"], spark) == cli.OK
    assert json.loads(capsys.readouterr().out.strip().split("\n")[-1])["matrix"] == [{"days": "2024-01-03 2024-01-02", "label": "2024-01-03 … 2024-01-02"}]
    assert cli.main(["daily", "--date", "2024-01-05", "--archive", str(tmp_path / "a")], spark) == cli.NOT_PUBLISHED
    _tar(tmp_path / "2024-01-06.tar", {"traces/trace_a.json": json.dumps(_trace("abc", 30)).encode()})
    assert cli.main(["process-days", "2024-01-06", "2024-01-07", "--archive", str(tmp_path / "a"), "--pattern", str(tmp_path / "{day}.tar"), "--to", str(tmp_path / "b")], spark) == cli.OK
    told = json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    assert told["done"] == ["2024-01-06"] and told["missing"] == ["2024-01-07"]
