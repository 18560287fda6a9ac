"""Hand-computed cases."""

import json

from pyspark.sql import functions as F

from navlattice.functions import stats
from navlattice.operators import geo, rollup, verify
from navlattice.sources import fixtures, ingest
from navlattice.streaming import hourly as stream


def test_trace_carry_forward(spark):
    doc = {"icao": "~ABC123", "timestamp": 1704067200, "dbFlags": 8, "trace": [
        [0, 41.0, 29.0, "ground", None, None, 0, None, {"nic": 8, "nac_p": 9, "sil": 3, "flight": "TK1  "}, "adsb_icao", 100],
        [30, 41.01, 29.01, 3000, None, None, 0, None, None, "adsb_icao", 3100],
        [61, 41.02, 29.02, 6000, None, None, 0, None, None, "adsb_icao"],
        [70, None, None, 6500, None, None, 0, None, {"nac_p": 9}, "adsb_icao"],
        [75, 41.03, 29.03, 7000, None, None, 0, None, None, None]]}
    docs = spark.createDataFrame([(json.dumps(doc),), ("no json",)], "document string")
    got = [tuple(r) for r in ingest.traces(docs).orderBy("ts").select("icao24", "on_ground", "alt_baro_ft", "nic", "nac_p", "nic_age_s", "callsign", "source", "anonymous").collect()]
    assert got == [
        ("abc123", True, None, 8, 9, 0.0, "TK1", "adsblol:adsb_icao", True), ("abc123", False, 3000.0, 8, 9, 30.0, "TK1", "adsblol:adsb_icao", True),
        ("abc123", False, 6000.0, None, None, None, "TK1", "adsblol:adsb_icao", True), ("abc123", False, 7000.0, None, 9, 5.0, "TK1", "adsblol:unknown", True)]
    assert ingest.corrupt_share(docs).first()["share"] == 0.5


def test_live(spark):
    snap = {"ac": [{"hex": "~AB", "lat": 1.0, "lon": 2.0, "seen_pos": 2.5, "alt_baro": "ground", "nic": 8, "type": "adsb_icao"}, {"hex": "c", "lat": 1.0, "lon": 2.0, "seen_pos": 61}, {"hex": "d"}]}
    got = ingest.live(spark.createDataFrame([(json.dumps(snap), 100.0)], "snapshot string, now double")).collect()
    assert [(r.icao24, r.on_ground, r.ts.timestamp(), r.nic) for r in got] == [("~ab", True, 97.5, 8)]


def test_tail(spark):
    assert abs(spark.range(1).select(stats.binomial_tail(F.lit(3), F.lit(20))).first()[0] - 0.0031780828) < 1e-9


def test_polygon_with_hole(spark):
    ring = lambda a, b: [(a, a), (a, b), (b, b), (b, a)]
    places = spark.createDataFrame([(0, "sea", 1.0, 0.0, 0.0, 1.0, 1.0, [[ring(0.0, 1.0), ring(0.4, 0.6)]]), (1, "country", 100.0, 0.0, 0.0, 10.0, 10.0, [[ring(2.0, 10.0)]])], "ord int, kind string, area double, minx double, miny double, maxx double, maxy double, polygons array<array<array<struct<x: double, y: double>>>>")
    points = spark.createDataFrame([(1, 0.2, 0.2), (2, 0.5, 0.5), (3, 5.0, 5.0)], "id int, lon double, lat double")
    assert {r.id: r.ord for r in geo.places_of(points, places, "id").collect()} == {1: 0, 3: 1}


def test_stream_equals_batch(spark, sf, tmp_path):
    positions = fixtures.positions(spark, sf)
    positions.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = stream.hourly(stream.positions(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("hourly_stream").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    columns = ["n_reports", "n_bad_reports", "min_nic", "anonymous", "n_low_reports", "n_low_bad_reports", "n_nacp_reports", "n_low_nacp_reports", "nic_hist", "callsign"]
    got = spark.table("hourly_stream")
    assert verify.compare(rollup.rollup(positions), got, columns).first().asDict() == {"only_stored": 0, "only_recomputed": 0, "different": 0, "equal": got.count()}


def test_trailing_hours_are_replaced(spark, sf, tmp_path):
    """Two runs over files that come one after the other end where one batch does."""
    positions = fixtures.positions(spark, sf).where(F.hour("ts").between(4, 6))
    source, target, inbox = (str(tmp_path / x) for x in ("source", "target", "in"))
    for i in range(2):
        positions.where(F.pmod(F.hash("icao24"), F.lit(2)) == i).coalesce(1).write.mode("append").parquet(inbox)
        stream.start(stream.positions(spark, inbox), spark, source, target, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    got = spark.read.parquet(target).drop("hour_key")
    r = verify.compare(rollup.rollup(positions), got, ["n_reports", "nic_hist", "callsign"]).first()
    assert (r.only_stored, r.only_recomputed, r.different) == (0, 0, 0) and r["equal"] > 0


def test_stream_jumps_equal_batch(spark, sf, tmp_path):
    from navlattice.operators import jumps
    from navlattice.streaming import jumps as live_jumps

    positions = fixtures.positions(spark, sf)
    inbox = str(tmp_path / "in")
    for lo, hi in ((0, 11), (12, 23)):
        positions.where(F.hour("ts").between(lo, hi)).coalesce(1).write.mode("append").parquet(inbox)
    found = live_jumps.jumps(stream.positions(spark, inbox))
    q = found.writeStream.format("memory").queryName("jump_stream").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda rows: sorted((r.icao24, round(r.a, 3), round(r.b, 3), round(r.dist_nm, 3)) for r in rows)
    got = spark.table("jump_stream").selectExpr("icao24", "before_ts as a", "after_ts as b", "dist_nm").collect()
    want = jumps.jumps(positions).selectExpr("icao24", "unix_millis(before.ts) / 1000 as a", "unix_millis(after.ts) / 1000 as b", "dist_nm").collect()
    assert key(got) == key(want) and got


def test_stream_sessions():
    import pandas as pd

    from navlattice.streaming.jumps import _sessions

    class State:
        exists = False

        def update(self, value):
            self.get, self.exists = value, True

    state = State()
    frame = lambda *rows: iter([pd.DataFrame(rows, columns=["before_ts", "after_ts"])])
    first = pd.concat(_sessions(("a",), frame((0.0, 10.0), (610.0, 620.0), (1220.1, 1230.0)), state))
    assert first[["session", "start", "end", "jumps"]].values.tolist() == [[1, 0.0, 620.0, 2], [2, 1220.1, 1230.0, 1]]
    second = pd.concat(_sessions(("a",), frame((1300.0, 1310.0)), state))
    assert second[["session", "start", "end", "jumps"]].values.tolist() == [[2, 1220.1, 1310.0, 2]]


def test_poll_loop_goes_on():
    seen, waits = [], []

    def step():
        seen.append(1)
        if len(seen) == 2:
            raise OSError("sink is away")

    assert stream.poll_loop(step, 5, 3, waits.append) == 1 and len(seen) == 3 and waits == [5, 5]


def test_verify_and_transitions(spark, sf):
    from navlattice.operators import serve

    h = rollup.rollup(fixtures.positions(spark, sf)).cache()
    r = verify.verify_day(h, fixtures.positions(spark, sf), (20.0, 0.0, 60.0, 60.0)).first()
    assert r.avionics_same and r.only_stored == r.only_recomputed == r.different == 0 and r["equal"] > 0
    cells = serve.cells(h, 4).cache()
    moved = {(x.before, x.after): x["count"] for x in verify.transitions(cells, cells.where("level <> 'high'")).collect()}
    assert all(a == b or (a, b) == ("high", "noData") for a, b in moved) and sum(moved.values()) == cells.count()


def test_shared_addresses(spark):
    """Two clusters of ends, four jumps: dropped; three clusters, or three jumps: kept."""
    from navlattice.operators import jumps

    point = lambda i, lat: {"ts": None, "lat": lat, "lon": 0.0, "nic": None, "source": "", "on_ground": False, "anonymous": False}

    def rows(icao, lats):
        import datetime as dt

        out = []
        for i, (a, b) in enumerate(zip(lats, lats[1:])):
            x, y = point(i, a), point(i, b)
            x["ts"], y["ts"] = dt.datetime(2024, 1, 1, 0, i), dt.datetime(2024, 1, 1, 0, i + 1)
            out.append((icao, x, y, 60.0, 300.0, 18000.0))
        return out

    shape = "struct<ts: timestamp, lat: double, lon: double, nic: tinyint, source: string, on_ground: boolean, anonymous: boolean>"
    data = rows("two", [0.0, 5.0, 0.1, 5.1, 0.2]) + rows("three", [0.0, 5.0, 0.1, 10.0, 0.2]) + rows("few", [0.0, 5.0, 0.1, 5.1])
    df = spark.createDataFrame(data, f"icao24 string, before {shape}, after {shape}, dt_s double, dist_nm double, speed_kt double")
    assert {r.icao24 for r in jumps.unshared(df).select("icao24").distinct().collect()} == {"three", "few"}


def test_components_by_rounds_and_at_once(spark, monkeypatch):
    """Chains, stars and loops: the rounds and the single task end alike."""
    import random

    from navlattice.operators import graph

    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)] + [(rnd.randrange(300, 380), rnd.randrange(300, 380)) for _ in range(60)] + [(None, 5)]
    top = {x: x for p in pairs if None not in p for x in p}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        if a is not None and find(a) != find(b):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    edges = spark.createDataFrame(pairs, "a long, b long")
    for few in (graph.FEW, 0):
        monkeypatch.setattr(graph, "FEW", few)
        got = {r.node: r.component for r in graph.components(edges).collect()}
        assert got == {x: find(x) for x in top}
    assert graph.components(edges.limit(0)).count() == 0


def test_components_of_many_batches(spark):
    """A chain and stars of more edges than one Arrow batch holds, solved at once."""
    from navlattice.operators import graph

    chain = spark.range(30_000).selectExpr("id as a", "id + 1 as b")
    stars = spark.range(15_000).selectExpr("1000000 + id div 100 * 1000 as a", "1000001 + id div 100 * 1000 + id % 100 as b")
    got = graph.components(chain.unionByName(stars)).groupBy("component").count()
    assert sorted((r.component, r["count"]) for r in got.collect()) == [(0, 30_001)] + [(1_000_000 + 1000 * i, 101) for i in range(150)]


def test_chance_of_hot_in_one_pass(spark):
    """The chance of a hot level against plain sums, and for so many aircraft that a tail for each number of affected ones would not end."""
    import math
    import time

    from pyspark.sql import functions as F

    from navlattice.operators import calibrate
    from navlattice.schema import BACKGROUND_RATE, HIGH_MIN_RATIO, LOW_MAX_RATIO, SIGNIFICANCE

    def plain(n):
        pmf = [math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(BACKGROUND_RATE) + (n - k) * math.log1p(-BACKGROUND_RATE)) for k in range(n + 1)]
        below = [0.0]
        for x in pmf:
            below.append(below[-1] + x)
        return sum(pmf[k] for k in range(n + 1) if k / n > LOW_MAX_RATIO and max(0.0, 1 - below[k]) < SIGNIFICANCE)

    assert LOW_MAX_RATIO < HIGH_MIN_RATIO
    sizes = [5, 6, 7, 19, 20, 21, 64, 100, 333, 1000, 50_000]
    start = time.time()
    got = dict(spark.createDataFrame([(n,) for n in sizes], "n long").select("n", calibrate.chance_of_hot(F.col("n"))).collect())
    assert time.time() - start < 30
    assert all(math.isclose(got[n], plain(n), rel_tol=1e-6, abs_tol=1e-12) for n in sizes), [(n, got[n], plain(n)) for n in sizes]
