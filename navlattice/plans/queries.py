"""The registered queries of the position analytics, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, stats
from ..operators import avionics, calibrate, events, jumps, regions, reports, rollup, serve, store, verify
from ..sources import days, dimensions, fixtures, ingest, live, registry
from ..sources.fixtures import positions
from . import backfill

START, END = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rollup(positions(spark, sf_dir))


def joined(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)


def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(spark, sf_dir).withColumn("nic_hist", joined("nic_hist"))


def positions_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(spark, sf_dir).selectExpr("unix_millis(ts) as ts_ms", "icao24", "round(lat, 6) as lat", "round(lon, 6) as lon", "cast(alt_baro_ft as double) as alt", "callsign", "cast(nic as int) as nic", "cast(nac_p as int) as nac_p", "source", "on_ground", "anonymous")


def _cells(res: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return serve.cells(hourly(spark, sf_dir), res).select("h3", "n_total", "n_bad", "n_total_cruise", "n_bad_cruise", "level", "confidence", F.round("ratio_bad", 4).alias("ratio_bad"))

    return run


def bad_aircraft_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = serve.cells(hourly(spark, sf_dir), 4).select("h3", F.explode("bad").alias("b"))
    return c.select("h3", "b.rank", F.col("b.min_nic").cast("int").alias("min_nic"), "b.icao24", "b.callsign", "b.anonymous")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.timeline(hourly(spark, sf_dir))


def timeline_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.filled(serve.timeline(hourly(spark, sf_dir)), START, END)


def route_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.route_hours(hourly(spark, sf_dir), 4).select("h3", joined("aircraft"), joined("affected"))


def coarsen_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.coarsen(hourly(spark, sf_dir), 3).withColumn("nic_hist", joined("nic_hist")).withColumn("min_nic", F.col("min_nic").cast("int"))


#: The res-3 cell whose details are asked for: around 41.5 N, 29.1 E.
CELL = (7 << 59) | (3 << 52) | (116 << 20) | 185


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.of_cell(hourly(spark, sf_dir), F.lit(CELL), 3)


def cell_aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.cell_aircraft(_part(spark, sf_dir)).withColumn("min_nic", F.col("min_nic").cast("int"))


def cell_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.timeline(_part(spark, sf_dir))


def nic_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.nic_histogram(_part(spark, sf_dir))


def cell_altitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.altitude(_part(spark, sf_dir))


def cell_nacp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.nacp(_part(spark, sf_dir))


def data_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.data_range(hourly(spark, sf_dir))


def detail_cell_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import export

    h = events.settled(hourly(spark, sf_dir))
    return export.selected(export.day_cells(h, None)).select("h3", "resolution", "n_total", "n_bad")


def avionics_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avionics.peers(hourly(spark, sf_dir))


def avionics_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avionics.verdicts(hourly(spark, sf_dir))


def avionics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avionics.report(avionics.verdicts(hourly(spark, sf_dir)))


def _sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = events.settled(hourly(spark, sf_dir))
    return serve.without(h, avionics.verdicts(h).where("faulty"))


def cells_excluding_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.cells(_sound(spark, sf_dir), 4).select("h3", "n_total", "n_bad", "level")


def cell_hour_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.nodes(_sound(spark, sf_dir))


def event_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = events.settled(events.hot(events.nodes(_sound(spark, sf_dir))))
    return events.components(h)


def _firs(spark: SparkSession) -> DataFrame:
    return fixtures.shapes(spark, fixtures.FIRS)


def _flat(e: DataFrame) -> DataFrame:
    """The common schema without nested columns."""
    nested = [f"data_coverage.{c}" for c in ("aircraft_observed", "peak_hour", "peak_cell", "peak_aircraft_observed", "peak_aircraft_affected", "cell_hours")] + [f"evidence.{c}" for c in ("spoofing_confidence", "icao24", "jumps", "max_dist_nm", "max_speed_kt")]
    return e.select("event_id", "type", "first_seen", "last_seen", "duration_hours", joined("cells"), "region_h3", "fir", joined("firs"), "affected_aircraft", "scale", "confidence", *nested, "source", "algorithm_version", "anonymous")


def _jamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.jamming_events(_sound(spark, sf_dir), firs=_firs(spark))


def _jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.settled(jumps.sessions(jumps.unshared(jumps.jumps(positions(spark, sf_dir)))))


def _all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _jumps(spark, sf_dir)
    return events.common(_jamming(spark, sf_dir), events.spoof_common(jumps.events_of(numbered), numbered, _firs(spark)))


def jamming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_jamming(spark, sf_dir))


def spoof_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _jumps(spark, sf_dir)
    return _flat(events.spoof_common(jumps.events_of(numbered), numbered, _firs(spark)))


def event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = events.payload(events.settled(_all_events(spark, sf_dir)), "2024-01-01", regions.MAP_REGION)
    pairs = lambda c: F.array_join(F.transform(F.map_entries(c), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",").alias(c)
    return p.select("date", "algorithm_version", "count", pairs("by_type"), pairs("by_confidence"), F.array_join(F.transform("events", lambda e: e["event_id"]), ",").alias("event_ids"))


def spoof_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _jumps(spark, sf_dir)
    p = events.spoof_payload(jumps.events_of(numbered), numbered, regions.MAP_REGION)
    return p.select("icao24", "confidence", "start", "end", F.size("jumps").cast("long").alias("n"), F.col("jumps")[0]["before"]["ts"].alias("first_ts"), F.col("jumps")[0]["before"]["lat"].alias("first_lat"), F.element_at("jumps", -1)["after"]["lon"].alias("last_lon"), F.element_at("jumps", -1)["dist_nm"].alias("last_nm"))


def worst_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_events(_all_events(spark, sf_dir), 10).select("event_id", "affected_aircraft", "first_seen")


def worst_spoofing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_spoofing(jumps.events_of(_jumps(spark, sf_dir)), 10).selectExpr("icao24", "jumps", "unix_millis(start) as start_ms")


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(_all_events(spark, sf_dir), "type")


def event_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.observed_quantiles(events.jamming_events(_sound(spark, sf_dir), 1))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one aircraft or more, three-hour spans of their first hour standing for days."""
    span = F.floor(F.substring("first_seen", 12, 2).cast("int") / 3).cast("int")
    return events.settled(events.jamming_events(_sound(spark, sf_dir), 1).withColumn("day", span))


def event_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.repeats(_spans(spark, sf_dir)).select("day", "event_id", "days")


def event_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.candidates(calibrate.repeats(_spans(spark, sf_dir)))


def expected_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.expected_hot(events.nodes(_sound(spark, sf_dir))).select("hot", F.round("expected", 6).alias("expected"))


def jumps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jumps.jumps(positions(spark, sf_dir)).selectExpr("icao24", "unix_millis(before.ts) as before_ms", "unix_millis(after.ts) as after_ms", "round(dist_nm, 3) as dist_nm", "round(speed_kt, 1) as speed_kt")


def jumps_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jumps.unshared(jumps.jumps(positions(spark, sf_dir))).selectExpr("icao24", "unix_millis(before.ts) as before_ms", "unix_millis(after.ts) as after_ms")


def spoof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = jumps.events(jumps.unshared(jumps.jumps(positions(spark, sf_dir))))
    return e.selectExpr("icao24", "unix_millis(start) as start_ms", "unix_millis(end) as end_ms", "jumps", "round(max_dist_nm, 3) as max_dist_nm", "anonymous", "confidence")


def rollup_resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = store.hourly_rows(hourly(spark, sf_dir))
    return r.withColumn("nic_hist", joined("nic_hist")).withColumn("min_nic", F.col("min_nic").cast("int"))


def cells_from_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.cells_of_reports(positions(spark, sf_dir), 4).select("h3", "n_total", "n_bad", "n_total_cruise", "n_bad_cruise", "level", "confidence", "ratio_bad")


def timeline_from_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.timeline_of_reports(positions(spark, sf_dir))


def nic_histogram_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = _part(spark, sf_dir).withColumn("nic_hist", F.array_repeat(F.lit(0).cast("bigint"), 12))
    return serve.nic_histogram_or_reports(none, positions(spark, sf_dir), F.lit(CELL), 3)


def region_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.centred(serve.cells(hourly(spark, sf_dir), 4), regions.MAP_REGION, 4).select("h3", "n_total", "n_bad", "level")


def range_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = regions.in_hours(hourly(spark, sf_dir), "2024-01-01 06:20:00", "2024-01-01 11:30:00")
    return serve.cells(part, 4).select("h3", "n_total", "n_bad", "level")


def range_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sources(regions.in_time(positions(spark, sf_dir), "2024-01-01 06:20:00", "2024-01-01 11:30:00"))


def cell_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = hourly(spark, sf_dir).select("h3").distinct()
    places = fixtures.shapes(spark, fixtures.PLACES)
    named = regions.place_of_cells(cells, places, 5).join(places.select("ord", "kind", "id"), "ord")
    return named.select(F.col("cell").alias("h3"), "kind", "id")


def fir_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.place_totals(serve.cells(hourly(spark, sf_dir), 4), _firs(spark), 4).select("id", "aircraft", "affected")


def country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.place_totals(serve.cells(hourly(spark, sf_dir), 5), fixtures.shapes(spark, fixtures.PLACES), 5, "country").select("id", "aircraft", "affected")


def place_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.shapes(spark, fixtures.FIRS).select("ord", "id", "minx", "miny", "maxx", "maxy", F.round("area", 9).alias("area"))


def peak_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.peak_hours(hourly(spark, sf_dir), 4)


def grid_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import grid

    c = hourly(spark, sf_dir).select("h3").distinct().select("h3", grid.text(F.col("h3")).alias("id"), grid.resolution(F.col("h3")).alias("res"), grid.center(F.col("h3"), 5).alias("c"), grid.boundary(F.col("h3"), 5).alias("b"))
    return c.select("h3", "id", "res", grid.number(F.col("id")).alias("number"), "c.lat", "c.lon", F.col("b")[2]["lat"].alias("north"), F.col("b")[2]["lon"].alias("east"), F.size(grid.disk(F.col("h3"))).alias("near"))


def _faulty(h: DataFrame) -> DataFrame:
    return avionics.verdicts(h).where("faulty")


def level_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = events.settled(hourly(spark, sf_dir))
    return reports.filter_effect(h, _faulty(h), 5)[0].withColumnRenamed("count", "n")


def filter_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = events.settled(hourly(spark, sf_dir))
    return reports.filter_effect(h, _faulty(h), 5)[1]


def faulty_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = events.settled(hourly(spark, sf_dir))
    return reports.faulty_share(h, _faulty(h))


def source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sources(positions(spark, sf_dir))


def nic_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.integrity(positions(spark, sf_dir))


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.totals(positions(spark, sf_dir))


def worst_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.worst_cells(serve.cells(hourly(spark, sf_dir), 5), 15).select("h3", "n_total", "n_bad")


def geojson_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = reports.geojson(serve.cells(hourly(spark, sf_dir), 4), 4)
    value = lambda path, kind: F.try_variant_get(F.parse_json("feature"), path, kind)
    return f.select("h3", value("$.type", "string").alias("type"), value("$.geometry.type", "string").alias("shape"), *(value(f"$.geometry.coordinates[0][{i}][{j}]", "double").alias(f"p{i}{j}") for i in (0, 2, 4) for j in (0, 1)), value("$.properties.n_bad", "long").alias("n_bad"), value("$.properties.level", "string").alias("level"))


def serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.position_rows(positions(spark, sf_dir)).selectExpr("unix_millis(ts) as ts_ms", "icao24", "h3_r5", "cast(nic as int) as nic", "source", "day")


def licensed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.licensed(positions(spark, sf_dir)).groupBy(registry.source_key(F.col("source")).alias("key")).agg(F.count("*").alias("n"))


def manifest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"positions": positions(spark, sf_dir), "hourly": hourly(spark, sf_dir)}
    a, b = (days.table_stats(t).select(F.lit(name).alias("name"), "rows", "aircraft") for name, t in tables.items())
    return a.unionByName(b)


#: The box that verification compares in.
INNER = (33.0, 28.0, 41.15, 36.0)


def verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored rollup that lacks an hour and has wrong counts in another, against the positions."""
    h = hourly(spark, sf_dir).where(F.hour("hour") != 5).withColumn("n_reports", F.when(F.hour("hour") == 9, F.col("n_reports") + 1).otherwise(F.col("n_reports")))
    return verify.verify_day(events.settled(h), positions(spark, sf_dir), INNER).drop("avionics_same")


def inner_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = events.settled(hourly(spark, sf_dir))
    return verify.keep_cells(h, verify.inner_cells(h, INNER)).groupBy("h3").agg(F.count("*").alias("n"))


def trace_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ingest.traces(fixtures.trace_documents(spark, sf_dir))
    return t.selectExpr("unix_millis(ts) as ts_ms", "icao24", "lat", "lon", "cast(alt_baro_ft as double) as alt", "on_ground", "callsign", "cast(nic as int) as nic", "cast(nac_p as int) as nac_p", "round(cast(nic_age_s as double), 2) as nic_age_s", "source", "anonymous")


def live_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = live.snapshot(fixtures.live_answers(spark, sf_dir), regions.MAP_REGION)
    return s.selectExpr("snapshot_id", "unix_millis(ts) as ts_ms", "icao24", "round(lat, 6) as lat", "round(lon, 6) as lon", "cast(alt_baro_ft as double) as alt", "callsign", "cast(nic as int) as nic", "source", "on_ground", "anonymous")


def box_circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(i, *c) for i, c in enumerate(live.cover(regions.FOCUS_BOX))]
    return spark.createDataFrame(rows, "circle long, lat double, lon double")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport rules over rows made of customers."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "concat('K', c_custkey) as ident", "element_at(array('large_airport', 'medium_airport', 'small_airport', 'heliport'), cast(c_custkey % 4 + 1 as int)) as type", "c_name as name", "cast(20 + (c_custkey * 37) % 4000 / 100e0 as string) as latitude_deg",
        "if(c_custkey % 50 = 0, 'x', cast(10 + (c_custkey * 91) % 6000 / 100e0 as string)) as longitude_deg", "if(c_custkey % 3 = 0, 'no', 'yes') as scheduled_service", "if(c_custkey % 5 = 0, '', concat('Q', c_custkey)) as icao_code", "'' as iata_code", "c_mktsegment as iso_country")
    return dimensions.airports(c)


def _days(spark: SparkSession, start: str, end: str) -> DataFrame:
    import datetime as dt

    return backfill.days(spark, dt.date.fromisoformat(start), dt.date.fromisoformat(end))


def day_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of a quarter with made-up states of its days."""
    import datetime as dt

    d = _days(spark, "2024-01-01", "2024-03-31")
    n = F.dayofyear("day")
    failures = d.where(n % 5 == 0).select("day", (n % 4 + 1).alias("count"), (F.lit(dt.datetime(2024, 4, 1, 12)) - F.make_dt_interval(n % 7)).alias("last"))
    return backfill.plan(d, d.where(n % 2 == 0), d.where(n % 3 == 0), failures, dt.datetime(2024, 4, 1, 12))


def days_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _days(spark, "2024-01-25", "2024-02-10")
    return backfill.missing(d, d.where(F.dayofmonth("day") % 3 == 0)).join(d, "day")


def level_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.range(0, 60).select(F.col("id").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("id"))).alias("k"))
    return n.select("n", "k", F.round(stats.binomial_tail(F.col("k"), F.col("n")), 9).alias("tail"), stats.level(F.col("n"), F.col("k")).alias("level"), stats.confidence(F.col("n"), F.col("k")).alias("confidence"), stats.scale(F.col("k")).alias("scale"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = (
        hourly_rollup, positions_fixture, bad_aircraft_topn, timeline, timeline_filled, route_hours, coarsen_rollup, cell_aircraft, cell_hours, nic_histogram, cell_altitude, cell_nacp, data_range, detail_cell_selection, avionics_peers, avionics_verdicts, avionics_report, cells_excluding_faulty,
        cell_hour_nodes, event_components, jamming_events, jumps_raw, jumps_suppressed, spoof_events, level_table, spoof_common, event_payload, spoof_payload, worst_events, worst_spoofing, event_types, event_quantiles, event_repeats, event_candidates, expected_hot, rollup_resolutions, cells_from_reports,
        timeline_from_reports, nic_histogram_reports, region_cells, range_cells, range_sources, cell_places, fir_totals, country_totals, place_shapes, peak_hours, grid_functions, level_transitions, filter_changes, faulty_share, source_distribution, nic_distribution, report_totals, worst_cells,
        geojson_cells, serving_rows, licensed_sources, manifest_stats, verification, inner_rows, trace_reports, live_snapshot, box_circles, airports, day_plan, days_missing,
    )
    return {f.__name__: f for f in plain} | {f"cells_r{res}": _cells(res) for res in (3, 4, 5)}
