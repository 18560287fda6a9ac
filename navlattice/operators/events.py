"""Events: affected cells and hours that touch, joined into components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid, stats
from ..schema import ALGORITHM_VERSION, MIN_EVENT_AIRCRAFT
from . import graph
from .graph import settled
from .regions import Box, centred, contains, place_of_cells
from .rollup import by_aircraft

# Fixed values.
SOURCE = "adsblol"
SPOOF_CONFIDENCE = {"high": "high", "low": "low", "integrity_overlap": "low"}
COVERAGE = "struct<aircraft_observed: bigint, aircraft_affected: bigint, peak_hour: string, peak_cell: string, peak_aircraft_observed: bigint, peak_aircraft_affected: bigint, cell_hours: bigint>"
EVIDENCE = "struct<spoofing_confidence: string, icao24: string, jumps: bigint, max_dist_nm: double, max_speed_kt: bigint>"


def iso(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def event_id(kind: str, first_seen: Column, anchor: Column, extra: Column) -> Column:
    return F.concat(F.lit("ev_"), F.substring(F.sha1(F.concat_ws("|", F.lit(kind), F.lit(ALGORITHM_VERSION), first_seen, anchor, extra)), 1, 16))


def nodes(hourly: DataFrame) -> DataFrame:
    """Per (hour, cell): aircraft, affected ones, whether one of these is anonymous, and the level."""
    return nodes_of(by_aircraft(hourly, "hour", "h3"))


def nodes_of(aircraft: DataFrame) -> DataFrame:
    """The nodes of (hour, h3, icao24, affected, anonymous) rows."""
    n = aircraft.groupBy("hour", "h3").agg(F.count("*").alias("n_total"), F.count_if("affected").alias("n_bad"), F.max(F.col("affected") & F.col("anonymous")).alias("anonymous"))
    return n.withColumn("level", stats.level(F.col("n_total"), F.col("n_bad")))


def hot(nodes: DataFrame) -> DataFrame:
    return nodes.where("level in ('medium', 'high')").withColumn("node", grid.node(F.col("hour"), F.col("h3")))


def edges(hot: DataFrame) -> DataFrame:
    """Pairs of hot nodes: touching cells in the same or the next hour of one UTC day."""
    a = hot.select(F.col("node").alias("a"), F.to_date("hour").alias("day"), "hour", F.explode(grid.disk(F.col("h3"))).alias("h3"))
    a = a.select("a", "day", "h3", F.explode(F.array(F.col("hour"), F.col("hour") + F.expr("interval 1 hour"))).alias("hour")).where(F.to_date("hour") == F.col("day"))
    return a.join(hot.select(F.col("node").alias("b"), "hour", "h3"), ["hour", "h3"]).where("a <> b").select("a", "b")


def components(hot: DataFrame) -> DataFrame:
    """(node, component): the smallest hot node that is reachable, each node its own where nothing touches it."""
    return graph.components(edges(hot).unionByName(hot.select(F.col("node").alias("a"), F.col("node").alias("b"))))


def _regions(cells: DataFrame, firs: DataFrame | None) -> DataFrame:
    """(event, h3) with the flight information region of each cell, null where there is none."""
    if firs is None:
        return cells.withColumn("fir", F.lit(None).cast("string"))
    named = place_of_cells(cells, firs, 5).join(firs.select("ord", F.col("id").alias("fir")), "ord").select(F.col("cell").alias("h3"), "fir")
    return cells.join(named, "h3", "left")


def jamming_events(hourly: DataFrame, least: int = MIN_EVENT_AIRCRAFT, firs: DataFrame | None = None) -> DataFrame:
    """Events in the common schema, one for each component with `least` affected aircraft or more."""
    aircraft = settled(by_aircraft(hourly, "hour", "h3").select("hour", "h3", "icao24", "affected", "anonymous"))
    h = settled(hot(nodes_of(aircraft)))
    member = settled(h.join(components(h), "node"))
    rows = aircraft.drop("anonymous").join(member.select("hour", "h3", "component"), ["hour", "h3"])
    per = rows.groupBy("component", "icao24").agg(F.max("affected").alias("affected")).groupBy("component").agg(F.count("*").alias("observed"), F.count_if("affected").alias("affected_aircraft"))
    cell = _regions(member.groupBy("component", "h3").agg(F.count("*").alias("hours")), firs)
    region = cell.groupBy("component").agg(F.min_by(F.struct("h3", "fir"), F.struct(-F.col("hours"), F.col("h3"))).alias("region"), F.sort_array(F.collect_list(grid.text(F.col("h3")))).alias("cells"), F.sort_array(F.collect_set("fir")).alias("firs"))
    peak = F.max_by(F.struct("hour", "h3", "n_total", "n_bad"), F.struct("n_bad", F.col("n_bad") / F.col("n_total"), -F.unix_seconds("hour"), "h3"))
    e = member.groupBy("component").agg(F.min("hour").alias("first"), F.max("hour").alias("last"), peak.alias("peak"), F.count("*").alias("cell_hours"), F.max("anonymous").alias("anonymous"))
    e = e.join(per, "component").join(region, "component").where(F.col("affected_aircraft") >= least)
    seen, hit = F.greatest("observed", "peak.n_total", "affected_aircraft"), F.col("affected_aircraft")
    coverage = F.struct(seen.alias("aircraft_observed"), hit.alias("aircraft_affected"), iso(F.col("peak.hour")).alias("peak_hour"), grid.text(F.col("peak.h3")).alias("peak_cell"), F.col("peak.n_total").alias("peak_aircraft_observed"), F.col("peak.n_bad").alias("peak_aircraft_affected"), "cell_hours")
    return e.select(
        event_id("jamming", iso(F.col("first")), F.col("cells")[0], F.lit("")).alias("event_id"), F.lit("jamming").alias("type"), iso(F.col("first")).alias("first_seen"), iso(F.col("last")).alias("last_seen"), F.expr("(unix_seconds(last) - unix_seconds(first)) div 3600 + 1").alias("duration_hours"), "cells",
        grid.text(F.col("region.h3")).alias("region_h3"), F.col("region.fir").alias("fir"), "firs", "affected_aircraft", stats.scale(hit).alias("scale"), stats.confidence(seen, hit).alias("confidence"), coverage.alias("data_coverage"), F.lit(None).cast(EVIDENCE).alias("evidence"),
        F.lit(SOURCE).alias("source"), F.lit(ALGORITHM_VERSION).alias("algorithm_version"), "anonymous",
    )


def spoof_common(spoof: DataFrame, jumps: DataFrame, firs: DataFrame | None = None) -> DataFrame:
    """Spoofing events in the common schema; spoof: events of jumps (operators.jumps.events), jumps: numbered by session. Aircraft of a privacy programme keep no identity."""
    points = jumps.select("icao24", "session", F.explode(F.array(F.struct("before.lat", "before.lon"), F.struct("after.lat", "after.lon"))).alias("p"))
    cell = _regions(points.select("icao24", "session", grid.cell(F.col("p.lat"), F.col("p.lon")).alias("h3")).distinct(), firs)
    own = cell.groupBy("icao24", "session").agg(F.sort_array(F.collect_list(grid.text(F.col("h3")))).alias("cells"), F.sort_array(F.collect_set("fir")).alias("firs"))
    e = spoof.join(own, ["icao24", "session"]).withColumn("h3", grid.cell(F.col("origin.lat"), F.col("origin.lon")))
    if firs is None:
        e = e.withColumn("fir", F.lit(None).cast("string"))
    else:
        from .geo import places_of

        at = e.select(F.struct("icao24", "session").alias("event"), F.round("origin.lat", 4).alias("lat"), F.round("origin.lon", 4).alias("lon"))
        found = places_of(at, firs, "event").join(firs.select("ord", F.col("id").alias("fir")), "ord").select("event.icao24", "event.session", "fir")
        e = e.join(found, ["icao24", "session"], "left")
    evidence = F.struct(F.col("confidence").alias("spoofing_confidence"), F.when(~F.col("anonymous"), F.col("icao24")).alias("icao24"), "jumps", F.round("max_dist_nm", 1).alias("max_dist_nm"), F.round("max_speed_kt").cast("bigint").alias("max_speed_kt"))
    confidence = F.create_map(*(F.lit(x) for pair in SPOOF_CONFIDENCE.items() for x in pair))[F.col("confidence")]
    return e.select(
        event_id("spoofing", iso(F.col("start")), F.col("cells")[0], F.col("icao24")).alias("event_id"), F.lit("spoofing").alias("type"), iso(F.col("start")).alias("first_seen"), iso(F.col("end")).alias("last_seen"),
        F.expr("unix_seconds(end) div 3600 - unix_seconds(start) div 3600 + 1").alias("duration_hours"), "cells", grid.text(F.col("h3")).alias("region_h3"), "fir", "firs", F.lit(1).cast("bigint").alias("affected_aircraft"), F.lit(None).cast("string").alias("scale"), confidence.alias("confidence"),
        F.lit(None).cast(COVERAGE).alias("data_coverage"), evidence.alias("evidence"), F.lit(SOURCE).alias("source"), F.lit(ALGORITHM_VERSION).alias("algorithm_version"), "anonymous",
    )


def common(jamming: DataFrame, spoofing: DataFrame) -> DataFrame:
    """Events of both kinds, by time and id."""
    return jamming.unionByName(spoofing).orderBy("first_seen", "event_id")


def in_region(events: DataFrame, box: Box | None) -> DataFrame:
    """The events whose main cell's centre lies in the box."""
    return centred(events.withColumn("_h3", grid.number(F.col("region_h3"))), box, 5, "_h3").drop("_h3")


def _counts(events: DataFrame, column: str) -> Column:
    """A map of values to counts, as a scalar over `events`."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(column), F.col("n"))))).alias(f"by_{column}")


def payload(events: DataFrame, day: str, box: Box | None = None) -> DataFrame:
    """One row: date, version, count, counts by type and confidence, and the region's events in order."""
    chosen = in_region(events, box)
    listed = chosen.agg(F.count("*").alias("count"), F.array_sort(F.collect_list(F.struct("first_seen", "event_id", F.struct(*chosen.columns).alias("event")))).alias("e"))
    one = F.lit(1).alias("_one")
    sums = [chosen.groupBy(c).agg(F.count("*").alias("n")).agg(_counts(chosen, c)).select("*", one) for c in ("type", "confidence")]
    out = listed.select("*", one).join(sums[0], "_one").join(sums[1], "_one")
    return out.select(F.lit(day).alias("date"), F.lit(ALGORITHM_VERSION).alias("algorithm_version"), "count", "by_type", "by_confidence", F.transform("e", lambda x: x["event"]).alias("events"))


def spoof_payload(spoof: DataFrame, jumps: DataFrame, box: Box | None = None) -> DataFrame:
    """One row an event: identity (null for aircraft of a privacy programme), confidence, start, end and its jumps in order, rounded; the region is tested on the first jump's first point."""
    point = lambda s: F.struct(iso(F.col(f"{s}.ts")).alias("ts"), F.round(f"{s}.lat", 4).alias("lat"), F.round(f"{s}.lon", 4).alias("lon"), F.col(f"{s}.nic").alias("nic"))
    one = F.struct(F.col("after.ts").alias("at"), F.struct(point("before").alias("before"), point("after").alias("after"), F.round("dist_nm", 1).alias("dist_nm"), F.round("speed_kt").cast("bigint").alias("speed_kt")).alias("jump"))
    own = jumps.groupBy("icao24", "session").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["jump"]).alias("jumps"))
    chosen = spoof if box is None else spoof.where(contains(box, F.col("origin.lat"), F.col("origin.lon")))
    out = chosen.drop("jumps").join(own, ["icao24", "session"])
    return out.select(F.when(~F.col("anonymous"), F.col("icao24")).alias("icao24"), "confidence", iso(F.col("start")).alias("start"), iso(F.col("end")).alias("end"), "jumps")
