"""The static files of a day: cells, analytics, route hours, timeline, details, events and their manifest.

Every file is one (path, body) row; bodies are built by set-based queries for
all cells at once and written by the executors.  A file of cells holds one
region's grid at most; the world is refused for folders that a site serves.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid
from ..schema import ALGORITHM_VERSION, BAD_NACP_BELOW, LOW_ALT_FT, MAX_BAD_AIRCRAFT, MAX_CELL_AIRCRAFT, MAX_DETAIL_CELLS, RESOLUTIONS
from ..sources import files
from . import regions, serve
from .events import SOURCE, iso, settled
from .regions import Box
from .rollup import by_aircraft

#: A site's limits; a day of one region stays below them.
MAX_FILES, MAX_BYTES = 20_000, 25 << 20


def refuse_world(box: Box | None, folder: str) -> None:
    """The world is not written below a site's own data folder."""
    parts = files.system(folder)[1].split("/")
    if box is None and any(a == "public" and b == "data" for a, b in zip(parts, parts[1:], strict=False)):
        raise ValueError("the world does not go to a folder that the site serves; name another one")


def _one(df: DataFrame, path: str, body: Column) -> DataFrame:
    return df.agg(F.to_json(body, {"ignoreNullFields": "false"}).alias("body")).select(F.lit(path).alias("path"), "body")


def _sorted(columns: tuple, key: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(key, F.struct(*columns).alias("v")))), lambda x: x["v"])


def _span(day: dt.date) -> tuple[Column, Column]:
    return F.lit(f"{day}T00:00:00Z").alias("start"), F.lit(f"{day + dt.timedelta(days=1)}T00:00:00Z").alias("end")


_AIRCRAFT = ("icao24", "callsign", "min_nic", "anonymous")


def cell_file(cells: DataFrame, day: dt.date, res: int) -> DataFrame:
    bad = F.transform("bad", lambda b: F.struct(*(b[c].alias(c) for c in _AIRCRAFT))).alias("bad_aircraft")
    c = cells.withColumn("h3", grid.text(F.col("h3")))
    listed = _sorted(("h3", "n_total", "n_bad", "ratio_bad", "level", "n_total_cruise", "n_bad_cruise", "level_cruise", bad), "h3")
    return _one(c, f"jamming-r{res}.json", F.struct(*_span(day), F.lit(res).alias("resolution"), listed.alias("cells")))


def analytics_file(cells: DataFrame, day: dt.date, firs: DataFrame, places: DataFrame) -> DataFrame:
    """Totals of flight information regions and of countries over the cells of resolution 4."""
    one = F.lit(1).alias("_one")
    named = ("id", "name", "aircraft", "affected")
    f = regions.place_totals(cells, firs, 4).agg(_sorted(named, "id").alias("firs")).select("*", one)
    c = regions.place_totals(cells, places, 4, "country").agg(_sorted(named, "id").alias("countries")).select("*", one)
    return f.join(c, "_one").select(F.lit("analytics.json").alias("path"), F.to_json(F.struct(F.lit(str(day)).alias("date"), "firs", "countries")).alias("body"))


def route_file(hours: DataFrame, day: dt.date) -> DataFrame:
    h = hours.where(F.exists("aircraft", lambda x: x > 0)).withColumn("h3", grid.text(F.col("h3")))
    return _one(h, "route-hours-r4.json", F.struct(F.lit(str(day)).alias("date"), F.lit(4).alias("resolution"), _sorted(("h3", F.col("aircraft").alias("n"), F.col("affected").alias("b")), "h3").alias("cells")))


def timeline_file(line: DataFrame, day: dt.date) -> DataFrame:
    t = line.select(iso(F.col("hour")).alias("hour"), "n_aircraft", "n_affected")
    return _one(t, "timeline.json", F.struct(*_span(day), _sorted(("hour", "n_aircraft", "n_affected"), "hour").alias("hours")))


def details(hourly: DataFrame, wanted: DataFrame, top: int = MAX_CELL_AIRCRAFT) -> DataFrame:
    """All that is told of each wanted cell (h3, resolution): totals, hours, histogram, altitudes, accuracy and its worst aircraft."""
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("resolution"), grid.parent(F.col("h3"), r).alias("cell")) for r in RESOLUTIONS))).alias("to")
    rows = hourly.select("*", each).withColumn("h3", F.col("to.cell")).drop("to").join(F.broadcast(wanted.select("h3")), "h3", "left_semi")
    a, h = settled(by_aircraft(rows, "h3")), by_aircraft(rows, "h3", "hour").groupBy("h3", "hour").agg(F.count("*").alias("n_aircraft"), F.count_if("affected").alias("n_affected"))
    base = serve.by_cell(a, 0).drop("bad")
    rank = F.row_number().over(Window.partitionBy("h3").orderBy(F.desc("affected"), "min_nic", F.desc("n_reports"), "icao24"))
    listed = a.select("*", rank.alias("rank")).where(F.col("rank") <= top).select("h3", "rank", serve.hidden("icao24"), serve.hidden("callsign"), "n_reports", "n_bad_reports", "min_nic", "affected", "anonymous")
    who = listed.groupBy("h3").agg(_sorted(("icao24", "callsign", "n_reports", "n_bad_reports", "min_nic", "affected", "anonymous"), "rank").alias("aircraft"))
    sums = a.groupBy("h3").agg(F.array(*(F.sum(F.get("nic_hist", F.lit(k))) for k in range(12))).alias("nic_histogram"), F.sum("n_bad_reports").alias("bad_reports"), F.sum("n_low_bad_reports").alias("low_bad_reports"), F.count_if(F.col("n_nacp_reports") > 0).alias("nacp_total"), F.expr(f"count_if({serve.NACP_BAD})").alias("nacp_bad"), F.expr(f"count_if({serve.NACP_BAD} and affected)").alias("nacp_both"))
    top_hour = F.max_by(F.struct("hour", "n_affected"), F.struct("n_affected", -F.unix_seconds("hour"))).alias("peak")
    hours = h.groupBy("h3").agg(top_hour, _sorted((iso(F.col("hour")).alias("hour"), "n_aircraft", "n_affected"), "hour").alias("hours"))
    return wanted.select("h3", "resolution").join(base, "h3").join(who, "h3").join(sums, "h3").join(hours, "h3")


def detail_files(details: DataFrame, day: dt.date, places: DataFrame | None = None) -> DataFrame:
    """cells/<h3>.json for each cell."""
    d = details
    if places is None:
        d = d.withColumn("place", F.lit(None).cast("struct<kind: string, id: string, name: string>"))
    else:
        of = None
        for res in RESOLUTIONS:
            part = regions.place_of_cells(d.where(F.col("resolution") == res), places, res)
            of = part if of is None else of.unionByName(part)
        named = of.join(places.select("ord", F.struct("kind", "id", "name").alias("place")), "ord").select(F.col("cell").alias("h3"), "place")
        d = d.join(named, "h3", "left")
    altitude = F.struct(F.lit(LOW_ALT_FT).alias("low_alt_ft"), "n_total_cruise", "n_bad_cruise", "level_cruise", "bad_reports", "low_bad_reports").alias("altitude")
    accuracy = F.struct(F.lit(BAD_NACP_BELOW).alias("bad_below"), F.col("nacp_total").alias("n_total"), F.col("nacp_bad").alias("n_bad"), F.col("nacp_both").alias("n_bad_both")).alias("nacp")
    peak = F.when(F.col("peak.n_affected") > 0, iso(F.col("peak.hour"))).alias("peak_hour")
    body = F.struct(grid.text(F.col("h3")).alias("h3"), "resolution", "place", *_span(day), "n_total", "n_bad", "ratio_bad", "level", peak, "hours", "nic_histogram", altitude, accuracy, "aircraft")
    return d.select(F.concat(F.lit("cells/"), grid.text(F.col("h3")), F.lit(".json")).alias("path"), F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def day_cells(hourly: DataFrame, box: Box | None) -> dict[int, DataFrame]:
    """The region's cells of every served resolution."""
    return {r: regions.centred(serve.cells(hourly, r, MAX_BAD_AIRCRAFT), box, r) for r in RESOLUTIONS}


def selected(cells: dict[int, DataFrame], limit: int = MAX_DETAIL_CELLS) -> DataFrame:
    """(h3, resolution, n_total, n_bad) of the cells with details, of all resolutions together."""
    rows = None
    for r, c in cells.items():
        part = c.select("h3", F.lit(r).alias("resolution"), "n_total", "n_bad", "level")
        rows = part if rows is None else rows.unionByName(part)
    return serve.detail_cells(rows, limit)


def export_day(hourly: DataFrame, day: dt.date, folder: str, places: DataFrame, firs: DataFrame, box: Box | None = regions.MAP_REGION, limit: int = MAX_DETAIL_CELLS, extra: DataFrame | None = None) -> dict:
    """Writes all files of a day below folder/<day>, its manifest last; extra: further (path, body) rows, such as events. Returns the manifest."""
    refuse_world(box, folder)
    spark, target = hourly.sparkSession, f"{folder.rstrip('/')}/{day}"
    start, end = f"{day} 00:00:00", f"{day + dt.timedelta(days=1)} 00:00:00"
    hourly = settled(regions.in_hours(hourly, start, end))
    cells = {r: settled(c) for r, c in day_cells(hourly, box).items()}
    out = timeline_file(serve.filled(serve.timeline(hourly), start, end), day)
    for part in (*(cell_file(c, day, r) for r, c in cells.items()), analytics_file(cells[4], day, firs, places), route_file(regions.centred(serve.route_hours(hourly, 4), box, 4), day), detail_files(details(hourly, settled(selected(cells, limit))), day, places)):
        out = out.unionByName(part)
    if extra is not None:
        out = out.unionByName(extra)
    written = settled(files.write_documents(out, target))
    n = written.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).first()
    manifest = {"files": n["files"], "bytes": n["bytes"], "source": SOURCE, "license": "ODbL-1.0", "algorithm_version": ALGORITHM_VERSION}
    files.put(f"{target}/manifest.json", json.dumps(manifest, separators=(",", ":")).encode())
    return manifest


def event_files(payload: DataFrame, spoofing: DataFrame, day: dt.date) -> DataFrame:
    """events.json and spoofing.json as (path, body) rows."""
    counts = spoofing.groupBy("confidence").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("confidence", "n")))).alias("by_confidence")).withColumn("_one", F.lit(1))
    listed = spoofing.agg(F.count("*").alias("count"), _sorted(tuple(spoofing.columns), "start").alias("events")).withColumn("_one", F.lit(1))
    body = F.struct(F.lit(str(day)).alias("date"), "count", "by_confidence", "events")
    rows = listed.join(counts, "_one").select(F.lit("spoofing.json").alias("path"), F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))
    return payload.select(F.lit("events.json").alias("path"), F.to_json(F.struct(*payload.columns), {"ignoreNullFields": "false"}).alias("body")).unionByName(rows)


def range_file(hourly: DataFrame) -> DataFrame:
    """data-range.json: the first and last hour of all data, null where there is none."""
    return serve.data_range(hourly).select(F.lit("data-range.json").alias("path"), F.to_json(F.struct(iso(F.col("first_hour")).alias("first_hour"), iso(F.col("last_hour")).alias("last_hour")), {"ignoreNullFields": "false"}).alias("body"))
