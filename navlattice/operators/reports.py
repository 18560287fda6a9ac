"""Summaries of a day: distributions, the effect of the avionics filter, the worst cells and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..schema import BAD_NIC_BELOW
from . import serve, verify
from .rollup import by_aircraft, is_adsb

LEVELS = ("noData", "low", "medium", "high")


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(value as text, n, share) of a column; null is a value of its own."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"), F.lit(1).alias("_one"))
    total = counts.agg(F.sum("n").alias("total")).withColumn("_one", F.lit(1))
    return counts.join(F.broadcast(total), "_one").select("value", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def sources(positions: DataFrame) -> DataFrame:
    """Airborne reports by source."""
    return distribution(positions.where(~F.col("on_ground")), "source")


def integrity(positions: DataFrame) -> DataFrame:
    """Airborne direct reports by NIC."""
    return distribution(positions.where(~F.col("on_ground") & is_adsb(F.col("source"))), "nic")


def totals(positions: DataFrame) -> DataFrame:
    """One row: airborne reports, direct ones, their aircraft, and those that ever reported a bad NIC."""
    r = positions.where(~F.col("on_ground")).withColumn("direct", is_adsb(F.col("source")))
    bad = F.col("direct") & F.coalesce(F.col("nic") < BAD_NIC_BELOW, F.lit(False))
    a = r.groupBy("icao24").agg(F.count("*").alias("n"), F.count_if("direct").alias("d"), F.bool_or(bad).alias("bad"))
    return a.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("reports"), F.coalesce(F.sum("d"), F.lit(0)).alias("direct_reports"), F.count_if(F.col("d") > 0).alias("aircraft"), F.count_if("bad").alias("bad_aircraft"))


def worst_cells(cells: DataFrame, k: int) -> DataFrame:
    return cells.where("n_bad > 0").orderBy(F.desc("n_bad"), F.desc(F.col("n_bad") / F.col("n_total")), "h3").limit(k)


def worst_events(events: DataFrame, k: int) -> DataFrame:
    return events.orderBy(F.desc("affected_aircraft"), "first_seen", "event_id").limit(k)


def worst_spoofing(spoof: DataFrame, k: int) -> DataFrame:
    return spoof.orderBy(F.desc("jumps"), "start", "icao24").limit(k)


def faulty_share(hourly: DataFrame, faulty: DataFrame) -> DataFrame:
    """One row: aircraft affected in some hour and cell, how many of them are faulty, and their share."""
    affected = by_aircraft(hourly, "hour", "h3").where("affected").select("icao24").distinct()
    both = affected.join(faulty.select("icao24").distinct().withColumn("f", F.lit(True)), "icao24", "left")
    return both.agg(F.count("*").alias("affected"), F.count("f").alias("faulty")).withColumn("share", F.round(F.coalesce(F.try_divide("faulty", "affected"), F.lit(0.0)), 6))


def filter_effect(hourly: DataFrame, faulty: DataFrame, res: int) -> tuple[DataFrame, DataFrame]:
    """How the exclusion of faulty aircraft moves levels: counts of (before, after), and the medium and high cells that change."""
    before, after = serve.cells(hourly, res), serve.cells(serve.without(hourly, faulty), res)
    b = before.select("h3", F.col("n_total").alias("total_before"), F.col("n_bad").alias("bad_before"), F.col("level").alias("before"))
    a = after.select("h3", F.col("n_total").alias("total_after"), F.col("n_bad").alias("bad_after"), F.col("level").alias("after"))
    both = b.join(a, "h3", "left").withColumns({"after": F.coalesce("after", F.lit("noData")), "total_after": F.coalesce("total_after", F.lit(0)), "bad_after": F.coalesce("bad_after", F.lit(0))})
    return verify.transitions(before, after), both.where("before <> after and before in ('medium', 'high')")


def geojson(cells: DataFrame, res: int) -> DataFrame:
    """(h3, feature): each cell as a GeoJSON feature, a closed ring of longitudes and latitudes."""
    corners = grid.boundary(F.col("h3"), res)
    ring = F.transform(F.concat(corners, F.slice(corners, 1, 1)), lambda p: F.array(F.round(p["lon"], 5), F.round(p["lat"], 5)))
    properties = F.struct(grid.text(F.col("h3")).alias("h3"), "n_total", "n_bad", "ratio_bad", "level")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"), properties.alias("properties"))
    return cells.select("h3", F.to_json(feature).alias("feature"))
