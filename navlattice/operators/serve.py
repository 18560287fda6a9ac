"""Cells, timelines and the details of a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid, stats
from ..schema import MAX_BAD_AIRCRAFT, MAX_CELL_AIRCRAFT, MAX_DETAIL_CELLS, NIC_BINS
from .rollup import by_aircraft, distinct_reports, of_aircraft

CRUISE = "n_reports > n_low_reports"
CRUISE_BAD = f"{CRUISE} and 2 * (n_bad_reports - n_low_bad_reports) >= n_reports - n_low_reports"
NACP_BAD = "n_nacp_reports > 0 and 2 * n_low_nacp_reports >= n_nacp_reports"


def hidden(column: str) -> Column:
    """null for aircraft of a privacy programme."""
    return F.when(~F.col("anonymous"), F.col(column)).alias(column)


def without(hourly: DataFrame, faulty: DataFrame) -> DataFrame:
    """The rollup without aircraft that carry faulty avionics."""
    return hourly.join(faulty.select("icao24"), "icao24", "left_anti")


def by_cell(aircraft: DataFrame, top: int = MAX_BAD_AIRCRAFT) -> DataFrame:
    """Per cell of (h3, icao24) sums: aircraft, affected ones (all reports; those at cruise), the worst ones, level, confidence, ratio.

    Only affected aircraft are ranked, and each list keeps its `top`: the rank's
    limit holds before the shuffle, so no cell's aircraft meet in one task.
    """
    n, k = F.col("n_total"), F.col("n_bad")
    out = aircraft.groupBy("h3").agg(F.count("*").alias("n_total"), F.count_if("affected").alias("n_bad"), F.expr(f"count_if({CRUISE})").alias("n_total_cruise"), F.expr(f"count_if({CRUISE_BAD})").alias("n_bad_cruise"))
    order = Window.partitionBy("h3").orderBy("min_nic", "icao24")
    worst = aircraft.where("affected").select("h3", "min_nic", "icao24", "callsign", "anonymous", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
    worst = worst.groupBy("h3").agg(F.array_sort(F.collect_list(F.struct("min_nic", "rank", hidden("icao24"), hidden("callsign"), "anonymous"))).alias("bad"))
    out = out.join(worst, "h3", "left").withColumn("bad", F.coalesce("bad", F.filter(F.array(F.struct(*(F.lit(None).cast(t).alias(c) for c, t in (("min_nic", "smallint"), ("rank", "int"), ("icao24", "string"), ("callsign", "string"), ("anonymous", "boolean"))))), lambda x: F.lit(False))))
    return out.withColumns({"level": stats.level(n, k), "confidence": stats.confidence(n, k), "ratio_bad": stats.ratio(k, n), "level_cruise": stats.level(F.col("n_total_cruise"), F.col("n_bad_cruise"))})


def cells(hourly: DataFrame, res: int, top: int = MAX_BAD_AIRCRAFT) -> DataFrame:
    """Cells of one resolution from the rollup."""
    return by_cell(by_aircraft(hourly.withColumn("h3", grid.parent(F.col("h3"), res)), "h3"), top)


def cells_of_reports(positions: DataFrame, res: int, top: int = MAX_BAD_AIRCRAFT) -> DataFrame:
    """Cells of one resolution from the reports themselves, without a rollup between."""
    return by_cell(of_aircraft(positions, "h3", res=res), top)


def timeline_of_reports(positions: DataFrame) -> DataFrame:
    """The timeline from the reports themselves; hours without reports are left out."""
    return of_aircraft(positions, "hour").groupBy("hour").agg(F.count("*").alias("n_aircraft"), F.count_if("affected").alias("n_affected"))


def timeline(hourly: DataFrame) -> DataFrame:
    """Per hour: aircraft and affected ones over all cells."""
    return by_aircraft(hourly, "hour").groupBy("hour").agg(F.count("*").alias("n_aircraft"), F.count_if("affected").alias("n_affected"))


def filled(line: DataFrame, start: str, end: str) -> DataFrame:
    """The timeline with zeros for the hours of [start, end) it lacks."""
    hours = line.sparkSession.range(1).select(F.explode(F.expr(f"sequence(date_trunc('hour', timestamp'{start}'), timestamp'{end}' - interval 1 microsecond, interval 1 hour)")).alias("hour"))
    return hours.join(line, "hour", "left").select("hour", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_aircraft", "n_affected")))


def route_hours(hourly: DataFrame, res: int) -> DataFrame:
    """Per cell: dense arrays over the hours of the day with aircraft and affected ones."""
    a = by_aircraft(hourly.withColumn("h3", grid.parent(F.col("h3"), res)), "h3", "hour")
    at = [F.hour("hour") == h for h in range(24)]
    return a.groupBy("h3").agg(F.array(*(F.count_if(x) for x in at)).alias("aircraft"), F.array(*(F.count_if(x & F.col("affected")) for x in at)).alias("affected"))


def of_cell(hourly: DataFrame, cell: Column, res: int) -> DataFrame:
    return hourly.where(grid.parent(F.col("h3"), res) == cell)


def cell_aircraft(part: DataFrame, limit: int = MAX_CELL_AIRCRAFT) -> DataFrame:
    """The aircraft of one cell, affected and worst first, with totals over all of them: one row of sums beside the `limit` rows."""
    a = by_aircraft(part)
    total = a.agg(F.count("*").alias("n_total"), F.count_if("affected").alias("n_bad")).withColumn("_one", F.lit(1))
    a = a.orderBy(F.desc("affected"), "min_nic", F.desc("n_reports"), "icao24").limit(limit).withColumn("_one", F.lit(1))
    return a.join(F.broadcast(total), "_one").select(hidden("icao24"), hidden("callsign"), "n_reports", "n_bad_reports", "min_nic", "anonymous", "affected", "n_total", "n_bad")


def nic_histogram(part: DataFrame) -> DataFrame:
    return part.agg(*(F.coalesce(F.sum(F.get("nic_hist", F.lit(k))), F.lit(0)).alias(f"nic_{k}") for k in range(NIC_BINS)))


def padded(hist: Column) -> Column:
    """A histogram of NIC_BINS bins, whatever its length; null counts as none."""
    return F.slice(F.concat(F.coalesce(hist, F.array().cast("array<bigint>")), F.array_repeat(F.lit(0).cast("bigint"), NIC_BINS)), 1, NIC_BINS)


def nic_histogram_of_reports(positions: DataFrame, cell: Column, res: int) -> DataFrame:
    """The histogram of one cell from its reports, for archives whose rollup has none."""
    r = distinct_reports(positions).where(grid.parent(F.col("h3"), res) == cell)
    return r.agg(*(F.count_if(F.least("nic", F.lit(NIC_BINS - 1).cast("tinyint")) == k).alias(f"nic_{k}") for k in range(NIC_BINS)))


def nic_histogram_or_reports(part: DataFrame, positions: DataFrame, cell: Column, res: int) -> DataFrame:
    """The rollup's histogram of a cell, or that of its reports where the rollup's is all zero; the reports are read in that case only."""
    stored = nic_histogram(part)
    empty = sum(F.col(f"nic_{k}") for k in range(NIC_BINS)) == 0
    return nic_histogram_of_reports(positions, cell, res) if stored.where(empty).head(1) else stored


def altitude(part: DataFrame) -> DataFrame:
    a = by_aircraft(part)
    return a.agg(F.expr(f"count_if({CRUISE})").alias("n_total_cruise"), F.expr(f"count_if({CRUISE_BAD})").alias("n_bad_cruise"), F.sum("n_bad_reports").alias("bad_reports"), F.sum("n_low_bad_reports").alias("low_bad_reports"))


def nacp(part: DataFrame) -> DataFrame:
    a = by_aircraft(part)
    return a.agg(F.count_if(F.col("n_nacp_reports") > 0).alias("n_total_nacp"), F.expr(f"count_if({NACP_BAD})").alias("n_bad_nacp"), F.expr(f"count_if({NACP_BAD} and affected)").alias("n_bad_both"))


def data_range(hourly: DataFrame) -> DataFrame:
    return hourly.agg(F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"), F.count("*").alias("n_rows"))


def peak_hours(hourly: DataFrame, res: int) -> DataFrame:
    """Per cell: the first hour with most affected aircraft, null where none is affected."""
    hours = by_aircraft(hourly.withColumn("h3", grid.parent(F.col("h3"), res)), "h3", "hour").groupBy("h3", "hour").agg(F.count_if("affected").alias("n"))
    peak = F.max_by(F.struct("hour", "n"), F.struct("n", -F.unix_seconds("hour")))
    return hours.groupBy("h3").agg(peak.alias("p")).select("h3", F.when(F.col("p.n") > 0, F.col("p.hour")).alias("peak_hour"), F.col("p.n").alias("n_affected"))


def detail_cells(cells: DataFrame, limit: int = MAX_DETAIL_CELLS) -> DataFrame:
    """The cells, of any resolutions together, whose details are exported: medium or high ones, most affected first."""
    return cells.where("level in ('medium', 'high')").orderBy(F.desc("n_bad"), F.desc(F.col("n_bad") / F.col("n_total")), grid.text(F.col("h3"))).limit(limit)
