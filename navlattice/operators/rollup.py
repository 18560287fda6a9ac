"""Eligible reports, the hourly rollup and its coarser forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..schema import ADSB_SOURCES, BAD_NACP_BELOW, BAD_NIC_BELOW, LOW_ALT_FT, NIC_BINS, RESOLUTIONS

COUNTS = ("n_reports", "n_bad_reports", "n_low_reports", "n_low_bad_reports", "n_nacp_reports", "n_low_nacp_reports")


def is_adsb(source: Column) -> Column:
    return F.substring_index(source, ":", -1).isin(*ADSB_SOURCES) | (source == "unknown")


def eligible(positions: DataFrame) -> DataFrame:
    return positions.where(~F.col("on_ground") & F.col("nic").isNotNull() & is_adsb(F.col("source")))


def last_named(order: str) -> Column:
    return F.expr(f"max_by(callsign, struct({order}, callsign)) filter (where callsign <> '')")


def distinct_reports(positions: DataFrame) -> DataFrame:
    """Eligible reports with hour and cell; those that repeat an (icao24, ts) count once, the one with the smallest (lat, lon).

    The exchange on (icao24, hour) serves the aggregations that follow on these keys.
    """
    r = eligible(positions).select("icao24", "ts", F.date_trunc("hour", "ts").alias("hour"), "lat", "lon", "callsign", "nic", "nac_p", "alt_baro_ft", "anonymous")
    r = r.repartition("icao24", "hour").groupBy("icao24", "hour", "ts").agg(F.min(F.struct("lat", "lon", "nic", "nac_p", "alt_baro_ft", "callsign", "anonymous")).alias("r"))
    return r.select("icao24", "hour", "ts", "r.*").withColumn("h3", grid.cell(F.col("lat"), F.col("lon")))


def measures(histogram: bool = True) -> list[Column]:
    """The measures of the rollup over distinct reports."""
    bad, low = F.col("nic") < BAD_NIC_BELOW, F.coalesce(F.col("alt_baro_ft") < LOW_ALT_FT, F.lit(False))
    return [
        last_named("ts").alias("callsign"), F.count("*").alias("n_reports"), F.count_if(bad).alias("n_bad_reports"), F.min("nic").cast("smallint").alias("min_nic"), F.max("anonymous").alias("anonymous"), F.count_if(low).alias("n_low_reports"), F.count_if(low & bad).alias("n_low_bad_reports"),
        F.count("nac_p").alias("n_nacp_reports"), F.count_if(F.col("nac_p") < BAD_NACP_BELOW).alias("n_low_nacp_reports"),
        *([F.array(*(F.count_if(F.least("nic", F.lit(NIC_BINS - 1).cast("tinyint")) == k) for k in range(NIC_BINS))).alias("nic_hist")] if histogram else []),
    ]


def rollup(positions: DataFrame) -> DataFrame:
    """(hour, h3, icao24) with counts, the least NIC, the last callsign and the NIC histogram."""
    return distinct_reports(positions).groupBy("hour", "h3", "icao24").agg(*measures())


def of_aircraft(positions: DataFrame, *keys: str, res: int = 5) -> DataFrame:
    """Sums of the reports by the keys and aircraft, with whether it is affected; the cell is one of resolution `res`."""
    r = distinct_reports(positions).withColumn("h3", grid.parent(F.col("h3"), res))
    return r.groupBy(*keys, "icao24").agg(*measures(False)).withColumn("affected", 2 * F.col("n_bad_reports") >= F.col("n_reports"))


def _merged() -> list[Column]:
    return [last_named("hour").alias("callsign"), *(F.sum(c).alias(c) for c in COUNTS), F.min("min_nic").alias("min_nic"), F.max("anonymous").alias("anonymous"), F.array(*(F.sum(F.coalesce(F.get("nic_hist", F.lit(k)), F.lit(0))) for k in range(NIC_BINS))).alias("nic_hist")]


def coarsen(hourly: DataFrame, res: int) -> DataFrame:
    """The rollup at a coarser resolution: sums by (hour, parent, icao24)."""
    return hourly.withColumn("h3", grid.parent(F.col("h3"), res)).groupBy("hour", "h3", "icao24").agg(*_merged())


def resolutions(hourly: DataFrame, wanted: tuple[int, ...] = RESOLUTIONS) -> DataFrame:
    """The rollup at several resolutions in one pass and one exchange: (resolution, hour, h3, icao24)."""
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("resolution"), grid.parent(F.col("h3"), r).alias("h3")) for r in wanted))).alias("to")
    rows = hourly.select("hour", "icao24", "callsign", *COUNTS, "min_nic", "anonymous", "nic_hist", each).withColumns({"resolution": F.col("to.resolution"), "h3": F.col("to.h3")})
    return rows.groupBy("resolution", "hour", "h3", "icao24").agg(*_merged())


def by_aircraft(hourly: DataFrame, *keys: str) -> DataFrame:
    """Sums of the rollup by the keys and aircraft, with whether it is affected: half of its reports or more are bad."""
    out = hourly.groupBy(*keys, "icao24").agg(*_merged())
    return out.withColumn("affected", 2 * F.col("n_bad_reports") >= F.col("n_reports"))
