"""Aircraft with faulty avionics, found by comparison with their peers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..schema import CLEAN_PEER_SHARE, FAULTY_SHARE, MIN_CLEAN_BUCKETS, MIN_PEERS
from .rollup import by_aircraft


def peers(hourly: DataFrame) -> DataFrame:
    """Per (hour, coarse cell, aircraft): affected, its peers, how many of them are affected, and whether the bucket is clean.

    The bucket's sums come from an aggregate joined back, so no bucket is
    gathered in a window.
    """
    a = by_aircraft(hourly.withColumn("h3", grid.parent(F.col("h3"), 3)), "hour", "h3").select("hour", "h3", "icao24", "affected")
    b = a.groupBy("hour", "h3").agg(F.count("*").alias("n"), F.count_if("affected").alias("k"))
    a = a.join(b, ["hour", "h3"]).select("hour", "h3", "icao24", "affected", (F.col("n") - 1).alias("peers"), (F.col("k") - F.col("affected").cast("long")).alias("affected_peers"))
    return a.withColumn("clean", (F.col("peers") >= MIN_PEERS) & (F.col("affected_peers") <= CLEAN_PEER_SHARE * F.col("peers")))


def verdicts(hourly: DataFrame) -> DataFrame:
    v = peers(hourly).groupBy("icao24").agg(F.count("*").alias("buckets"), F.count_if("clean").alias("clean_buckets"), F.count_if(F.col("clean") & F.col("affected")).alias("bad_in_clean"))
    return v.withColumn("faulty", (F.col("clean_buckets") >= MIN_CLEAN_BUCKETS) & (F.col("bad_in_clean") >= FAULTY_SHARE * F.col("clean_buckets")))


def report(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(F.count("*").alias("assessed"), F.count_if(F.col("clean_buckets") >= MIN_CLEAN_BUCKETS).alias("decidable"), F.count_if("faulty").alias("faulty"))
