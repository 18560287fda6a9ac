"""Where positions come from, and on what terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, name string, data_type string, source_class string, license string, attribution string, share_alike boolean, commercial_use boolean, agreed boolean"
# The known sources.
SOURCES = (
    ("adsblol", "daily archive and live interface", "T1", "open", "ODbL-1.0", "adsb.lol (ODbL)", True, True, False),
    ("opensky", "OpenSky Network", "T1", "agreement", "non-commercial", "", False, False, False),
    ("adsbfi", "adsb.fi", "T1", "agreement", "personal, non-commercial", "", False, False, False),
    ("airplaneslive", "airplanes.live", "T1", "agreement", "personal, non-commercial", "", False, False, False),
    ("adsbx", "ADS-B Exchange", "T1", "closed", "paid", "", False, False, False),
)


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, SCHEMA)


def source_key(source: Column) -> Column:
    """The source of a label: what stands before its first colon."""
    return F.substring_index(source, ":", 1)


def collectable(sources: DataFrame) -> DataFrame:
    """The sources that may be collected: open ones, and those with an agreement."""
    return sources.where((F.col("source_class") == "open") | F.col("agreed"))


def licensed(positions: DataFrame) -> DataFrame:
    """The positions of collectable sources."""
    keys = collectable(sources(positions.sparkSession)).select(F.col("key").alias("_key"))
    return positions.join(F.broadcast(keys), source_key(F.col("source")) == F.col("_key"), "left_semi")
