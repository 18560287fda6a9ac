"""The serving tables: their definitions, rows, and loads that replace what they cover."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..schema import RESOLUTIONS
from . import rollup

#: Applied in order; each may be run again.
MIGRATIONS = (
    """
-- reports, a partition a day
CREATE TABLE IF NOT EXISTS {db}.positions (ts TIMESTAMP, icao24 STRING, lat DOUBLE, lon DOUBLE, alt_baro_ft FLOAT, alt_geom_ft FLOAT, callsign STRING, nic TINYINT, nac_p TINYINT, sil TINYINT, source STRING, on_ground BOOLEAN, anonymous BOOLEAN, h3_r5 BIGINT, day DATE) USING parquet PARTITIONED BY (day);
-- the rollup of every served resolution
CREATE TABLE IF NOT EXISTS {db}.hourly (resolution INT, hour TIMESTAMP, h3 BIGINT, icao24 STRING, callsign STRING, n_reports BIGINT, n_bad_reports BIGINT, min_nic SMALLINT, anonymous BOOLEAN, n_low_reports BIGINT, n_low_bad_reports BIGINT, n_nacp_reports BIGINT, n_low_nacp_reports BIGINT, nic_hist ARRAY<BIGINT>, day DATE) USING parquet PARTITIONED BY (day)
""",
    """
CREATE TABLE IF NOT EXISTS {db}.events (event_id STRING, type STRING, first_seen STRING, last_seen STRING, duration_hours BIGINT, cells ARRAY<STRING>, region_h3 STRING, fir STRING, firs ARRAY<STRING>, affected_aircraft BIGINT, scale STRING, confidence STRING, data_coverage STRING, evidence STRING, source STRING, algorithm_version STRING, anonymous BOOLEAN, day DATE) USING parquet PARTITIONED BY (day)
""",
)


def statements(text: str) -> list[str]:
    """The statements of a script: comments go, semicolons outside quotes part them."""
    bare = re.sub(r"('(?:[^']|'')*')|--[^\n]*", lambda m: m[1] or "", text)
    return [s.strip() for s in re.findall(r"(?:'(?:[^']|'')*'|[^;'])+", bare) if s.strip()]


def migrate(spark: SparkSession, database: str = "navlattice", scripts: tuple[str, ...] = MIGRATIONS) -> int:
    """Creates what is missing; returns how many statements ran."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    todo = [s for script in scripts for s in statements(script.replace("{db}", database))]
    for s in todo:
        spark.sql(s)
    return len(todo)


def query(spark: SparkSession, sql: str, **arguments) -> DataFrame:
    """A query with bound parameters (:name): values never become part of the text."""
    return spark.sql(sql, args=arguments)


def position_rows(positions: DataFrame) -> DataFrame:
    """Positions as rows of the serving table: addresses of six characters, the finest cell, the day."""
    address = F.lpad(F.substring("icao24", 1, 6), 6, "0").alias("icao24")
    return positions.select("ts", address, "lat", "lon", "alt_baro_ft", "alt_geom_ft", "callsign", "nic", "nac_p", "sil", "source", "on_ground", "anonymous", grid.cell(F.col("lat"), F.col("lon")).alias("h3_r5"), F.to_date("ts").alias("day"))


def hourly_rows(hourly: DataFrame, resolutions: tuple[int, ...] = RESOLUTIONS) -> DataFrame:
    """The rollup as rows of the serving table, all resolutions in one pass."""
    r = rollup.resolutions(hourly, resolutions)
    return r.select("resolution", "hour", "h3", "icao24", "callsign", "n_reports", "n_bad_reports", "min_nic", "anonymous", "n_low_reports", "n_low_bad_reports", "n_nacp_reports", "n_low_nacp_reports", "nic_hist", F.to_date("hour").alias("day"))


def event_rows(events: DataFrame) -> DataFrame:
    """Events as rows of the serving table; nested parts become JSON, empty where there are none."""
    text = lambda c: F.coalesce(F.to_json(c), F.lit("")).alias(c)
    plain = [c for c in events.columns if c not in ("data_coverage", "evidence")]
    at = plain.index("confidence") + 1
    return events.select(*plain[:at], text("data_coverage"), text("evidence"), *plain[at:], F.to_date(F.substring("first_seen", 1, 10)).alias("day"))


def replace_days(rows: DataFrame, table: str) -> None:
    """Writes rows to a table, in place of what its days had: a load that runs again changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)
