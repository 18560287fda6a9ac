"""Positions derived from the `events` table (FIXTURES.md, section 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", "props")
    us = "unix_micros(cast(ts as timestamp)) - 1704067200000000"
    e = e.selectExpr("event_id", "user_id", "event_type", "value", f"({us}) div 30000 as ts_ms", "cast(get_json_object(props, '$.k') as int) as k", "user_id % 3 as zone")
    e = e.withColumn("hr", F.expr("ts_ms div 3600000"))
    return e.selectExpr(
        "timestamp_millis(1704067200000 + ts_ms) as ts",
        "lpad(lower(hex(user_id)), 6, '0') as icao24",
        "case zone when 0 then 41e0 when 1 then 34e0 else 50e0 end + ((event_id*7919)%1000)*2e-4 + case when event_type='error' and k<20 then 2e0 else 0e0 end as lat",
        "case zone when 0 then 29e0 when 1 then 35e0 else 8e0 end + ((event_id*104729)%1000)*2e-4 as lon",
        "cast(case when k=98 then null else value*500e0 end as float) as alt_baro_ft",
        "cast(null as float) as alt_geom_ft", "cast(null as float) as gs_kt", "cast(null as float) as track",
        "case when k%3=0 then null else concat('CS', user_id) end as callsign",
        "cast(case when k=99 then null when user_id%17=0 then k%4 when zone=1 and hr between 6 and 17 and k<60 then k%5 when k<2 then 4 else 7+k%5 end as tinyint) as nic",
        "cast(case when k%10=9 then null else 6+k%5 end as tinyint) as nac_p",
        "cast(null as tinyint) as sil", "cast(null as float) as nic_age_s",
        "case when k between 90 and 94 then 'adsblol:mlat' when k=95 then 'unknown' when k%2=0 then 'adsblol:adsb_icao' else 'adsblol:adsb_icao_nt' end as source",
        "event_type='signup' and k<10 as on_ground", "user_id%23=0 as anonymous",
    )


def _square(west: float, south: float, east: float, north: float) -> list:
    return [(west, south), (east, south), (east, north), (west, north), (west, south)]


#: Regions and places round the fixture's three zones: (kind, id, polygons of rings, the first the outer one).
FIRS = (
    ("fir", "FAAA", [[_square(28.5, 40.5, 29.125, 41.25)]]),
    ("fir", "FBBB", [[_square(34.75, 33.5, 35.5, 34.125), _square(35.0, 34.0, 35.0625, 34.0625)], [_square(35.0, 35.5, 36.0, 36.5)]]),
    ("fir", "FCCC", [[[(7.5, 49.5), (8.5, 49.5), (8.1, 50.5), (7.5, 49.5)]]]),
    ("fir", "FDDD", [[_square(28.5, 40.5, 29.5, 43.5)]]),
)
PLACES = (
    ("sea", "Wide Sea", [[_square(34.5, 33.0, 36.5, 35.0)]]),
    ("country", "Firstland", [[_square(28.9, 40.9, 29.1, 41.1)]]),
    ("country", "Secondland", [[_square(28.0, 40.0, 30.0, 44.0)]]),
    ("sea", "Narrow Sea", [[_square(34.9, 33.9, 35.1, 34.2)]]),
    ("country", "Thirdland", [[_square(7.9, 49.9, 8.1, 50.1), _square(7.95, 49.95, 8.05, 50.05)]]),
)


def shapes(spark: SparkSession, which: tuple) -> DataFrame:
    """A small dimension of places with their bounds and areas."""
    from . import dimensions

    rows = [(i, kind, name, name, polygons) for i, (kind, name, polygons) in enumerate(which)]
    return dimensions.bounded(spark.createDataFrame(rows, f"ord int, kind string, id string, name string, polygons {dimensions.POLYGONS}"))


def trace_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document): the fixture's positions as one trace document an aircraft; every fourth point carries details."""
    p = positions(spark, sf_dir).selectExpr("icao24", "unix_millis(ts) - 1704067200000 as ms", "lat", "lon", "alt_baro_ft", "on_ground", "callsign", "nic", "nac_p", "anonymous")
    part = "concat('{', concat_ws(',', if(nic is null, null, concat('\"nic\":', nic)), if(nac_p is null, null, concat('\"nac_p\":', nac_p)), concat('\"flight\":\"', coalesce(callsign, ''), ' \"')), '}')"
    point = f"concat('[', ms / 1000e0, ',', lat, ',', lon, ',', if(on_ground, '\"ground\"', coalesce(cast(alt_baro_ft as string), 'null')), ',null,null,0,null,', if(ms % 4 = 0, {part}, 'null'), ',', if(ms % 7 = 0, 'null', '\"adsb_icao\"'), ']')"
    p = p.selectExpr("icao24", "anonymous", "ms", "lat", "lon", f"{point} as point")
    docs = p.groupBy("icao24").agg(F.max("anonymous").alias("anonymous"), F.array_sort(F.collect_list(F.struct("ms", "lat", "lon", "point"))).alias("points"))
    return docs.selectExpr("concat('{\"icao\":\"~', upper(icao24), '\",\"timestamp\":1704067200,\"dbFlags\":', if(anonymous, 9, 1), ',\"trace\":[', array_join(transform(points, x -> x.point), ','), ']}') as document")


def live_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(snapshot_id, circle, now, answer): the events as answers of a live interface, 200 events a snapshot in three circles."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "user_id", "event_type", "value", "cast(get_json_object(props, '$.k') as int) as k")
    one = "concat('{\"hex\":\"', upper(lower(hex(user_id % 40))), '\"', if(k = 7, '', concat(',\"lat\":', 28 + (event_id * 7919) % 2500 / 100e0, ',\"lon\":', 15 + (event_id * 104729) % 4000 / 100e0)), ',\"seen_pos\":', k * 0.75e0, ',\"alt_baro\":', if(event_type = 'signup', '\"ground\"', cast(event_id % 40000 as string)), if(k % 3 = 0, '', concat(',\"nic\":', k % 12)), if(k % 5 = 0, '', ',\"type\":\"adsb_icao\"'), ',\"flight\":\"F', user_id, ' \",\"dbFlags\":', k % 9, '}')"
    e = e.selectExpr("cast(event_id div 200 as int) as snapshot_id", "cast(event_id % 3 as int) as circle", "event_id", f"{one} as ac")
    out = e.groupBy("snapshot_id", "circle").agg(F.array_sort(F.collect_list(F.struct("event_id", "ac"))).alias("all"))
    return out.selectExpr("snapshot_id", "circle", "1704067200e0 + snapshot_id * 90 as now", "concat('{\"ac\":[', array_join(transform(all, x -> x.ac), ','), ']}') as answer")
