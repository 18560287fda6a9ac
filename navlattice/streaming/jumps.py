"""Jumps and their sessions over a stream: the last report of every aircraft is its state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.stats import haversine_nm
from ..schema import EVENT_GAP_S, MAX_GAP_S, MIN_DIST_NM, MIN_GAP_S, MIN_SPEED_KT

_REPORT = "t double, lat double, lon double, nic int, mlat boolean, ground boolean, anonymous boolean"
_PAIRS = "icao24 string, before_ts double, before_lat double, before_lon double, before_nic int, after_ts double, after_lat double, after_lon double, after_nic int, anonymous boolean"
_SESSION = "icao24 string, session long, start double, end double, jumps long"


def _pairs(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Each report beside the one before it; a report older than the last one seen is late and left to the daily batch."""
    if state.hasTimedOut:
        state.remove()
        return
    reports = pd.concat(frames, ignore_index=True).sort_values(["t", "lat", "lon"], kind="stable")
    if state.exists:
        last = pd.DataFrame([state.get], columns=["t", "lat", "lon", "nic", "mlat", "ground", "anonymous"])
        reports = pd.concat([last, reports[reports["t"] >= last["t"][0]][last.columns]], ignore_index=True)
    a, b = reports.iloc[:-1].reset_index(drop=True), reports.iloc[1:].reset_index(drop=True)
    fine = ~(a["mlat"] | b["mlat"] | a["ground"] | b["ground"]).astype(bool)
    end = reports.iloc[-1]
    state.update((float(end["t"]), float(end["lat"]), float(end["lon"]), None if pd.isna(end["nic"]) else int(end["nic"]), bool(end["mlat"]), bool(end["ground"]), bool(end["anonymous"])))
    state.setTimeoutTimestamp(max(int((end["t"] + MAX_GAP_S + 1) * 1000), state.getCurrentWatermarkMs() + 1))
    out = pd.DataFrame({"icao24": key[0], "before_ts": a["t"], "before_lat": a["lat"], "before_lon": a["lon"], "before_nic": a["nic"], "after_ts": b["t"], "after_lat": b["lat"], "after_lon": b["lon"], "after_nic": b["nic"], "anonymous": (a["anonymous"] | b["anonymous"]).astype(bool)})
    yield out[fine].astype({"before_nic": "Int32", "after_nic": "Int32"})


def jumps(positions: DataFrame, late: str = "3 hours") -> DataFrame:
    """Jumps as they happen: pairs of consecutive reports of an aircraft that no aircraft can have flown. State is one report an aircraft, dropped once no pair with it can count."""
    p = positions.withWatermark("ts", late).select("ts", "icao24", (F.unix_millis("ts") / 1000).alias("t"), "lat", "lon", F.col("nic").cast("int").alias("nic"), (F.substring_index("source", ":", -1) == "mlat").alias("mlat"), F.col("on_ground").alias("ground"), "anonymous")
    pairs = p.groupBy("icao24").applyInPandasWithState(_pairs, _PAIRS, _REPORT, "append", GroupStateTimeout.EventTimeTimeout)
    dt = F.round(F.col("after_ts") - F.col("before_ts"), 3)
    dist = haversine_nm(F.col("before_lat"), F.col("before_lon"), F.col("after_lat"), F.col("after_lon"))
    found = pairs.withColumns({"dt_s": dt, "dist_nm": dist}).where(F.col("dt_s").between(MIN_GAP_S, MAX_GAP_S) & (F.col("dist_nm") >= MIN_DIST_NM))
    return found.withColumn("speed_kt", F.col("dist_nm") / (F.col("dt_s") / 3600)).where(F.col("speed_kt") > MIN_SPEED_KT)


def _sessions(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    number, start, end, count = state.get if state.exists else (0, 0.0, 0.0, 0)
    out = []
    for a, b in pd.concat(frames, ignore_index=True).sort_values(["before_ts", "after_ts"])[["before_ts", "after_ts"]].itertuples(index=False):
        if count and a - end <= EVENT_GAP_S:
            count, end = count + 1, max(end, b)
        else:
            if count:
                out.append((key[0], number, start, end, count))
            number, start, end, count = number + 1, a, b, 1
    state.update((int(number), float(start), float(end), int(count)))
    out.append((key[0], number, start, end, count))
    yield pd.DataFrame(out, columns=["icao24", "session", "start", "end", "jumps"])


def sessions(jumps: DataFrame) -> DataFrame:
    """(icao24, session, start, end, jumps) in update mode: a session's later rows replace its earlier ones. A new one begins over 600 s after the end of the last jump."""
    return jumps.groupBy("icao24").applyInPandasWithState(_sessions, _SESSION, "number long, start double, end double, jumps long", "update", GroupStateTimeout.NoTimeout)
