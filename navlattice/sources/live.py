"""The live interface: circles that cover a box, polled and joined into snapshots."""

from __future__ import annotations

import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.regions import Box, contains
from . import ingest

# Fixed values.
MAX_RADIUS_NM, NM_PER_DEGREE = 250, 60.0


def cover(box: Box, radius_nm: float = MAX_RADIUS_NM) -> list[tuple[float, float]]:
    """Centres of circles that cover a box: rows of squares inscribed in the circles, wider in degrees toward the poles."""
    south, west, north, east = box
    high = radius_nm * math.sqrt(2) / NM_PER_DEGREE
    rows = max(0, math.ceil((north - south) / high))
    centres = []
    for i in range(rows):
        lat = south + (i + 0.5) * high
        wide = high / max(math.cos(math.radians(lat)), 0.1)
        centres += [(round(lat, 3), round(west + (j + 0.5) * wide, 3)) for j in range(max(0, math.ceil((east - west) / wide)))]
    return centres


def fetch(url: str, opened: Callable = urllib.request.urlopen, retries: int = 3, sleep: Callable = time.sleep) -> dict:
    """One answer of the interface; a refusal for being too fast is waited out as long as it asks."""
    for attempt in range(retries + 1):
        try:
            with opened(url) as response:
                return json.load(response)
        except urllib.error.HTTPError as e:
            if e.code != 429 or attempt == retries:
                raise
            sleep(float(e.headers.get("Retry-After") or 2 ** (attempt + 1)))
    raise AssertionError


def poll(box: Box, url_of: Callable[[float, float, float], str], get: Callable[[str], dict] = fetch, radius_nm: float = MAX_RADIUS_NM, now: Callable[[], float] = time.time) -> list[tuple[int, float, str]]:
    """(circle, epoch seconds, answer) of all circles; one that fails is left out, the others count."""
    out = []
    for i, (lat, lon) in enumerate(cover(box, radius_nm)):
        at = now()
        try:
            out.append((i, at, json.dumps(get(url_of(lat, lon, radius_nm)))))
        except OSError as e:
            print(f"circle {lat},{lon}: {e}")
    return out


def snapshot(answers: DataFrame, box: Box) -> DataFrame:
    """Positions of one or more snapshots (snapshot_id, circle, now, answer): the first circle that has an aircraft counts, then the box."""
    found = ingest.live(answers.withColumnRenamed("answer", "snapshot"), keep=("snapshot_id", "circle"))
    found = found.where("icao24 <> ''").groupBy("snapshot_id", "icao24").agg(F.min_by(F.struct(*found.columns), F.struct("circle", "at")).alias("r")).select("r.*")
    return found.where(contains(box, F.col("lat"), F.col("lon"))).drop("circle", "at")


def answers(spark: SparkSession, rows: list[tuple[int, float, str]], snapshot_id: int = 0) -> DataFrame:
    """What one poll brought, a row a circle."""
    return spark.createDataFrame([(snapshot_id, i, at, body) for i, at, body in rows], "snapshot_id int, circle int, now double, answer string")
