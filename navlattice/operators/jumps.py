"""Positions that jump at impossible speed, and the events they form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import haversine_nm
from ..schema import CLUSTER_NM, CONVERGENCE_DEG, CONVERGENCE_WINDOW_S, EVENT_GAP_S, GOOD_NIC, MAX_GAP_S, MIN_DIST_NM, MIN_GAP_S, MIN_JUMPS_FOR_SHARED, MIN_SPEED_KT


def jumps(positions: DataFrame) -> DataFrame:
    """Consecutive reports (of all kinds) whose distance no aircraft covers in their time; the pair must be airborne and not multilaterated."""
    w = Window.partitionBy("icao24").orderBy("ts", "lat", "lon")
    p = positions.select("icao24", F.struct("ts", "lat", "lon", "nic", "source", "on_ground", "anonymous").alias("after"), "ts", "lat", "lon")
    p = p.withColumn("before", F.lag("after").over(w)).where("before is not null")
    fine = lambda s: ~F.col(f"{s}.on_ground") & (F.substring_index(f"{s}.source", ":", -1) != "mlat")
    dt = F.unix_micros("after.ts") / 1e6 - F.unix_micros("before.ts") / 1e6
    dist = haversine_nm(F.col("before.lat"), F.col("before.lon"), F.col("after.lat"), F.col("after.lon"))
    p = p.where(fine("before") & fine("after")).select("icao24", "before", "after", F.round(dt, 3).alias("dt_s"), dist.alias("dist_nm"))
    p = p.where(F.col("dt_s").between(MIN_GAP_S, MAX_GAP_S) & (F.col("dist_nm") >= MIN_DIST_NM))
    return p.withColumn("speed_kt", F.col("dist_nm") / (F.col("dt_s") / 3600)).where(F.col("speed_kt") > MIN_SPEED_KT)


def unshared(jumps: DataFrame) -> DataFrame:
    """Without the jumps of addresses that two aircraft share: four or more whose ends lie in exactly two clusters, taken greedily in time order.

    The greedy centres are found one after the other: the first end, the first
    one far from it, the first one far from both.  Each is a minimum over the
    aircraft's jumps, which the search for jumps has brought together and in
    order already; nothing is gathered and no row moves again.
    """
    own = Window.partitionBy("icao24")
    order = ("after.ts", "before.lat", "before.lon", "after.lat", "after.lon")
    end = lambda i, side: F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), F.lit(i).alias("o5"), F.col(f"{side}.lat").alias("lat"), F.col(f"{side}.lon").alias("lon"))
    far = lambda e, c: haversine_nm(e["lat"], e["lon"], F.col(f"{c}.lat"), F.col(f"{c}.lon")) > CLUSTER_NM
    first, last = end(0, "before"), end(1, "after")
    away = lambda e: F.when(far(e, "_c1"), e)
    j = jumps.withColumns({"_n": F.count("*").over(own), "_c1": F.min(first).over(own)})
    j = j.withColumn("_c2", F.min(F.least(away(first), away(last))).over(own))
    third = (far(first, "_c1") & far(first, "_c2")) | (far(last, "_c1") & far(last, "_c2"))
    j = j.withColumn("_c3", F.max(F.coalesce(third, F.lit(False))).over(own))
    shared = (F.col("_n") >= MIN_JUMPS_FOR_SHARED) & F.col("_c2").isNotNull() & ~F.col("_c3")
    return j.where(~shared).drop("_n", "_c1", "_c2", "_c3")


def sessions(jumps: DataFrame) -> DataFrame:
    """Jumps numbered by session: a new one begins over 600 s after the last jump's end."""
    w = Window.partitionBy("icao24").orderBy("before.ts", "after.ts")
    gap = (F.unix_micros("before.ts") - F.unix_micros(F.lag("after.ts").over(w))) > EVENT_GAP_S * 1_000_000
    return jumps.withColumn("new", F.coalesce(gap, F.lit(True)).cast("int")).withColumn("session", F.sum("new").over(w)).drop("new")


def events(jumps: DataFrame) -> DataFrame:
    return events_of(sessions(jumps))


def events_of(numbered: DataFrame) -> DataFrame:
    """One row per session of numbered jumps with its confidence: high, integrity_overlap or low."""
    s = numbered.withColumns({"y": F.floor(F.col("after.lat") / CONVERGENCE_DEG), "x": F.floor(F.col("after.lon") / CONVERGENCE_DEG), "t": F.floor(F.unix_seconds("after.ts") / CONVERGENCE_WINDOW_S)})
    close = s.groupBy("y", "x", "t").agg((F.min("icao24") != F.max("icao24")).alias("converging"))
    s = s.join(close, ["y", "x", "t"])
    good = F.coalesce((F.col("before.nic") >= GOOD_NIC) & (F.col("after.nic") >= GOOD_NIC), F.lit(False))
    none = lambda p: F.coalesce(F.col(f"{p}.nic"), F.lit(0)) == 0
    first = lambda c: F.min_by(c, F.struct("after.ts", "before.ts"))
    e = s.groupBy("icao24", "session").agg(
        F.min("before.ts").alias("start"), F.max("after.ts").alias("end"), F.count("*").alias("jumps"), F.max("dist_nm").alias("max_dist_nm"), F.max("speed_kt").alias("max_speed_kt"), first(F.struct("before.lat", "before.lon")).alias("origin"),
        F.bool_or(good | F.col("converging")).alias("high"), F.bool_and(none("before") | none("after")).alias("overlap"), F.bool_or(F.col("before.anonymous") | F.col("after.anonymous")).alias("anonymous"),
    )
    return e.withColumn("confidence", F.when(F.col("high"), "high").when(F.col("overlap"), "integrity_overlap").otherwise("low")).drop("high", "overlap")
