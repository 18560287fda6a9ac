"""The near-real-time path: positions as a stream, rolled up by hour."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import grid
from ..operators import rollup
from ..schema import POSITIONS

#: How late a report may come; older data is corrected by the daily batch.
LATE = "3 hours"


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Positions from Parquet files as they arrive."""
    return spark.readStream.schema(POSITIONS).parquet(folder)


def hourly(stream: DataFrame) -> DataFrame:
    """(hour, h3, icao24) with all measures of the rollup, in update mode.

    Reports that repeat an (icao24, ts) count once within the lateness, the one
    that came first; where repeats differ, the batch's choice (the smallest
    position) comes with `recompute` or the daily batch.
    """
    s = rollup.eligible(stream).withWatermark("ts", LATE).dropDuplicatesWithinWatermark(["icao24", "ts"])
    s = s.withColumn("h3", grid.cell(F.col("lat"), F.col("lon")))
    out = s.groupBy(F.window("ts", "1 hour").alias("w"), "h3", "icao24").agg(*rollup.measures())
    return out.select(F.col("w.start").alias("hour"), "h3", "icao24", *(c for c in out.columns if c not in ("w", "h3", "icao24")))


def recompute(spark: SparkSession, source: str, target: str, hours_back: int = 3) -> Callable[[DataFrame, int], None]:
    """A foreachBatch that rebuilds the trailing whole hours from all their stored positions and replaces them: running twice changes nothing."""

    def run(batch: DataFrame, _: int) -> None:
        last = batch.agg(F.max("ts")).first()[0]
        if last is None:
            return
        batch.withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(source)
        first = F.date_trunc("hour", F.lit(last)) - F.expr(f"interval {hours_back - 1} hours")
        stored = spark.read.schema(POSITIONS + ", day date").parquet(source).where((F.col("day") >= F.to_date(first)) & (F.col("ts") >= first)).drop("day")
        out = rollup.rollup(stored)
        out.withColumn("hour_key", F.date_format("hour", "yyyyMMddHH")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour_key").parquet(target)

    return run


def start(stream: DataFrame, spark: SparkSession, source: str, target: str, checkpoint: str, every: str = "90 seconds", once: bool = False) -> StreamingQuery:
    """Runs `recompute` on a stream, in steps or until what is there is done."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(recompute(spark, source, target))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def poll_loop(step: Callable[[], None], every_s: float = 90, times: int | None = None, sleep: Callable[[float], None] = time.sleep) -> int:
    """Runs a step again and again; an error is told and the loop goes on. Returns how many steps failed."""
    failed, done = 0, 0
    while times is None or done < times:
        try:
            step()
        except Exception as e:  # noqa: BLE001 - a sink that is away for a while must not end the collection
            print(f"step {done}: {type(e).__name__}: {e}")
            failed += 1
        done += 1
        if times is None or done < times:
            sleep(every_s)
    return failed
