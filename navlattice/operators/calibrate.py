"""Checks of the thresholds against days of data: chance events, event sizes, and places that come back."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grid, stats
from ..schema import BACKGROUND_RATE, MIN_AIRCRAFT
from . import avionics, events, serve

# Fixed values.
REPEAT_DAYS, CANDIDATES = 5, (1, 2, 3, 4, 5, 8)


def chance_of_hot(n: Column, p: float = BACKGROUND_RATE) -> Column:
    """The probability that n aircraft, each affected at the background rate, make a medium or high level; one pass over the numbers of affected ones, whose probabilities below are the tail that the level asks for."""
    odds = math.log(p) - math.log1p(-p)
    first = F.struct((n * math.log1p(-p)).alias("log"), F.lit(0.0).alias("below"), F.lit(0.0).alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        hot, one = stats.level_of(n, k, F.greatest(F.lit(0.0), 1.0 - acc["below"])).isin("medium", "high"), F.exp(acc["log"])
        return F.struct((acc["log"] + F.log((n - k).cast("double") / (k + 1)) + odds).alias("log"), (acc["below"] + one).alias("below"), (acc["sum"] + F.when(hot, one).otherwise(0.0)).alias("sum"))

    below = F.aggregate(F.sequence(F.lit(0).cast("long"), n - 1), first, step)
    return below["sum"] + F.when(stats.level(n, n).isin("medium", "high"), F.pow(F.lit(p), n)).otherwise(0.0)


def expected_hot(nodes: DataFrame) -> DataFrame:
    """One row: hot cell-hours, and how many chance alone would make; the chance is computed once for each number of aircraft."""
    sizes = nodes.groupBy(F.col("n_total").cast("long").alias("n")).agg(F.count("*").alias("count"), F.count_if(F.col("level").isin("medium", "high")).alias("hot"))
    chance = F.when(F.col("n") >= MIN_AIRCRAFT, F.col("count") * chance_of_hot(F.greatest("n", F.lit(1)))).otherwise(0.0)
    return sizes.agg(F.coalesce(F.sum("hot"), F.lit(0)).alias("hot"), F.coalesce(F.sum(chance), F.lit(0.0)).alias("expected"))


def observed_quantiles(events: DataFrame) -> DataFrame:
    """Median and 90th percentile, exact, of the aircraft observed over an event; the latter is the entry at floor(0.9 n)."""
    seen = F.col("data_coverage.aircraft_observed")
    at = F.get(F.array_sort(F.collect_list(seen)), F.floor(0.9 * F.count("*")).cast("int"))
    return events.agg(F.percentile(seen, 0.5).alias("median"), at.alias("p90"), F.count("*").alias("events"))


def repeats(events: DataFrame) -> DataFrame:
    """events (day, event_id, cells) with the number of other days that have an event in or beside one of the cells."""
    cell = events.select("day", "event_id", F.explode("cells").alias("c")).select("day", "event_id", grid.number(F.col("c")).alias("h3"))
    seen = cell.select(F.col("day").alias("other"), "h3").distinct()
    near = cell.select("day", "event_id", F.explode(grid.disk(F.col("h3"))).alias("h3")).distinct()
    met = near.join(seen, "h3").where("other <> day").groupBy("day", "event_id").agg(F.countDistinct("other").alias("days"))
    return events.join(met, ["day", "event_id"], "left").withColumn("days", F.coalesce("days", F.lit(0)))


def candidates(repeated: DataFrame) -> DataFrame:
    """For each candidate of the least number of aircraft: events, and the share of them that come back on REPEAT_DAYS days or more."""
    each = repeated.withColumn("least", F.explode(F.array(*map(F.lit, CANDIDATES)))).where("affected_aircraft >= least")
    return each.groupBy("least").agg(F.count("*").alias("events"), F.round(F.avg((F.col("days") >= REPEAT_DAYS).cast("double")), 6).alias("repeated"))


def day_events(hourly: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """A day's events of one affected aircraft or more, without faulty ones, and its hot cell-hours beside the chance ones."""
    sound = events.settled(serve.without(hourly, avionics.verdicts(hourly).where("faulty")))
    return events.jamming_events(sound, 1).withColumn("day", F.lit(day)), expected_hot(events.nodes(sound)).select(F.lit(day).alias("day"), "hot", "expected")


def report(found: DataFrame) -> dict[str, DataFrame]:
    """Tables over the events of several days: candidates, quantiles, and counts by confidence, scale and level of the whole event, with the share that comes back."""
    r = events.settled(repeats(found))
    n, k = F.col("data_coverage.aircraft_observed"), F.col("affected_aircraft")
    back = F.round(F.avg((F.col("days") >= REPEAT_DAYS).cast("double")), 6).alias("repeated")
    count = lambda column, name: r.groupBy(column.alias(name)).agg(F.count("*").alias("events"), back)
    large = r.agg(F.count_if(F.size("cells") >= 40).alias("large"), F.max(F.size("cells")).alias("most_cells"))
    return {"candidates": candidates(r), "observed": observed_quantiles(r), "confidence": count(stats.confidence(n, k), "confidence"), "scale": count(F.col("scale"), "scale"), "level": count(stats.level(n, k), "level"), "cells": large}
