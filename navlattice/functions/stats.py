"""Scalar statistics as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (BACKGROUND_RATE, EARTH_RADIUS_NM, HIGH_MAX_WIDTH, HIGH_MIN_AIRCRAFT, HIGH_MIN_COVERAGE, HIGH_MIN_RATIO, LOW_MAX_AIRCRAFT, LOW_MAX_COVERAGE, LOW_MAX_RATIO, MIN_AIRCRAFT, SCALE_LARGE, SCALE_MEDIUM, SIGNIFICANCE, WILSON_Z)


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_NM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def binomial_tail(k: Column, n: Column, p: float = BACKGROUND_RATE) -> Column:
    """P(X >= k): the probabilities below k, one from the other in logarithms, taken from 1."""
    n, k = n.cast("long"), k.cast("long")
    first = F.struct((n * math.log1p(-p)).alias("log"), F.lit(0.0).alias("sum"))
    odds = math.log(p) - math.log1p(-p)
    step = lambda acc, i: F.struct((acc["log"] + F.log((n - i).cast("double") / (i + 1)) + odds).alias("log"), (acc["sum"] + F.exp(acc["log"])).alias("sum"))
    below = F.aggregate(F.sequence(F.lit(0).cast("long"), F.greatest(k - 1, F.lit(0))), first, step)["sum"]
    return F.when(k <= 0, 1.0).when(k > n, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - below))


def level(n: Column, k: Column) -> Column:
    return level_of(n, k, binomial_tail(k, n))


def level_of(n: Column, k: Column, tail: Column) -> Column:
    """The level of k affected ones among n, where chance makes k or more with the probability `tail`."""
    ratio = k / F.nullif(n, F.lit(0))
    quiet = (ratio <= LOW_MAX_RATIO) | (tail >= SIGNIFICANCE)
    return F.when(n < MIN_AIRCRAFT, "noData").when(quiet, "low").when(ratio >= HIGH_MIN_RATIO, "high").otherwise("medium")


def wilson(n: Column, k: Column) -> Column:
    p, z2 = k / F.nullif(n, F.lit(0)), WILSON_Z**2
    mid, base = (p + z2 / (2 * n)), 1 + z2 / F.nullif(n, F.lit(0))
    half = WILSON_Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    lo = F.when(n > 0, F.greatest(F.lit(0.0), (mid - half) / base)).otherwise(0.0)
    hi = F.when(n > 0, F.least(F.lit(1.0), (mid + half) / base)).otherwise(1.0)
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def confidence(n: Column, k: Column, coverage: Column | None = None) -> Column:
    w = wilson(n, k)
    c = F.lit(None).cast("double") if coverage is None else coverage
    high = (n >= HIGH_MIN_AIRCRAFT) & (w["hi"] - w["lo"] <= HIGH_MAX_WIDTH) & F.coalesce(c >= HIGH_MIN_COVERAGE, F.lit(True))
    return F.when(n < MIN_AIRCRAFT, "none").when((n < LOW_MAX_AIRCRAFT) | F.coalesce(c < LOW_MAX_COVERAGE, F.lit(False)), "low").when(high, "high").otherwise("medium")


def scale(n: Column) -> Column:
    return F.when(n >= SCALE_LARGE, "large").when(n >= SCALE_MEDIUM, "medium").otherwise("small")


def ratio(k: Column, n: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(k, n), F.lit(0.0)), 4)
