"""Which days to work on, in what pieces, and which ones to leave for a while."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..sources import files

# Fixed values.
REQUIRED = ("timeline.json", "route-hours-r4.json", "events.json")
MAX_ATTEMPTS, COOLDOWN_DAYS = 3, 3
CHUNK_DAYS, MAX_JOBS, PARALLEL, MAX_PARALLEL, BUDGET_S = 6, 256, 8, 20, 300 * 60
LEDGER = "failures.json"


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day of [start, end], and its month."""
    span = F.expr(f"sequence(date'{start}', date'{end}', interval 1 day)")
    d = spark.range(1).select(F.explode(span if start <= end else F.array().cast("array<date>")).alias("day"))
    return d.select("day", F.date_format("day", "yyyy-MM").alias("month"))


def plan(days: DataFrame, archived: DataFrame, exported: DataFrame, failures: DataFrame, now: dt.datetime, attempts: int = MAX_ATTEMPTS, cooldown: int = COOLDOWN_DAYS) -> DataFrame:
    """(day, mode), newest first: `process` without an archive, `export` without files; days that failed `attempts` times rest for `cooldown` days.

    failures: (day, count, last).
    """
    resting = failures.where((F.col("count") >= attempts) & (F.col("last") > F.lit(now - dt.timedelta(days=cooldown)))).select("day")
    known = lambda d, name: d.select("day").distinct().withColumn(name, F.lit(True))
    all_ = days.select("day").join(known(archived, "a"), "day", "left").join(known(exported, "e"), "day", "left").join(resting, "day", "left_anti")
    return all_.where("a is null or e is null").select("day", F.when(F.col("a"), "export").otherwise("process").alias("mode")).orderBy(F.desc("day"))


def missing(days: DataFrame, archived: DataFrame) -> DataFrame:
    return days.select("day").join(archived.select("day"), "day", "left_anti").orderBy(F.desc("day"))


def matrix(todo: list[dt.date], chunk: int = CHUNK_DAYS, jobs: int = MAX_JOBS) -> list[dict]:
    """Jobs of up to `chunk` days each, newest first; larger pieces where there would be more than `jobs`."""
    size = max(chunk, math.ceil(len(todo) / jobs), 1)
    ordered = sorted(todo, reverse=True)
    pieces = (ordered[i : i + size] for i in range(0, len(ordered), size))
    return [{"days": " ".join(map(str, p)), "label": str(p[0]) if len(p) == 1 else f"{p[0]} … {p[-1]}"} for p in pieces]


def parallel(wanted: int | None = None) -> int:
    return min(max(PARALLEL if wanted is None else wanted, 1), MAX_PARALLEL)


def exported(folder: str) -> set[dt.date]:
    """The days with all required files; a day that lacks one counts as not exported."""
    have: dict[str, set[str]] = {}
    for path, _ in files.listed(folder) or []:
        day, _, name = path.partition("/")
        have.setdefault(day, set()).add(name)
    out = set()
    for day, names in have.items():
        try:
            parsed = dt.date.fromisoformat(day)
        except ValueError:
            continue
        if names.issuperset(REQUIRED):
            out.add(parsed)
    return out


class Ledger:
    """Failed days: how often, when last, and why. Kept as JSON; a damaged file is an error, not an empty ledger."""

    def __init__(self, entries: dict[str, dict] | None = None):
        self.entries = entries or {}

    @classmethod
    def load(cls, folder: str) -> Ledger:
        uri = f"{folder.rstrip('/')}/{LEDGER}"
        if not files.exists(uri):
            return cls()
        got = json.loads(files.get(uri))
        if not isinstance(got, dict):
            raise ValueError(f"{uri} is no ledger")
        return cls(got)

    def save(self, folder: str) -> None:
        files.put(f"{folder.rstrip('/')}/{LEDGER}", json.dumps(self.entries, indent=1, sort_keys=True).encode())

    def failed(self, day: dt.date, error: str, now: dt.datetime, attempts: int = MAX_ATTEMPTS, cooldown: int = COOLDOWN_DAYS) -> bool:
        """Counts a failure, anew after a rest; whether the day rests now."""
        entry = self.entries.get(str(day), {"count": 0})
        rested = entry["count"] >= attempts and now - dt.datetime.fromisoformat(entry["last"]) >= dt.timedelta(days=cooldown)
        count = 1 if rested else entry["count"] + 1
        self.entries[str(day)] = {"count": count, "last": now.isoformat(), "error": error[:300]}
        return count >= attempts

    def succeeded(self, day: dt.date) -> None:
        self.entries.pop(str(day), None)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(dt.date.fromisoformat(d), e["count"], dt.datetime.fromisoformat(e["last"])) for d, e in self.entries.items()]
        return spark.createDataFrame(rows, "day date, count int, last timestamp")


def fingerprint() -> str:
    """A short hash of all thresholds: it changes when one of them does, and then the version must."""
    values = {k: v for k, v in vars(schema).items() if k.isupper() and isinstance(v, int | float | str | tuple) and k != "ALGORITHM_VERSION"}
    return hashlib.sha1(json.dumps(values, sort_keys=True).encode()).hexdigest()[:12]
