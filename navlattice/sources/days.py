"""Days of results in folders: layout, whole writes, manifests, checks, publishing.

A day is complete when its manifest is there: the manifest is written last and
lists every other file with its size and SHA-256.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ALGORITHM_VERSION
from . import files

MANIFEST, HOURLY, POSITIONS = "manifest.json", "hourly", "positions"


def day_dir(root: str, source: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{source}/{day:%Y/%m/%d}"


def write_table(df: DataFrame, path: str, keys: list[str], rows_a_file: int = 0) -> None:
    """Sorted Parquet: ranges of the keys over tasks, sorted inside each; the commit protocol makes the write whole."""
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd")
    (out.option("maxRecordsPerFile", rows_a_file) if rows_a_file else out).parquet(path)


def table_stats(df: DataFrame) -> DataFrame:
    """One row: rows and distinct aircraft."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct("icao24").alias("aircraft"))


def file_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(name, bytes, sha256) of the folder's files, the manifest aside; hashed by the executors, in pieces."""
    names = [n for n, _ in files.listed(folder) or [] if n != MANIFEST and not n.rpartition("/")[2].startswith(("_", "."))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.column("name").to_pylist()
            got = [files.digest(f"{folder}/{n}") for n in name]
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string())], names=["name", "bytes", "sha256"])

    rows = spark.createDataFrame([(n,) for n in names], "name string")
    return rows.repartition(max(1, min(len(names), spark.sparkContext.defaultParallelism))).mapInArrow(run, "name string, bytes long, sha256 string")


def write_day(positions: DataFrame, hourly: DataFrame, root: str, source: str, day: dt.date, box: tuple | None = None, extra: dict | None = None) -> str:
    """Writes a day's positions and rollup, then its manifest; both tables may come from one parse that the caller keeps."""
    folder, spark = day_dir(root, source, day), positions.sparkSession
    write_table(positions, f"{folder}/{POSITIONS}", ["icao24", "ts"])
    write_table(hourly, f"{folder}/{HOURLY}", ["hour", "h3", "icao24"])
    write_manifest(spark, folder, source, day, box, extra)
    return folder


def write_manifest(spark: SparkSession, folder: str, source: str, day: dt.date, box: tuple | None = None, extra: dict | None = None) -> dict:
    stats = {t: table_stats(spark.read.parquet(f"{folder}/{t}")).first().asDict() for t in (POSITIONS, HOURLY)}
    entries = [r.asDict() for r in file_entries(spark, folder).collect()]  # a row a file
    out = {"source": source, "date": day.isoformat(), "bbox": list(box) if box else None, "algorithm_version": ALGORITHM_VERSION, "stats": stats, "files": sorted(entries, key=lambda e: e["name"])} | (extra or {})
    files.put(f"{folder}/{MANIFEST}", json.dumps(out, separators=(",", ":"), sort_keys=True).encode())
    return out


def read_manifest(folder: str) -> dict:
    return json.loads(files.get(f"{folder}/{MANIFEST}"))


def differences(spark: SparkSession, folder: str) -> DataFrame:
    """What the manifest lists against what is there: (name, fault), empty where all is well."""
    want = spark.createDataFrame([(e["name"], e["bytes"], e["sha256"]) for e in read_manifest(folder)["files"]], "name string, bytes long, sha256 string")
    have = file_entries(spark, folder).select("name", F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    fault = F.when(F.col("b").isNull(), "missing").when(F.col("bytes").isNull(), "unlisted").when(F.col("b") != F.col("bytes"), "size").when(F.col("s") != F.col("sha256"), "checksum")
    return want.join(have, "name", "full_outer").select("name", fault.alias("fault")).where("fault is not null")


def check_day(spark: SparkSession, folder: str) -> None:
    """Raises where a listed file is missing or not what the manifest says."""
    bad = differences(spark, folder).where("fault <> 'unlisted'").limit(5).collect()
    if bad:
        raise ValueError(f"{folder}: " + ", ".join(f"{r.name} ({r.fault})" for r in bad))


def copied(spark: SparkSession, source: str, target: str) -> None:
    """Copies a checked day to another folder, its manifest last, and checks it there: publishing, or restoring the other way."""
    check_day(spark, source)
    for entry in read_manifest(source)["files"]:
        where, path = files.system(f"{source}/{entry['name']}")
        to, goal = files.system(f"{target}/{entry['name']}")
        to.create_dir(goal.rpartition("/")[0], recursive=True)
        with where.open_input_stream(path) as a, to.open_output_stream(goal) as b:
            while block := a.read(1 << 20):
                b.write(block)
    files.put(f"{target}/{MANIFEST}", files.get(f"{source}/{MANIFEST}"))
    check_day(spark, target)


def require_rows(spark: SparkSession, folder: str) -> None:
    """The gate before publishing: a rollup that is missing or without rows is refused."""
    names = files.listed(f"{folder}/{HOURLY}")
    if names is None:
        raise FileNotFoundError(f"{folder}/{HOURLY}")
    if spark.read.parquet(f"{folder}/{HOURLY}").isEmpty():
        raise ValueError(f"{folder}: the rollup has no rows")


def archived(root: str, source: str, start: dt.date, end: dt.date) -> set[dt.date]:
    """The days of [start, end] with a manifest. A month without a folder has none; a folder that can't be listed is an error."""
    out, day = set(), start.replace(day=1)
    while day <= end:
        for name, _ in files.listed(f"{root.rstrip('/')}/{source}/{day:%Y/%m}") or []:
            parts = name.split("/")
            if len(parts) == 2 and parts[1] == MANIFEST and parts[0].isdigit():
                out.add(day.replace(day=int(parts[0])))
        day = (day + dt.timedelta(days=32)).replace(day=1)
    return {d for d in out if start <= d <= end}
