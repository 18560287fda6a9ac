"""What the operators of this subpackage share: bounded batches, the shared folder, files that workers map."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once by a Python worker.
BATCH_BYTES = 2 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below spark.checkpoint.dir, which driver and executors share; a local session without one gets a folder of its own, a cluster's is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = getattr(shared_dir, "own", None)
        if base is None:
            base = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="navlattice-")
            spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + os.path.abspath(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def prefer(spark: SparkSession, key: str, value: str) -> None:
    """A setting that the operators want, where the session has none of its own."""
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, lost executors cost nothing, and the shuffles behind it go."""
    spark = df.sparkSession
    prefer(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shards(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod, is 0; a null id counts as the empty text and so is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod == 0


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of `column`; a longer text stands alone, whole."""
    for batch in batches:
        texts = batch.column(column)
        if not len(texts):
            continue
        sizes = np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64)
        total = np.cumsum(sizes)
        at = 0
        while at < len(texts):
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow with batches that Spark bounds by bytes, not only by rows: rows can be long texts."""
    prefer(df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES * 2))
    return df.mapInArrow(function, schema)


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def put(uri: str, arrays: list[np.ndarray]) -> None:
    """Writes arrays end to end under a name of this attempt, then renames: a repeated task leaves one whole file."""
    from pyarrow import fs

    system, path = (fs.LocalFileSystem(), _local(uri)) if _local(uri) else fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for a in arrays:
            out.write(memoryview(np.ascontiguousarray(a)).cast("B") if len(a) else b"")
    system.move(part, path)


def mapped(uri: str) -> np.ndarray:
    """A file's bytes, memory-mapped. Where the shared folder is no mounted one, an unlinked local copy is mapped."""
    path = _local(uri)
    if path is None:
        from pyarrow import fs

        system, remote = fs.FileSystem.from_uri(uri)
        with tempfile.NamedTemporaryFile() as copy:
            with system.open_input_stream(remote) as stream:
                while block := stream.read(1 << 20):
                    copy.write(block)
            copy.flush()
            return _map(copy.name)
    return _map(path)


def _map(path: str) -> np.ndarray:
    with open(path, "rb") as f:
        if not os.fstat(f.fileno()).st_size:
            return np.zeros(0, np.uint8)
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype=np.uint8)


def closing(function, *models):
    """A function of batches that lets go of the models' mapped files when its task ends: a worker waits for the next one without them."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            for m in models:
                m.close()

    return run


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in a sorted array, -1 where it is missing."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.searchsorted(sorted_keys, wanted)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == wanted, at, -1)


def totals(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and for each array of values its sums by key."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *(np.add.reduceat(v[order], first) for v in values))


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


#: Keys that hold more than this share of the rows are dealt out, to as many parts; there can be no more of them than its inverse.
HOT = 1024


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Column) -> DataFrame:
    """left join on one key, right unique in it; keys with over 1/HOT of left's rows (at most HOT of them) are dealt out by `spread`."""
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    total = left.count()
    hot = [r[0] for r in counts.where(F.col("count") * HOT > total).orderBy(F.desc("count")).limit(HOT).collect()] if total > HOT else []
    if not hot:
        return left.join(right, key, "left")
    salt = F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(spread), F.lit(HOT)).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(HOT - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("_salt", salt).join(right.withColumn("_salt", F.explode(salts)), [key, "_salt"], "left").drop("_salt")


def done(folder: str) -> set[str]:
    """The names of the files that tasks have put into a folder."""
    from pyarrow import fs

    system, path = (fs.LocalFileSystem(), _local(folder)) if _local(folder) else fs.FileSystem.from_uri(folder)
    return {f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if "." not in f.base_name}
