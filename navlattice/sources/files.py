"""Files in local or remote folders, for driver and executors alike: whole writes, hashes, listings that never guess."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame


def system(uri: str) -> tuple[fs.FileSystem, str]:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), os.path.abspath(parts.path)
    return fs.FileSystem.from_uri(uri)


def put(uri: str, data: bytes) -> int:
    """Writes under another name, then renames: a reader, or a repeated task, sees the whole file or none."""
    where, path = system(uri)
    where.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with where.open_output_stream(part) as out:
        out.write(data)
    where.move(part, path)
    return len(data)


def get(uri: str) -> bytes:
    where, path = system(uri)
    with where.open_input_stream(path) as f:
        return f.read()


def exists(uri: str) -> bool:
    where, path = system(uri)
    return where.get_file_info(path).type == fs.FileType.File


def listed(folder: str) -> list[tuple[str, int]] | None:
    """(path relative to the folder, bytes) of its files, parts aside; None where there is no such folder. Any other trouble is raised, never taken for absence."""
    where, path = system(folder)
    kind = where.get_file_info(path).type
    if kind == fs.FileType.NotFound:
        return None
    if kind != fs.FileType.Directory:
        raise NotADirectoryError(folder)
    found = where.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted((os.path.relpath(f.path, path), f.size) for f in found if f.type == fs.FileType.File and not f.path.endswith(".part"))


def digest(uri: str) -> tuple[int, str]:
    """Bytes and SHA-256 of a file, read in pieces."""
    where, path = system(uri)
    h, n = hashlib.sha256(), 0
    with where.open_input_stream(path) as f:
        while block := f.read(1 << 20):
            h.update(block)
            n += len(block)
    return n, h.hexdigest()


def write_documents(documents: DataFrame, folder: str) -> DataFrame:
    """Writes (path, body) rows as files below the folder, from the executors; returns (path, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, bodies = batch.column("path").to_pylist(), batch.column("body").to_pylist()
            sizes = [put(f"{folder}/{p}", b.encode()) for p, b in zip(paths, bodies, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return documents.select("path", "body").mapInArrow(run, "path string, bytes long")
