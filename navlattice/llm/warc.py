"""WARC archives with resolved revisits.

Headers alone (id, URL, payload length and digest) are shuffled by digest; the
smallest id of each digest that several payloads share keeps the payload as a
response.  These originals are written as sorted arrays, by the digest's first
bytes, which the writers map: every page is decided where it is read, so no
payload moves.  Tasks write archives of about ARCHIVE_BYTES, a warcinfo record
first and one gzip member a record, with fresh headers; reading parses them
record by record, an archive a task.

Defined cases: a null html is an empty payload; payloads shorter than
`least` bytes are always responses; rows that repeat the smallest id are all
responses, under one record id; a null id is never referred to (its record has
no number) and revisits what equals it; a null URL leaves the target header
out; very long payloads are written and read whole, one at a time; other
columns are ignored.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import done, map_texts, mapped, put, shards, shared_dir, slices, written

ARCHIVE_BYTES = 64 << 20
LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Originals in one file.
ORIGINALS = 1_000_000


def record_id(page_id, digest: str) -> str:
    """The same for a page in its own record and in those that refer to it."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}') if page_id is not None else uuid.uuid4()}>"


def _packed(kind: str, fields: list[str], block: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", *fields, f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def information(date: str) -> bytes:
    """The record that begins an archive."""
    return _packed("warcinfo", [f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields"], b"format: WARC File Format 1.1\r\nsoftware: navlattice\r\n")


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, digest: str, original: tuple | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit of an original (id, url) without it."""
    fields = [f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        fields.append(f"WARC-Target-URI: {_uri(url)}")
    fields.append(f"WARC-Payload-Digest: sha256:{digest}")
    if original is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(original[0], digest)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {original[0]}"]
        if original[1] is not None:
            fields.append(f"WARC-Refers-To-Target-URI: {_uri(original[1])}")
    if page_id is not None:
        fields.append(f"X-Page: {page_id}")
    fields.append("Content-Type: application/http;msgtype=response")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _packed("response" if original is None else "revisit", fields, head + (payload if original is None else b""))


class Originals:
    """Files of the originals' digests, ids and URLs, sorted, mapped when first met; empty where there are none."""

    def __init__(self, folder: str, parts: int, present: set[str]):
        self.folder, self.parts, self.present, self.files = folder, parts, present, {}

    def __getstate__(self):
        return {**self.__dict__, "files": {}}

    def of(self, digest: bytes) -> tuple | None:
        """(page_id, url) of the original with the digest."""
        name = str(_part(digest, self.parts))
        if name not in self.present:
            return None
        if name not in self.files:
            raw = mapped(f"{self.folder}/{name}")
            n = int(raw[:8].view(np.int64)[0])
            numbers = raw[8 : 8 + 24 * n].view(np.int64).reshape(3, n)
            keys = raw[8 + 24 * n : 8 + 56 * n].reshape(n, 32)
            self.files[name] = (np.ascontiguousarray(keys[:, :8]).view(">u8").ravel(), keys, *numbers, raw[8 + 56 * n :])
        first, keys, page, start, size, urls = self.files[name]
        i = int(np.searchsorted(first, int.from_bytes(digest[:8], "big")))
        while i < len(keys) and keys[i, :8].tobytes() == digest[:8]:
            if keys[i].tobytes() == digest:
                return int(page[i]), None if size[i] < 0 else urls[start[i] : start[i] + size[i]].tobytes().decode("utf-8", "surrogatepass")
            i += 1
        return None


def _part(digest: bytes, parts: int) -> int:
    return int.from_bytes(digest[:4], "big") * parts >> 32


def _write_originals(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("digest", "first", "url")), strict=True), key=lambda r: r[0])
        urls = [None if r[2] is None else r[2].encode("utf-8", "surrogatepass") for r in rows]
        size = np.array([-1 if u is None else len(u) for u in urls], np.int64)
        start = np.concatenate([[0], np.cumsum(np.maximum(size, 0))])[:-1]
        text = b"".join(u for u in urls if u is not None)
        arrays = [np.array([len(rows)], np.int64), np.array([r[1] for r in rows], np.int64), start, size, np.frombuffer(b"".join(r[0] for r in rows), np.uint8), np.frombuffer(text, np.uint8)]
        put(f"{folder}/{key[0].as_py()}", arrays)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32())})

    return run


def originals(pages: DataFrame, least: int = LEAST) -> Originals:
    """The pages that others revisit, from headers alone."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    heads = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.octet_length(html).alias("n"), F.sha2(html.cast("binary"), 256).alias("digest")).where(F.col("n") >= least)
    first = heads.groupBy("digest").agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("url"), F.count("*").alias("n"))
    first = written(first.where("n > 1 and first is not null").select(F.unhex("digest").alias("digest"), "first", "url"), "originals")
    parts = max(shards(spark), first.count() // ORIGINALS + 1)
    part = F.shiftright(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long") * parts, 32).cast("int")
    folder = shared_dir(spark, "originals")
    first.withColumn("part", part).groupBy("part").applyInArrow(_write_originals(folder), "part int").write.parquet(shared_dir(spark, "originals-done"))
    return Originals(folder, parts, done(folder))


def _write(folder: str, known: Originals, least: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def flush():
            path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            put(path, [np.frombuffer(b"".join([information(date), *held]), np.uint8)])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                body = (row["html"] or "").encode("utf-8", "surrogatepass")
                digest = hashlib.sha256(body)
                original = known.of(digest.digest()) if len(body) >= least else None
                if original is not None and original[0] == row["page_id"]:
                    original = None
                held.append(record(row["page_id"], row["url"], body, digest.hexdigest(), original, date))
                size += len(held[-1])
                if size > ARCHIVE_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def records(data: memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip archive, one member at a time."""
    at = 0
    while at < len(data):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof and at < len(data):
            piece = bytes(data[at : at + (1 << 16)])
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        whole = b"".join(parts)
        head, _, rest = whole.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _READ.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    number = lambda x: None if x is None else int(x)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows: list[tuple] = []

            def out(rows=rows):
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

            for h, block in records(memoryview(mapped(path))):
                kind = h["WARC-Type"]
                if kind == "warcinfo":
                    continue
                head, _, body = block.partition(b"\r\n\r\n")
                response = kind == "response"
                digest = hashlib.sha256(body).hexdigest() if response else h["WARC-Payload-Digest"].partition(":")[2]
                size = len(body) if response else int(re.search(rb"Content-Length: (\d+)", head)[1])
                rows.append((number(h.get("X-Page")), h.get("WARC-Target-URI"), size, digest, kind, number(h.get("X-Refers-To-Page"))))
                if len(rows) >= 10_000:
                    yield out()
                    rows.clear()
            if rows:
                yield out()


def write_archives(pages: DataFrame, least: int = LEAST, date: dt.datetime | None = None) -> DataFrame:
    """Writes the archives of pages (page_id, url, html) and returns their paths, a written table."""
    spark = pages.sparkSession
    known = originals(pages, least)
    stamp = f"{date or dt.datetime.now(dt.UTC):%Y-%m-%dT%H:%M:%SZ}"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return written(map_texts(rows, _write(shared_dir(spark, "warc"), known, least, stamp), "path string"), "archives")


#: Archives that are read by tasks of their own.
READERS = 20_000


def read_archives(paths: DataFrame) -> DataFrame:
    """The records of archives: id, URL, payload length and digest, type and what it refers to; an archive a task, or as many as make READERS tasks."""
    return paths.repartition(max(1, min(paths.count(), READERS))).mapInArrow(_read, _READ)
