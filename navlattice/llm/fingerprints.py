"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of its LZ78 dictionary, each the shortest
run not yet in it; the last run counts too.  The set of phrase hashes is kept
as a minimum-hash signature: its K smallest hashes.  The likeness of two
signatures is the share of the K smallest of their union that both have, the
estimate of the Jaccard similarity of the phrase sets (exact below K).

Neighbours in id order meet by ranges: bounds are quantiles of the ids, and
an id that fills several ranges by itself is parted by the hash of its texts.
The first row of each range also goes, as a guest, to the range before it, so
texts are shuffled once and no task sees more than its range.  Workers search
the bounds as arrays; the plan holds none of them.

Defined cases: null texts are empty; the empty text's fingerprint is empty,
like another empty one's (1) and unlike all others (0); rows are ordered by
doc_id, nulls first, and rows of one id by the hash of their text, then the
text; a lone row's next one is itself; very long texts are parsed whole;
equal rows of one id stay in one range; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import map_texts, shards, slices

K = 64


def phrases(text: str) -> set:
    """The LZ78 phrases of a text."""
    seen: set[str] = set()
    add = seen.add
    now = ""
    for c in text:
        now += c
        if now not in seen:
            add(now)
            now = ""
    return seen


def signature(found: set) -> np.ndarray:
    """The K smallest 32-bit hashes of the phrases, in order."""
    if not found:
        return np.zeros(0, np.uint32)
    texts = pa.array([p.encode("utf-8", "surrogatepass") for p in found], pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[: at[-1]]
    h = np.unique((tv.hashes(data, at[:-1], at[1:]) >> np.uint64(32)).astype(np.uint32))
    return h[:K]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets."""
    if not len(a) and not len(b):
        return 1.0
    least = np.union1d(a, b)[:K]
    both = np.isin(least, a, assume_unique=True) & np.isin(least, b, assume_unique=True)
    return float(both.sum() / len(least))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


_LAST = np.iinfo(np.int64)


class Ranges:
    """Bounds in (id, hash) order, and the first row of each range that has rows."""

    def __init__(self, quantiles: list[int]):
        ids, held = np.unique(np.array(quantiles, np.int64), return_counts=True)
        # an id that several quantiles name is parted into as many pieces of its hashes
        ends = [int(_LAST.min) + (j << 64) // n - 1 for n in held.tolist() for j in range(1, n + 1)]
        self.ids, self.hashes = np.repeat(ids, held), np.array(ends, np.int64)
        self.first_keys = np.zeros(0, np.int64)
        self.firsts: dict[tuple[int, int], int] = {}

    def of(self, key: np.ndarray, hash_: np.ndarray) -> np.ndarray:
        """The number of bounds below each row."""
        low, high = np.searchsorted(self.ids, key, "left"), np.searchsorted(self.ids, key, "right")
        out = low.copy()
        for i in np.flatnonzero(high > low).tolist():
            out[i] += np.searchsorted(self.hashes[low[i] : high[i]], hash_[i], "left")
        return out


_KEYED = "bucket int, guest boolean, key long, hash long, doc_id long, text string"


def _dealt(ranges: Ranges, guests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            key, hash_ = (batch.column(c).to_numpy() for c in ("key", "hash"))
            bucket = ranges.of(key, hash_)
            rows, to, guest = np.arange(len(key)), bucket, np.zeros(len(key), bool)
            if guests:
                more = []
                for i in np.flatnonzero(np.isin(key, ranges.first_keys)).tolist():
                    before = ranges.firsts.get((int(key[i]), int(hash_[i])))
                    if before is not None and before not in sent:
                        sent.add(before)
                        more.append((i, before))
                if more:
                    rows = np.concatenate([rows, [i for i, _ in more]])
                    to = np.concatenate([to, [b for _, b in more]])
                    guest = np.concatenate([guest, np.ones(len(more), bool)])
            taken = batch.select(["key", "hash", "doc_id", "text"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(guest), *taken.columns], names=[x.split()[0] for x in _KEYED.split(", ")])

    return run


def _firsts(ranges: Ranges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[int, int]] = {}
        for batch in batches:
            key, hash_ = (batch.column(c).to_numpy() for c in ("key", "hash"))
            bucket = ranges.of(key, hash_)
            order = np.lexsort((hash_, key, bucket))
            head = order[np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) > 0]))] if len(order) else order
            for b, k, h in zip(bucket[head].tolist(), key[head].tolist(), hash_[head].tolist(), strict=True):
                least[b] = min(least.get(b, (k, h)), (k, h))
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array([k for k, _ in least.values()], pa.int64()), pa.array([h for _, h in least.values()], pa.int64())], names=["bucket", "key", "hash"])

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, guest, key, hash, text): each row against the next of its bucket."""
    names = [x.split()[0] for x in _OUT.split(", ")]
    held, rows = None, []
    for batch in slices(batches):
        for bucket, guest, doc, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True):
            if held is not None and (held[0] != bucket or held[1]):
                held = None  # a further guest, or another bucket
            if held is None and guest:
                continue
            sig = held[4] if held is not None and held[3] == text else signature(phrases(text))
            if held is not None:
                new = edited(held[3], text)
                e = held[4] if new == held[3] else signature(phrases(new))
                rows.append((held[2], len(held[3]), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), _text(held[4]), _text(e), likeness(held[4], e), likeness(held[4], sig)))
            held = (bucket, guest, doc, text, sig)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, _TYPES, strict=True)], names=names)
        rows = []


def fingerprints(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. ranges: how many (four a shuffle partition where not given)."""
    spark = documents.sparkSession
    n = ranges or shards(spark) * 4
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text).select(F.coalesce("doc_id", F.lit(int(_LAST.min))).alias("key"), F.xxhash64("text").alias("hash"), "doc_id", "text")
    quantiles = docs.agg(F.percentile_approx("key", [i / n for i in range(1, max(n, 2))], 10000)).first()[0]
    if quantiles is None:
        return spark.createDataFrame([], _OUT)
    cut = Ranges(quantiles if n > 1 else [])
    used = sorted(docs.select("key", "hash").mapInArrow(_firsts(cut), "bucket int, key long, hash long").groupBy("bucket").agg(F.min(F.struct("key", "hash")).alias("first")).collect())  # a row a range
    cut.firsts = {tuple(first): used[i - 1][0] for i, (_, first) in enumerate(used)}
    cut.first_keys = np.unique(np.array([k for k, _ in cut.firsts], np.int64))
    dealt = map_texts(docs, _dealt(cut, True), _KEYED)
    dealt = dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "guest", "key", "hash", "text")
    return map_texts(dealt.select("bucket", "guest", "doc_id", "text"), _pairs, _OUT)
