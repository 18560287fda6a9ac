"""Vectorised word splitting and hashing over Arrow string batches.

Every text operator of this subpackage works on *whole* UTF-8 texts.  Words
are found on the raw bytes: the separators are ASCII, so no byte of a
multi-byte character can be mistaken for one.  A word's 64-bit hash is a
polynomial over its bytes read off one prefix sum, so the cost is a few
nanoseconds a byte and no Python string is made.

Nulls count as empty texts.  Long batches are cut into slices at separators,
so memory stays bounded by the slice (or by the longest single word).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = U64(0x9E3779B97F4A7C15 | 1)
_PINV = U64(pow(int(_P), -1, 1 << 64))
SLICE = 1 << 20

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32

#: `[^\x20\x09-\x0D]+`
SPACE_SEP = np.zeros(256, dtype=bool)
SPACE_SEP[[0x20, *range(0x09, 0x0E)]] = True

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` on lower-cased text
ALNUM_SEP = np.ones(256, dtype=bool)
ALNUM_SEP[0x30:0x3A] = False
ALNUM_SEP[0x61:0x7B] = False
ALNUM_SEP[0x80:] = False

_pow = np.ones(1, dtype=U64)
_inv = np.ones(1, dtype=U64)


def _tables(n: int) -> None:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, SLICE + 4096)
        _pow, _inv = np.full(size, _P, dtype=U64), np.full(size, _PINV, dtype=U64)
        _pow[0] = _inv[0] = 1
        np.cumprod(_pow, out=_pow)
        np.cumprod(_inv, out=_inv)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def raw_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and each text's offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts end to end, and each text's offsets."""
    raw, offsets = raw_buffers(texts)
    return _lower[raw], offsets


def spans(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~sep[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:-1]
    end = word
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes give equal hashes."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE, "right")))
        top = int(ends[j - 1]) - base
        _tables(top + 1)
        total = np.empty(top + 1, dtype=U64)
        total[0] = 0
        np.cumsum((data[base : base + top].astype(U64) + U64(1)) * _pow[:top], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * _inv[s] + (e - s).astype(U64))
        i = j
    return out


def words(texts: pa.Array, sep: np.ndarray = SPACE_SEP) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and for each text the index of its first word (one more at the end)."""
    data, offsets = buffers(texts)
    starts, ends, first = spans(data, offsets, sep)
    return hashes(data, starts, ends), first


def owner(first: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(word: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside one text, and each text's first index among them."""
    count = np.diff(first)
    kept = np.maximum(count - n + 1, 0)
    total = len(word) - n + 1
    if total <= 0:
        return np.zeros(0, U64), np.zeros(len(first), np.int64)
    h = np.zeros(total, dtype=U64)
    for k in range(n):
        h = mix(h * U64(0x9FB21C651E98DF25) + word[k : k + total])
    at = np.concatenate([[0], np.cumsum(kept)])
    index = np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], kept)
    return h[index], at
