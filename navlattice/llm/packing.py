"""Sum-of-squares online packing of token sequences into windows.

Each task packs the documents it reads, one after another.  A document's ids
fill whole windows first; the rest is placed by the sum-of-squares rule: of
all fill levels with room, and an empty window, it takes the one after which
the sum of squared counts of partially filled windows, by level, is smallest.
The counts live in one array over levels.  Placing x at level f changes the
sum by -2*N[f]+1 at f and 2*N[f+x]+1 at f+x, so the choice is one vectorised
minimum over the levels.

A task's windows that are still open at its end stay as the rule placed them,
the fullest first; the room left in each is filled with pieces cut from the
emptiest, which are the only ones to be taken apart.  What is left of the last
one is cut into windows of powers of two, so nothing is padded.

Texts are cut before spaces that follow no white space, where the tokenizer's
own pre-tokens end in any case, and a worker encodes each distinct piece once
and remembers it: the ids are those of the whole text.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each for itself; a null doc_id stays null; other columns are ignored.
The result is written: sequence ids belong to one run of each task.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import find, map_texts, slices, written

WINDOW, END = 2048, 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Distinct pieces, and ids of them, that a worker remembers.
KNOWN, IDS = 1_500_000, 12_000_000


@lru_cache(1)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of all texts begin, and the number of pieces before each text: cuts are spaces after a character that is no white space."""
    space = np.flatnonzero(raw == 0x20)
    space = space[space > 0]
    b1, b2, b3 = raw[space - 1], raw[space - 2], raw[space - 3]
    white = (b1 <= 0x20) & ((b1 == 0x20) | (b1 >= 0x1C) | ((b1 >= 9) & (b1 <= 13)))
    far = np.flatnonzero(b1 >= 0x80)
    b1, b2, b3 = b1[far], b2[far], b3[far]
    # U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000
    white[far] = ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))) | ((b3 == 0xE1) & (b2 == 0x9A) & (b1 == 0x80)) | ((b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80)) | ((b3 == 0xE2) & (((b2 == 0x80) & ((b1 <= 0x8A) | (b1 == 0xA8) | (b1 == 0xA9) | (b1 == 0xAF))) | ((b2 == 0x81) & (b1 == 0x9F))))
    begin = np.zeros(len(raw), bool)
    begin[space[~white]] = True
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begin)
    return starts, np.searchsorted(starts, offsets)


class Encoder:
    """Ids of texts, as the tokenizer gives them for whole texts, from the ids of pieces.

    Pieces are known by a 64-bit hash, their length and their first eight
    bytes, in sorted arrays: some tens of bytes each.
    """

    def __init__(self, path: str, end: int):
        coder = tokenizer(path)
        self.encode, self.end = coder.encode_batch_fast, end
        # bytes of every token: a byte-level token has a character for each of its bytes
        special = {i: len(t.content.encode()) for i, t in coder.get_added_tokens_decoder().items()}
        sizes = {i: len(t) for t, i in coder.get_vocab().items()} | special
        self.size = np.zeros(max(sizes) + 1, np.int64)
        self.size[list(sizes)] = list(sizes.values())
        self.forget()

    def forget(self) -> None:
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.n = np.zeros(1 << 16, "<u4"), 0

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes new pieces; where the ids of each begin, and how many there are."""
        # pieces that begin with a space and end without white space stay apart when they stand one after the other
        apart = np.array([x[0] != " " or x[-1].isspace() for x in pieces], bool)
        alone, together = np.flatnonzero(apart), np.flatnonzero(~apart)
        groups = [*(together[i : i + JOIN] for i in range(0, len(together), JOIN)), *alone[:, None]]
        at, count = np.zeros(len(pieces), np.int32), np.zeros(len(pieces), np.int32)
        for group, code in zip(groups, self.encode(["".join([pieces[i] for i in g]) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(code.ids, "<u4")
            ends = np.cumsum(self.size[ids])
            stop = np.cumsum([len(pieces[i].encode()) for i in group])
            cut = np.searchsorted(ends, stop)
            if not len(ids) or ends[-1] != stop[-1] or (ends[cut] != stop).any():
                raise ValueError("the tokenizer's pieces are not those of the text")
            if self.n + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(ids), len(self.ids)), "<u4")])
            self.ids[self.n : self.n + len(ids)] = ids
            first = np.concatenate([[0], cut[:-1] + 1])
            at[group], count[group] = self.n + first, cut + 1 - first
            self.n += len(ids)
        return at, count

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text and the end after them."""
        if len(self.key) > KNOWN or self.n > IDS:
            self.forget()
        raw, offsets = tv.raw_buffers(texts)
        starts, first = _pieces(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        key, one, of = np.unique(tv.hashes(raw, starts, ends), return_index=True, return_inverse=True)
        head = np.concatenate([raw, np.zeros(8, np.uint8)])
        check = np.zeros(len(starts), np.uint64)
        for k in range(8):
            check |= np.where(starts + k < ends, head[starts + k], 0).astype(np.uint64) << np.uint64(8 * k)
        check ^= (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        found = find(self.key, key)
        if (check != check[one][of]).any() or (self.check[found[found >= 0]] != check[one][found >= 0]).any():
            raise ValueError("two pieces share a hash")
        new = np.flatnonzero(found < 0)
        if len(new):
            whole = raw.tobytes()
            at, count = self.learn([whole[a:z].decode() for a, z in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)])
            to = np.searchsorted(self.key, key[new])
            self.key, self.check = np.insert(self.key, to, key[new]), np.insert(self.check, to, check[one[new]])
            self.at, self.count = np.insert(self.at, to, at), np.insert(self.count, to, count)
            found = find(self.key, key)
        found = found[of]
        begin, size = self.at[found], self.count[found]
        end = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        ids = self.ids[np.arange(end[-1]) + np.repeat(begin - end[:-1], size)]
        stop, last = end[first].tolist(), np.array([self.end], "<u4")
        return [np.concatenate([ids[a:z], last]) for a, z in zip(stop[:-1], stop[1:], strict=True)]


#: Pieces that are encoded as one text.
JOIN = 4096


@lru_cache(1)
def encoder(path: str, end: int) -> Encoder:
    return Encoder(path, end)


class Packer:
    """Windows of one task: places rests, hands out sequence numbers."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.window, self.next = window, first_sequence
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def choose(self, x: int) -> int:
        """The level (0: an empty window) whose use makes the sum of squares smallest; the fullest of equals."""
        w = self.window
        gain = 2 * self.level[x : w + 1] + 1
        gain[w - x] = 0  # a full window is no longer partially filled
        gain[1:] += 1 - 2 * self.level[1 : w - x + 1]
        gain[1:][self.level[1 : w - x + 1] == 0] = np.iinfo(np.int64).max
        return w - x - int(np.argmin(gain[::-1]))

    def add(self, piece: tuple) -> list[tuple]:
        """Places a piece (doc_id, start, ids, doc_tokens); returns the placed pieces of a window that is full by it."""
        x = len(piece[2])
        f = self.choose(x)
        if f:
            pieces = self.open[f].pop()
            self.level[f] -= 1
        else:
            pieces = []
        pieces.append(piece)
        if f + x == self.window:
            return self.place(pieces)
        self.open[f + x].append(pieces)
        self.level[f + x] += 1
        return []

    def place(self, pieces: list[tuple]) -> list[tuple]:
        seq, at, out = self.sequence(), 0, []
        for doc, start, ids, total in pieces:
            out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, seq, at))
            at += len(ids)
        return out

    def close(self) -> list[tuple]:
        """The open windows, filled with pieces of the emptiest ones; the last rest in powers of two."""
        windows = [(level, pieces) for level in range(self.window, 0, -1) for pieces in self.open[level]]
        self.level[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        out, givers = [], deque()
        i, j = 0, len(windows) - 1
        while i < j or givers and i <= j:
            level, pieces = windows[i]
            while level < self.window and (givers or i < j):
                if not givers:
                    givers.extend(windows[j][1])
                    j -= 1
                level += self.take(givers, pieces, self.window - level)
            if level < self.window:
                break
            out += self.place(pieces)
            i += 1
        if i <= j:
            givers.extendleft(reversed(windows[i][1]))
        left = sum(len(p[2]) for p in givers)
        while left:
            now: list[tuple] = []
            size = min(self.window, 1 << (left.bit_length() - 1))
            while size:
                taken = self.take(givers, now, size)
                size, left = size - taken, left - taken
            out += self.place(now)
        return out

    @staticmethod
    def take(givers: deque, pieces: list, room: int) -> int:
        """Moves the first piece of givers, or as much of it as there is room for; returns how much."""
        doc, start, ids, total = givers.popleft()
        k = min(room, len(ids))
        pieces.append((doc, start, ids[:k], total))
        if k < len(ids):
            givers.appendleft((doc, start + k, ids[k:], total))
        return k


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def _pack(path: str, end: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, end)
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        for batch in slices(batches, limit=1 << 20):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
                whole = len(ids) // window * window
                for a in range(0, whole, window):
                    rows += packer.place([(doc, a, ids[a : a + window], len(ids))])
                if whole < len(ids):
                    rows += packer.add((doc, whole, ids[whole:].copy(), len(ids)))
            yield _batch(rows)
        yield _batch(packer.close())

    return run


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(documents: DataFrame, tokenizer_path: str | None = None, end: int = END, window: int = WINDOW) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(map_texts(docs, _pack(tokenizer_path or default_tokenizer(), end, window), SCHEMA), "packed")
