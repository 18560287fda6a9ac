"""Interpolated modified Kneser-Ney scoring.

N-grams are counted in Spark: every task sorts and sums its own word pairs
before anything is shuffled, and sends one block of arrays to each shard.  A
shard sums the blocks and writes a *sorted hash array* (pair hashes and
counts) to the shared folder.  What the recursion needs about words (count,
number of different words before it, totals and numbers of followers seen
once, twice, more often) is summed into a second set of sorted hash arrays.
Scoring tasks memory-map these arrays and look pairs up in them; no part of
the model is collected or broadcast.

The number of shards follows the bytes of text, so a shard fits a task at any
size.  A pair lives in the shard of its first word.  Words seen SPLIT times or
more are *split*: their pairs are dealt out by the hash of the pair, and the
sums about the word meet in the word's own shard.  Counts have 64 bits: the
few beyond 32 stand in a list of their own.

The model is the bigram one (order 2): pairs with a start mark before the
first word and an end token after the last; the README has the figures that
rule out order 3 here.  The lower order is interpolated
Kneser-Ney over the number of different predecessors, and below it stands the
uniform distribution over the known tokens and one unknown.

Defined cases: a null or empty text is the end token alone; a null doc_id is
held out; an empty training set gives every token the probability 1/(V+1) with
V = 0, so 1; repeated rows are scored, and counted, each for itself; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import blob, closing, done, find, held_out, map_texts, mapped, put, shards, shared_dir, slices, totals, written

U64 = np.uint64
END, START = U64(0x1D8E4E27C47D124F), U64(0xEB44ACCAB455D165)
#: Tokens of a task that are sorted together.
FLUSH = 3_000_000
#: Bytes of text for one shard, and the count from which a word's pairs are dealt out: a quarter of such a shard's words.
SHARD_BYTES, SPLIT = 16 << 20, 600_000
#: The count that stands for one in the list of large ones.
MORE = 0xFFFFFFFF
_TOP = U64(0xFFFFFF0000000000)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts with an end after each, the token before each (a start mark for the first), and where each text begins."""
    word, first = tv.words(texts)
    n = len(first) - 1
    begin = first + np.arange(n + 1)
    token = np.full(len(word) + n, END, dtype=U64)
    token[np.arange(len(word)) + tv.owner(first)] = word
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[begin[:-1]] = START
    return token, before, begin


def _pair(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return tv.mix(before * U64(0xA0761D6478BD642F) + token)


def _shard(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> U64(40)) * U64(n)) >> U64(24)


def _route(before: np.ndarray, pair: np.ndarray, split: np.ndarray) -> np.ndarray:
    """The hash whose high bits name a pair's shard: the first word's, or the pair's where that word is split."""
    return np.where(find(split, before) >= 0, pair, before) if len(split) else before


def _by_shard(n: int, sorted_route: np.ndarray) -> np.ndarray:
    return np.searchsorted(_shard(sorted_route, n), np.arange(n + 1, dtype=U64))


_COUNTS = "shard int, kind string, a binary, b binary, c binary, n long"


def _row(shard: int, kind: str, a=b"", b=b"", c=b"", n: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([kind]), pa.array([a], pa.binary()), pa.array([b], pa.binary()), pa.array([c], pa.binary()), pa.array([n], pa.int64())],
        names=["shard", "kind", "a", "b", "c", "n"],
    )


def _count_words(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not keys:
                return
            h, c = totals(np.concatenate(keys), np.concatenate(counts))
            cut = _by_shard(n, h)
            for s in np.flatnonzero(np.diff(cut)):
                yield _row(int(s), "word", blob(h[cut[s] : cut[s + 1]]), blob(c[cut[s] : cut[s + 1]]))
            keys.clear()
            counts.clear()

        for batch in slices(batches):
            h, c = np.unique(_tokens(batch.column("text"))[0], return_counts=True)
            keys.append(h)
            counts.append(c)
            held += len(h)
            if held > FLUSH:
                yield from flush()
                held = 0
        yield from flush()

    return run


def _sum_words(key: tuple, table: pa.Table) -> pa.Table:
    """One shard's words: sorted hashes and counts; c holds the few words that are a large part of the shard."""
    h = np.concatenate([np.frombuffer(x, U64) for x in table.column("a").to_pylist()])
    c = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("b").to_pylist()])
    h, c = totals(h, c)
    large = c >= SPLIT
    return pa.Table.from_batches([_row(key[0].as_py(), "word", blob(h), blob(c), blob(h[large]) + blob(c[large]), int(c.sum()))])


def _count_pairs(n: int, split: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, token, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not before:
                return
            u, w = np.concatenate(before), np.concatenate(token)
            before.clear()
            token.clear()
            pair = _pair(u, w)
            route = _route(u, pair, split)
            sort = (route & _TOP) | (tv.mix(pair) >> U64(24))
            order = np.argsort(sort)
            sort = sort[order]
            first = np.flatnonzero(np.concatenate([[True], sort[1:] != sort[:-1]]))
            count = np.diff(np.concatenate([first, [len(sort)]])).astype(np.uint32)
            order = order[first]
            u, w, cut = u[order], w[order], _by_shard(n, route[order])
            for s in np.flatnonzero(np.diff(cut)):
                i, j = cut[s], cut[s + 1]
                turn = np.flatnonzero(np.concatenate([[True], u[i + 1 : j] != u[i : j - 1]]))
                runs = np.diff(np.concatenate([turn, [j - i]])).astype(np.uint32)
                yield _row(int(s), "pair", blob(u[i:j][turn]) + blob(runs), blob(w[i:j]), blob(count[i:j]), len(turn))

        for batch in slices(batches):
            w, u, _ = _tokens(batch.column("text"))
            before.append(u)
            token.append(w)
            held += len(w)
            if held > FLUSH:
                yield from flush()
                held = 0
        yield from flush()

    return run


def _sum_pairs(n: int, folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes one shard's sorted pairs; returns how many were seen 1 to 4 times, and what its pairs say about words, by the words' shards."""
        us, ws, cs = [], [], []
        for a, b, c, turns in zip(*(table.column(x).to_pylist() for x in "abcn"), strict=True):
            us.append(np.repeat(np.frombuffer(a, U64, turns), np.frombuffer(a, np.uint32, offset=8 * turns)))
            ws.append(np.frombuffer(b, U64))
            cs.append(np.frombuffer(c, np.uint32).astype(np.int64))
        u, w, c = np.concatenate(us), np.concatenate(ws), np.concatenate(cs)
        us.clear(), ws.clear(), cs.clear()
        pair = _pair(u, w)
        order = np.argsort(pair)
        pair = pair[order]
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        pair, u, w, c = pair[first], u[order[first]], w[order[first]], np.add.reduceat(c[order], first)
        del order, first
        s = key[0].as_py()
        large = np.flatnonzero(c >= MORE)
        put(f"{folder}/pair-{s}", [np.array([len(pair), len(large)], np.int64), pair, large, c[large], np.minimum(c, MORE).astype(np.uint32)])
        rows = [_row(-1, "seen", blob(np.bincount(np.minimum(c, 5), minlength=6)[1:5].astype(np.int64)))]
        after = totals(u, c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), (c > 2).astype(np.int64))
        for kind, arrays in (("after", after), ("into", totals(w, np.ones(len(w), np.int64)))):
            cut = _by_shard(n, arrays[0])
            for t in np.flatnonzero(np.diff(cut)):
                i, j = cut[t], cut[t + 1]
                rows.append(_row(int(t), kind, blob(arrays[0][i:j]), b"".join(blob(x[i:j]) for x in arrays[1:])))
        return pa.Table.from_batches(rows)

    return run


#: The words' array: hash, count, predecessors, followers' total, followers seen once, twice, more often.
_FIELDS = 7


def _words_of(uri: str) -> np.ndarray:
    return mapped(uri).view(np.int64).reshape(_FIELDS, -1)


def _join_words(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes what is known of one shard's words; returns how many have 1 to 4 predecessors, all predecessors and the number of words."""
        keys, values = [], []
        for kind, a, b in zip(*(table.column(x).to_pylist() for x in ("kind", "a", "b")), strict=True):
            h = np.frombuffer(a, U64)
            v = np.zeros((_FIELDS - 1, len(h)), np.int64)
            at = {"word": slice(0, 1), "into": slice(1, 2), "after": slice(2, 6)}[kind]
            v[at] = np.frombuffer(b, np.int64).reshape(-1, len(h))
            keys.append(h)
            values.append(v)
        h, *v = totals(np.concatenate(keys), *np.concatenate(values, axis=1))
        put(f"{folder}/word-{key[0].as_py()}", [h, *v])
        into = v[1]
        seen = np.bincount(np.minimum(into, 5), minlength=6)[1:5].astype(np.int64)
        return pa.Table.from_batches([_row(-1, "words", blob(np.concatenate([seen, [into.sum(), (into > 0).sum() - seen[:2].sum(), (v[0] > 0).sum()]]).astype(np.int64)))])

    return run


def discounts(seen: np.ndarray) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of n-grams seen 1 to 4 times; halves where one of them is 0."""
    n1, n2, n3, n4 = (float(x) for x in seen)
    if min(n1, n2, n3, n4) == 0:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), k) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def _lookup(read, folder: str, kind: str, n: int, route: np.ndarray, query) -> None:
    """Calls query(indices, array) for every shard that the sorted route meets."""
    cut = _by_shard(n, route)
    for s in np.flatnonzero(np.diff(cut)):
        query(slice(cut[s], cut[s + 1]), read(f"{folder}/{kind}-{s}"))


class Model:
    """The paths and the few global numbers of a trained model; small, whatever the corpus."""

    def __init__(self, folder: str, n: int, split: np.ndarray, tokens: int, types: int, pair_d, word_d, into: int, seen: np.ndarray, present: set):
        self.__dict__.update(folder=folder, n=n, split=split, tokens=tokens, types=types, pair_d=pair_d, word_d=word_d, into=into, seen=seen, present=present)

    def _open(self, uri: str):
        files = self.__dict__.setdefault("_files", {})
        if uri not in files:
            name = uri.rpartition("/")[2]
            raw = mapped(uri) if name in self.present else np.zeros(0, np.uint8)
            if name.startswith("word"):
                x = raw.view(np.int64).reshape(_FIELDS, -1)
                files[uri] = (x[0].view(U64), x)
            else:
                m, k = raw[:16].view(np.int64).tolist() if len(raw) else (0, 0)
                words = raw[16 : 16 + 8 * (m + 2 * k)].view(np.int64)
                files[uri] = (words[:m].view(U64), raw[16 + 8 * (m + 2 * k) :].view(np.uint32), words[m : m + k], words[m + k :])
        return files[uri]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_files"}

    def close(self) -> None:
        self.__dict__.pop("_files", None)

    def words(self, h: np.ndarray) -> np.ndarray:
        """The six numbers of each word of a sorted array of hashes; zeros for unknown ones."""
        out = np.zeros((_FIELDS - 1, len(h)), np.int64)

        def query(at, file):
            i = find(file[0], h[at])
            out[:, at] = np.where(i >= 0, file[1][1:, np.maximum(i, 0)] if file[1].shape[1] else 0, 0)

        _lookup(self._open, self.folder, "word", self.n, h, query)
        return out

    def pairs(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        pair = _pair(before, token)
        route = _route(before, pair, self.split)
        order = np.argsort((route & _TOP) | (pair >> U64(24)))
        keys, found = pair[order], np.zeros(len(pair), np.int64)

        def query(at, file):
            i = find(file[0], keys[at])
            got = np.where(i >= 0, file[1][np.maximum(i, 0)] if len(file[1]) else 0, 0).astype(np.int64)
            more = np.flatnonzero(got == MORE)
            got[more] = file[3][np.searchsorted(file[2], i[more])]
            found[at] = got

        _lookup(self._open, self.folder, "pair", self.n, route[order], query)
        out = np.empty(len(pair), np.int64)
        out[order] = found
        return out

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        token, before, begin = _tokens(texts)
        known, at = np.unique(np.concatenate([token, [START]]), return_inverse=True)
        stat = self.words(known)
        count, into, total, once, twice, more = stat
        d = np.array([0, *self.word_d])
        low = 1 / (self.types + 1)
        if self.into:
            gamma = (self.word_d[0] * self.seen[0] + self.word_d[1] * self.seen[1] + self.word_d[2] * self.seen[2]) / self.into
            low = np.maximum(into - d[np.minimum(into, 3)], 0) / self.into + gamma * low
        low = np.broadcast_to(low, into.shape)
        i, start = at[:-1], at[-1]
        j = np.empty_like(i)
        j[1:] = i[:-1]
        j[begin[:-1]] = start
        c = self.pairs(before, token)
        d = np.array([0, *self.pair_d])
        t = total[j]
        back = (self.pair_d[0] * once + self.pair_d[1] * twice + self.pair_d[2] * more)[j]
        p = np.where(t > 0, (np.maximum(c - d[np.minimum(c, 3)], 0) + back * low[i]) / np.maximum(t, 1), low[i])
        base = np.log10((count[i] + 0.1) / (self.tokens + 0.1 * (self.types + 1)))
        return {"n_tokens": np.diff(begin), "n_known": np.add.reduceat(count[i] > 0, begin[:-1], dtype=np.int64), "base_score": np.add.reduceat(base, begin[:-1]), "score": np.add.reduceat(np.log10(p), begin[:-1])}


def train(documents: DataFrame) -> Model:
    """A model of all texts of `documents` (column text)."""
    spark = documents.sparkSession
    folder = shared_dir(spark, "lm")
    texts = documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(shards(spark), size // SHARD_BYTES + 1)
    words = written(map_texts(texts, _count_words(n), _COUNTS).groupBy("shard").applyInArrow(_sum_words, _COUNTS), "lm-words")
    tops = words.select("n", "c").collect()  # a row a shard
    tokens = sum(r.n for r in tops)
    large = [np.frombuffer(bytes(r.c), U64).reshape(2, -1) for r in tops]
    split = np.sort(np.concatenate([x[0] for x in large])) if large else np.zeros(0, U64)
    pairs = written(map_texts(texts, _count_pairs(n, split), _COUNTS).groupBy("shard").applyInArrow(_sum_pairs(n, folder), _COUNTS), "lm-pairs")
    seen = sum((np.frombuffer(bytes(r.a), np.int64) for r in pairs.where("kind = 'seen'").select("a").collect()), np.zeros(4, np.int64))
    about = pairs.where("kind in ('after', 'into')").unionByName(words.withColumn("c", F.lit(b"")))
    rows = about.groupBy("shard").applyInArrow(_join_words(folder), _COUNTS).select("a").collect()
    last = sum((np.frombuffer(bytes(r.a), np.int64) for r in rows), np.zeros(7, np.int64))
    return Model(folder, n, split, tokens, int(last[6]), discounts(seen), discounts(last[:4]), int(last[4]), np.array([last[0], last[1], last[5]]), done(folder))


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Every row of `documents` (doc_id, held_out, text) with the model's log10 probability of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = model.score(batch.column("text"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *(pa.array(got[x]) for x in ("n_tokens", "n_known")), pa.array(np.full(n, model.tokens)), *(pa.array(got[x]) for x in ("base_score", "score")), pa.array(10 ** (-got["score"] / got["n_tokens"]))],
                names=[x.split()[0] for x in SCORED.split(", ")],
            )

    return documents.select(F.col("doc_id").cast("long"), "held_out", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(closing(run, model), SCORED)


def lm_scores(documents: DataFrame, folds: int = 10) -> DataFrame:
    """Trains on the rows outside fold 0 of `folds` (crc32 of doc_id) and scores all rows."""
    docs = documents.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"), folds))
    return score(docs, train(docs.where("not held_out")))
