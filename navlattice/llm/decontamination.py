"""Benchmark decontamination with one Aho-Corasick automaton over words.

Benchmark texts and documents are normalised alike: A-Z lower-cased, words of
letters and digits.  The benchmark's windows (13 words; a shorter item is one
window) are the patterns of an automaton whose symbols are word numbers, so a
match always lies on whole words.  A document is scanned once; the hit words
keep their byte offsets, so hits map back to spans of the original text.

The automaton is built once, level by level, into sorted arrays in the shared
folder that workers map: edges by (node, word), fail links, and links to the
nearest pattern that ends at a node.  A benchmark of over BLOCK_WORDS words
makes several such automata, built by as many tasks; each is mapped, none is
built again, and a task's memory does not grow with the benchmark.  Texts are
scanned in lockstep, long ones in stretches that overlap by a window less one
word, which changes no match.

Defined cases: null and empty texts have no words, are clean, and as items
have no window; an item without an id can be hit but is not listed; repeated
items count once; repeated documents are judged each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import done, find, map_texts, mapped, put, shared_dir, slices

WINDOW = 13
#: Benchmark words in one automaton, and words that a scan steps through without a break.
BLOCK_WORDS, STRETCH = 2_000_000, 256

_ARRAYS = {"vocabulary": np.uint64, "edge": np.int64, "fail": np.int32, "link": np.int32, "level": np.int64, "pattern": np.int32, "at": np.int64, "item": np.int32, "name_at": np.int64, "name": np.uint8, "named": np.uint8}


def compiled(items: list[str | None], texts: pa.Array, window: int) -> dict[str, np.ndarray]:
    """The automaton of the windows of some items, as arrays.

    Node 0 is the root; node k is entered by edge k - 1.  Edges are keys
    (node before, word), which ascend over all levels as nodes do.
    """
    word, first = tv.words(texts, tv.ALNUM_SEP)
    vocabulary, ids = np.unique(word, return_inverse=True)
    count, v = np.diff(first), max(len(vocabulary), 1)
    size = np.minimum(count, window)
    held = np.where(count > 0, count - size + 1, 0)
    of = np.repeat(np.arange(len(count)), held)
    begin = np.arange(len(of)) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(held)[:-1]]), held) if len(of) else np.zeros(0, np.int64)
    length = size[of]
    node, edges, level = np.zeros(len(of), np.int64), [], [1]
    for d in range(window):
        on = np.flatnonzero(length > d)
        key, at = np.unique(node[on] * v + ids[begin[on] + d], return_inverse=True)
        node[on] = level[-1] + at
        edges.append(key)
        level.append(level[-1] + len(key))
    edge = np.concatenate(edges)
    fail, link = np.zeros(len(edge) + 1, np.int32), np.zeros(len(edge) + 1, np.int32)
    machine = Automaton({"vocabulary": vocabulary, "edge": edge, "fail": fail})
    for d in range(1, window):
        here = np.arange(level[d], level[d + 1])
        fail[here] = machine.step(fail[edge[here - 1] // v].astype(np.int64), edge[here - 1] % v)
    pairs = np.unique(np.stack([node, of]), axis=1) if len(of) else np.zeros((2, 0), np.int64)
    pattern, at = np.unique(pairs[0], return_index=True)
    link[pattern] = pattern
    for d in range(1, window + 1):
        here = np.arange(level[d - 1], level[d])
        here = here[link[here] == 0]
        link[here] = link[fail[here]]
    names = [(i or "").encode() for i in items]
    return {
        "vocabulary": vocabulary, "edge": edge, "fail": fail, "link": link, "level": np.array(level), "pattern": pattern.astype(np.int32), "at": np.append(at, pairs.shape[1]), "item": pairs[1].astype(np.int32),
        "name_at": np.concatenate([[0], np.cumsum(list(map(len, names)))]).astype(np.int64), "name": np.frombuffer(b"".join(names), np.uint8), "named": np.array([i is not None for i in items], np.uint8),
    }


class Automaton:
    """Arrays of an automaton, in memory or mapped."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        self.v = max(len(self.vocabulary), 1)

    def step(self, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The node after each word: down an edge, else down one of the longest suffix that has it."""
        out, open_ = np.zeros(len(node), np.int64), np.arange(len(node))
        while len(open_):
            at = find(self.edge, node[open_] * self.v + word[open_])
            out[open_] = at + 1
            open_ = open_[(at < 0) & (node[open_] > 0)]
            node[open_] = self.fail[node[open_]]
        return out

    def scan(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The node after each word of the runs [begin, end); 0 outside them."""
        window = len(self.level) - 1
        cut = np.maximum(-(-(end - begin) // STRETCH), 1)
        run = np.repeat(np.arange(len(begin)), cut)
        part = np.arange(len(run)) - np.repeat(np.cumsum(cut) - cut, cut)
        real = begin[run] + part * STRETCH
        last = np.minimum(real + STRETCH, end[run])
        lead = np.maximum(real - (window - 1), begin[run])
        order = np.argsort(-(last - lead), kind="stable")
        real, last, lead = real[order], last[order], lead[order]
        state, out = np.zeros(len(lead), np.int64), np.zeros(len(ids), np.int64)
        steps = last - lead
        for k in range(int(steps[0]) if len(steps) else 0):
            n = int(np.searchsorted(-steps, -k, "left"))
            at = lead[:n] + k
            state[:n] = self.step(state[:n].copy(), ids[at])
            own = at >= real[:n]
            out[at[own]] = state[:n][own]
        return out

    def matches(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the last word, pattern node) of everything that ends at a position."""
        place = np.flatnonzero(state)
        node = self.link[state[place]].astype(np.int64)
        places, nodes = [], []
        while len(place := place[node > 0]):
            node = node[node > 0]
            places.append(place)
            nodes.append(node)
            node = self.link[self.fail[node]].astype(np.int64)
        return (np.concatenate(places), np.concatenate(nodes)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Blocks:
    """The automata of a benchmark, mapped when first met."""

    def __init__(self, folder: str, present: list[int]):
        self.folder, self.present, self.open = folder, present, {}

    def __getstate__(self):
        return {**self.__dict__, "open": {}}

    def __iter__(self) -> Iterator[Automaton]:
        for k in self.present:
            if k not in self.open:
                self.open[k] = Automaton({n: mapped(f"{self.folder}/{k}-{n}").view(t) for n, t in _ARRAYS.items()})
            yield self.open[k]


def _write(folder: str, window: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        arrays = compiled(table.column("item_id").to_pylist(), table.column("text").combine_chunks(), window)
        for name, kind in _ARRAYS.items():
            put(f"{folder}/{key[0].as_py()}-{name}", [arrays[name].astype(kind)])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32())})

    return run


def automata(benchmark: DataFrame, window: int = WINDOW) -> Blocks:
    """Writes a benchmark's automata: one for up to about BLOCK_WORDS words."""
    spark, folder = benchmark.sparkSession, shared_dir(benchmark.sparkSession, "automata")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # a word has a letter and what parts it from the next
    words = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = words // 6 // BLOCK_WORDS + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")
    items.withColumn("block", block).groupBy("block").applyInArrow(_write(folder, window), "block int").write.parquet(shared_dir(spark, "automata-done"))
    return Blocks(folder, sorted({int(n.partition("-")[0]) for n in done(folder)}))


def _hits(word: np.ndarray, first: np.ndarray, blocks: Blocks) -> tuple[np.ndarray, list[set]]:
    """Which words are hit, and for each text the items with an occurring window."""
    edge = np.zeros(len(word) + 1, np.int64)
    items: list[set] = [set() for _ in range(len(first) - 1)]
    cut = np.zeros(len(word) + 1, bool)
    cut[first] = True
    for machine in blocks:
        if not len(machine.pattern):
            continue
        ids = find(machine.vocabulary, word)
        known = ids >= 0
        begin = np.flatnonzero(known & (cut[:-1] | np.append(True, ~known[:-1])[: len(known)]))
        end = np.flatnonzero(known & (cut[1:] | np.append(~known[1:], True)[: len(known)])) + 1
        depth = np.searchsorted(machine.level, machine.pattern, "right")
        wide = end - begin >= depth.min()
        place, node = machine.matches(machine.scan(ids, begin[wide], end[wide]))
        if not len(place):
            continue
        k = np.searchsorted(machine.pattern, node)
        np.add.at(edge, place + 1 - depth[k], 1)
        np.add.at(edge, place + 1, -1)
        met = np.unique(np.stack([np.searchsorted(first, place, "right") - 1, k]), axis=1)
        for t, j in met.T.tolist():
            for i in machine.item[machine.at[j] : machine.at[j + 1]].tolist():
                if machine.named[i]:
                    items[t].add(machine.name[machine.name_at[i] : machine.name_at[i + 1]].tobytes().decode())
    return np.cumsum(edge[:-1]) > 0, items


def _judge(blocks: Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = tv.buffers(batch.column("text"))
            starts, ends, first = tv.spans(data, offsets, tv.ALNUM_SEP)
            hit, items = _hits(tv.hashes(data, starts, ends), first, blocks)
            total = np.concatenate([[0], np.cumsum(hit)])
            lists, spans = [], []
            for i, who in enumerate(items):
                lists.append(sorted(x for x in who if x is not None))
                mine = np.arange(first[i], first[i + 1])[hit[first[i] : first[i + 1]]]
                runs = np.split(mine, np.flatnonzero(np.diff(mine) > 1) + 1) if len(mine) else []
                spans.append([{"start": int(starts[r[0]] - offsets[i]), "end": int(ends[r[-1]] - offsets[i])} for r in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(first)), pa.array(total[first[1:]] - total[first[:-1]]), pa.array(lists, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string())],
                names=["doc_id", "n_words", "n_hit", "items", "spans", "items_sha256"],
            )

    return run


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, items (ids as strings, sorted), spans (UTF-8 byte offsets of hit passages), items_sha256, contaminated (hits are a twentieth of the words or more)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = map_texts(docs, _judge(automata(benchmark, window)), "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>, items_sha256 string")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    judge = _judge(automata(benchmark, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for got in judge(iter([batch.select(["doc_id", "text"])])):
                hit, words = got.column("n_hit").to_numpy(), got.column("n_words").to_numpy()
                yield batch.filter(pa.array((hit == 0) | (hit * 20 < words)))

    return map_texts(documents, run, documents.schema)
