"""Exact Jaccard join of word n-gram sets as a metric-space join.

The Jaccard distance is a metric, but most pairs of documents are at distance
1, where no pivot tells them apart.  So the space is first taken apart
exactly.  N-grams are ordered from rare to common by the numbers of documents
they are in, which are counted over everything, shuffled in blocks and kept as
sorted hash arrays that workers map.  Sets within the radius share one of the
n-grams that come first in each (as many as may be missing, and one more), and
everything that shares such an n-gram, directly or through others, is one
region.  No link leaves a region.

Regions are joined recursively.  A region too heavy for one task gets pivots;
every member goes to the Voronoi cell of its nearest pivot and, by the
triangle inequality, to each cell whose pivot is at most two radii farther
(its boundary windows).  Members within the radius of a pivot are linked to it
and labelled: members of one label are connected and are not compared again,
so a region or cell of one label is done.  A region is copied into cells only
where these shrink and all copies together stay below COPIES; others are cut
into chunks, which are written once, and tasks map the pairs of chunks, of
different labels or of none and of sizes that the radius allows.  That is exact
whatever the distances are, and only names of chunks are multiplied.  Inside a task the same
recursion runs on arrays; a leaf orders its members by the distance to a pivot
and compares only those within one radius of each other on it that are not
yet connected.  Only a spanning forest of the links is passed on.

The numbers of links are counted apart from that, where they are wanted, as a
spanning forest leaves most links out.  Every member has one home, the cell of
its nearest pivot, at each level: all that it links with is in that cell too,
so its links are counted there and nowhere else.  Regions whose cells would
not shrink are cut into chunks as well: pairs of them count what lies across,
single ones what lies inside.

Equal sets are one node (a 64-bit digest of the set): the class of copies.
Memory is bounded by WEIGHT; no candidate is capped or left out.

Defined cases: null or word-less texts have empty sets and link with nothing;
a text with fewer words than n is one n-gram of its own length; repeated rows
with one doc_id stay rows, and their sets are linked through the id; rows with
a null doc_id link like others, come back with a null component and give no
component or class its id; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import textvec as tv
from .common import blob, closing, done, find, map_texts, mapped, put, shards, shared_dir, slices, totals, written
from .graph import components

U64 = np.uint64
_LOW = U64((1 << 40) - 1)
#: Members' n-grams (and 500 for each member) that one task joins in memory.
WEIGHT, EACH = 750_000, 500
#: N-grams that a task sorts together.
FLUSH = 2_000_000
#: Pivots of a region, on average.
PIVOTS = 12
#: Members that a leaf compares without further pivots.
LEAF = 192
#: How many times members may be copied into cells: of a region, and of all heavy regions in all.
COPIES = 3


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every text, end to end, and where each set begins."""
    word, first = tv.words(texts)
    gram, at = tv.grams(word, first, n)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.array([_whole(word[first[i] : first[i + 1]]) for i in short], dtype=U64)
        gram = np.insert(gram, at[short], extra)
        size = np.diff(at)
        size[short] = 1
        at = np.concatenate([[0], np.cumsum(size)])
    gram = gram.copy()
    for i in range(len(at) - 1):
        gram[at[i] : at[i + 1]].sort()
    keep = np.ones(len(gram), dtype=bool)
    keep[1:] = gram[1:] != gram[:-1]
    keep[at[:-1][np.diff(at) > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return gram[keep], kept[at]


def _whole(words: np.ndarray) -> int:
    h = U64(0x5851F42D4C957F2D * len(words) & 0xFFFFFFFFFFFFFFFF)
    for w in words:
        h = tv.mix(np.array([h], U64) * U64(0x9FB21C651E98DF25) + w)[0]
    return h


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums, modulo 2^64, of the values of each set."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[at[1:]] - total[at[:-1]]


def digests(gram: np.ndarray, at: np.ndarray) -> np.ndarray:
    return tv.mix(_sums(tv.mix(gram * U64(0xD1342543DE82EF95) + U64(1)), at) + np.diff(at).astype(U64) * U64(0x2545F4914F6CDD1D)).view(np.int64)


def _place(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each hash, by its upper three bytes, and its key there: the lower five."""
    return (((hashes >> U64(40)) * U64(parts)) >> U64(24)).astype(np.int64), hashes & _LOW


def _five(keys: np.ndarray) -> bytes:
    """Keys of five bytes, end to end."""
    return blob(np.ascontiguousarray(keys)[:, None].view(np.uint8)[:, :5])


def _wide(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view(U64).ravel()


def _count_grams(n: int, parts: int):
    """Blocks of n-gram keys for every shard, with the number of a task's sets that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, count = np.unique(np.concatenate(grams), return_counts=True)
            shard, key = _place(gram, parts)
            cut = np.searchsorted(shard, np.arange(parts + 1))
            at = np.flatnonzero(np.diff(cut))
            pick = [slice(cut[p], cut[p + 1]) for p in at]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([blob(count[x].astype(np.uint32)) for x in pick], pa.binary()), pa.array([_five(key[x]) for x in pick], pa.binary())], names=["shard", "counts", "keys"])

        for batch in slices(batches):
            gram, _ = shingle_sets(batch.column("text"), n)
            grams.append(gram)
            held += len(gram)
            if held > FLUSH:
                yield from flush()
                grams.clear()
                held = 0
        if held:
            yield from flush()

    return run


def _write_counts(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes one shard's n-grams of two sets or more, in order, and the binary logarithms of the numbers of sets."""
        keys = np.concatenate([_wide(x) for x in table.column("keys").to_pylist()])
        count = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        keys, count = totals(keys, count)
        keys, count = keys[count > 1], count[count > 1]
        put(f"{folder}/{key[0].as_py()}", [keys, np.log2(count).astype(np.uint8)])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())})

    return run


class Shards:
    """Files of sorted arrays, by shard, mapped when first met: `width` bytes an entry, of which the first eight are its key."""

    def __init__(self, folder: str, parts: int, width: int):
        self.folder, self.parts, self.width, self.files = folder, parts, width, {}

    def __getstate__(self):
        return {**self.__dict__, "files": {}}

    def close(self) -> None:
        self.files.clear()

    def open(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        if shard not in self.files:
            raw = mapped(f"{self.folder}/{shard}")
            m = len(raw) // self.width
            self.files[shard] = (raw[: 8 * m].view(U64), raw[8 * m :])
        return self.files[shard]


def rarity(gram: np.ndarray, counts: Shards) -> np.ndarray:
    """The binary logarithm of the number of sets that hold each n-gram, 0 for those of one set."""
    known, at = np.unique(gram, return_inverse=True)
    shard, key = _place(known, counts.parts)
    out = np.zeros(len(known), np.uint8)
    cut = np.searchsorted(shard, np.arange(counts.parts + 1))
    for p in np.flatnonzero(np.diff(cut)):
        keys, logs = counts.open(int(p))
        if len(keys):
            i = find(keys, key[cut[p] : cut[p + 1]])
            out[cut[p] : cut[p + 1]] = np.where(i >= 0, logs[np.maximum(i, 0)], 0)
    return out[at]


def first_grams(gram: np.ndarray, at: np.ndarray, percent: int, counts: Shards) -> tuple[np.ndarray, np.ndarray]:
    """Of every set the n-grams that come first from rare to common and are in other sets too, and the set of each: sets within the radius share one."""
    size = np.diff(at)
    log, own = rarity(gram, counts), np.repeat(np.arange(len(size)), size)
    order = np.lexsort((gram, log, own))
    rank = np.arange(len(gram)) - np.repeat(at[:-1], size)
    first = rank <= np.repeat(size + (-percent * size) // 100, size)
    chosen = order[first & (log[order] > 0)]
    return tv.mix(gram[chosen] + U64(0x632BE59BD9B4E019)), own[chosen]


def _sized(n: int):
    """The rows with the sizes and digests of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gram, at = shingle_sets(batch.column("text"), n)
            size = np.diff(at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), pa.array(digests(gram, at), mask=size == 0)], names=["doc_id", "n_shingles", "node"])

    return run


def _stars(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For each of `count` nodes the smallest node that the links (a, b) reach."""
    top = np.arange(count)
    while True:
        low = np.minimum(top[a], top[b])
        new = top.copy()
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, top[end], low)
        new = new[new]
        if np.array_equal(new, top):
            return top
        top = new


def _by_key(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the smallest node of each, and for all nodes the smallest that shared keys reach; nodes are numbers from 0."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    least = node[np.flatnonzero(head)][np.cumsum(head) - 1]
    count = int(node.max()) + 1
    edge = np.unique((node * count + least)[node != least])
    return key[head], node[head], _stars(edge // count, edge % count, count)


def _signed(n: int, percent: int, parts: int, counts: Shards):
    """Blocks of the first n-grams' keys for every shard: the nodes, how many keys of each, and the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sets, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            k, (s, own) = np.concatenate(keys), np.unique(np.concatenate(sets), return_inverse=True)
            if not len(k):  # nothing that another set has
                return
            key, node, top = _by_key(k, own)
            # links met here become one more key for all nodes that they join
            met = np.flatnonzero(np.bincount(top, minlength=len(top))[top] > 1)
            key, node = np.concatenate([key, tv.mix(s.view(U64)[top[met]] ^ U64(0x3C6EF372FE94F82B))]), np.concatenate([node, met])
            shard, key = _place(key, parts)
            order = np.lexsort((node, shard))
            key, node, cut = key[order], node[order], np.searchsorted(shard[order], np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(cut)):
                who, count = np.unique(node[cut[p] : cut[p + 1]], return_counts=True)
                rows.append((int(p), blob(s[who]), blob(count.astype(np.uint32)), _five(key[cut[p] : cut[p + 1]])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["shard", "nodes", "counts", "keys"])

        for batch in slices(batches):
            gram, at = shingle_sets(batch.column("text"), n)
            size, digest = np.diff(at), digests(gram, at)
            if not len(gram):
                continue
            _, one = np.unique(digest, return_index=True)
            if len(one) < len(digest):
                pick = np.concatenate([np.arange(at[i], at[i + 1]) for i in one])
                gram, at, digest = gram[pick], np.concatenate([[0], np.cumsum(size[one])]), digest[one]
            k, own = first_grams(gram, at, percent, counts)
            keys.append(k)
            sets.append(digest[own])
            held += len(k)
            if held > FLUSH:
                yield from flush()
                keys.clear()
                sets.clear()
                held = 0
        if keys:
            yield from flush()

    return run


def _shared_keys(key: tuple, table: pa.Table) -> pa.Table:
    """One shard's nodes that share keys, each linked to the smallest that it reaches."""
    nodes, keys = [], []
    for a, c, k in zip(*(table.column(x).to_pylist() for x in ("nodes", "counts", "keys")), strict=True):
        nodes.append(np.repeat(np.frombuffer(a, np.int64), np.frombuffer(c, np.uint32)))
        keys.append(_wide(k))
    s, own = np.unique(np.concatenate(nodes), return_inverse=True)
    _, _, top = _by_key(np.concatenate(keys), own)
    far = np.flatnonzero(top != np.arange(len(top)))
    return pa.table({"a": pa.array(s[far]), "b": pa.array(s[top[far]])})


#: N-grams, or sets, of one shard.
KEYS, SETS = 3_000_000, 1_000_000
_ROW = "doc_id long, n_shingles long, node long"
_BLOCK = "shard int, nodes binary, counts binary, keys binary"
_COUNTS = "shard int, counts binary, keys binary"
_MEMBER = "region long, node long, grams binary, label long"
_LABELLED = _MEMBER + ", cells array<long>, a array<long>"
_LINK = "a long, b long"
_CELLED = "region long, node long, grams binary, home boolean, cells array<struct<cell: long, home: boolean>>"
_DEGREE = "node long, links long"
_CHUNK = "region long, label long, band long, chunk long"


def _write_wanted(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes one shard's nodes, in order, with the row that stands for each and its region."""
        node, region = (table.column(x).to_numpy() for x in ("node", "region"))
        doc = table.column("doc_id")
        order = np.argsort(node.view(U64))
        put(f"{folder}/{key[0].as_py()}", [node[order], doc.fill_null(0).to_numpy()[order], doc.is_valid().to_numpy().astype(np.int64)[order], region[order]])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())})

    return run


def _with_sets(n: int, wanted: Shards, present: set[int]):
    """The sets of the rows that stand for wanted nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in slices(batches):
            gram, at = shingle_sets(batch.column("text"), n)
            digest = digests(gram, at)
            doc = batch.column("doc_id").to_pylist()
            regions, keep = [], []
            shard = digest % wanted.parts
            for p in np.unique(shard).tolist():
                if p not in present:
                    continue
                keys, rest = wanted.open(p)
                rest = rest.view(np.int64).reshape(3, -1)
                mine = np.flatnonzero((shard == p) & (np.diff(at) > 0))
                for i, k in zip(mine.tolist(), find(keys, digest[mine].view(U64)).tolist(), strict=True):
                    if k >= 0 and (rest[0, k] if rest[1, k] else None) == doc[i] and int(digest[i]) not in met:
                        met.add(int(digest[i]))
                        keep.append(i)
                        regions.append(int(rest[2, k]))
            yield pa.RecordBatch.from_arrays([pa.array(regions, pa.int64()), pa.array(digest[keep]), pa.array([blob(gram[at[i] : at[i + 1]]) for i in keep], pa.binary()), pa.nulls(len(keep), pa.int64())], names=["region", "node", "grams", "label"])

    return run


class Region:
    """Members' sets as ranks in the region's own universe of n-grams."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.size = np.array([len(s) for s in sets])
        universe, code = np.unique(np.concatenate(sets), return_inverse=True)
        self.at, self.code, self.percent = np.concatenate([[0], np.cumsum(self.size)]), code, percent
        self.mark = np.zeros(len(universe), dtype=bool)
        self.parent = np.arange(len(sets))
        self.side: np.ndarray | None = None
        self.links: list[tuple[int, int]] = []
        self.radius = 1 - percent / 100

    def top(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def tops(self) -> np.ndarray:
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        return self.parent

    def connected(self, labels: np.ndarray) -> None:
        """Members of one label (-1: none) are connected already."""
        known = np.flatnonzero(labels >= 0)
        _, first, group = np.unique(labels[known], return_index=True, return_inverse=True)
        self.parent[known] = known[first][group]

    def join(self, x: int, y: int) -> None:
        a, b = self.top(x), self.top(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((x, y))

    def against(self, x: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the intersections and unions of one member with others."""
        self.mark[self.code[self.at[x] : self.at[x + 1]]] = True
        size = self.size[others]
        index = np.arange(size.sum()) + np.repeat(self.at[others] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        both = np.add.reduceat(self.mark[self.code[index]], np.concatenate([[0], np.cumsum(size)[:-1]]), dtype=np.int64)
        self.mark[self.code[self.at[x] : self.at[x + 1]]] = False
        return both, size + self.size[x] - both

    def distance(self, x: int, others: np.ndarray) -> np.ndarray:
        both, union = self.against(x, others)
        for y in others[100 * both >= self.percent * union]:
            self.join(x, int(y))
        return 1 - both / union

    def solve(self, members: np.ndarray, depth: int = 0) -> None:
        if len(members) < 2:
            return
        if len(members) > LEAF and depth < 8:
            pivots = members[np.linspace(0, len(members) - 1, min(8, len(members) // LEAF + 2)).astype(int)]
            d = np.stack([self.distance(int(p), members) for p in pivots])
            nearest = d.min(0)
            cells = [members[row <= nearest + 2 * self.radius + 1e-9] for row in d]
            if max(map(len, cells)) < 0.7 * len(members):
                for cell in cells:
                    self.solve(cell, depth + 1)
                return
        self.leaf(members)

    def count(self, members: np.ndarray, home: np.ndarray, side: np.ndarray, degree: np.ndarray, depth: int = 0) -> None:
        """Adds to `degree` the links of the members that are at home here; with sides, only those between two sides (-1: any)."""
        if len(members) < 2 or not home.any():
            return
        if len(members) > LEAF and depth < 8:
            pivots = members[np.linspace(0, len(members) - 1, min(8, len(members) // LEAF + 2)).astype(int)]
            d = np.stack([1 - np.divide(*self.against(int(p), members)) for p in pivots])
            nearest, own = d.min(0), d.argmin(0)
            inside = [row <= nearest + 2 * self.radius + 1e-9 for row in d]
            if max(x.sum() for x in inside) < 0.7 * len(members):
                for k, x in enumerate(inside):
                    self.count(members[x], (home & (own == k))[x], side, degree, depth + 1)
                return
        d = 1 - np.divide(*self.against(int(members[0]), members))
        order = np.argsort(d, kind="stable")
        members, home, d = members[order], home[order], d[order]
        for i in range(len(members) - 1):
            x, last = int(members[i]), np.searchsorted(d, d[i] + self.radius + 1e-9, "right")
            y, at_home, size = members[i + 1 : last], home[i + 1 : last], self.size[x]
            near = (100 * self.size[y] >= self.percent * size) & (100 * size >= self.percent * self.size[y]) & (at_home | home[i]) & ((side[y] < 0) | (side[y] != side[x]))
            y, at_home = y[near], at_home[near]
            if len(y):
                both, union = self.against(x, y)
                linked = 100 * both >= self.percent * union
                degree[x] += linked.sum() if home[i] else 0
                degree[y[linked & at_home]] += 1

    def leaf(self, members: np.ndarray) -> None:
        d = self.distance(int(members[0]), members)
        order = np.argsort(d, kind="stable")
        members, d = members[order], d[order]
        for i in range(1, len(members) - 1):
            window = members[i + 1 : np.searchsorted(d, d[i] + self.radius + 1e-9, "right")]
            x = int(members[i])
            size, top = self.size[x], self.tops()
            window = window[(100 * self.size[window] >= self.percent * size) & (100 * size >= self.percent * self.size[window]) & (top[window] != top[x])]
            if self.side is not None:  # what lies inside a side is compared elsewhere
                window = window[self.side[window] != self.side[x]]
            if len(window):
                self.distance(x, window)


def _join_region(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """A spanning forest of the links inside one region."""
        node = table.column("node").to_numpy()
        _, one = np.unique(node, return_index=True)
        node = node[one]
        blobs = table.column("grams")
        region = Region([np.frombuffer(blobs[int(i)].as_py(), U64) for i in one], percent)
        _, label = np.unique(table.column("label").take(pa.array(one)).fill_null(0).to_numpy(), return_inverse=True)
        region.connected(np.where(table.column("label").take(pa.array(one)).is_null().to_numpy(), -1, label))
        region.solve(np.arange(len(node)))
        pairs = np.array(region.links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(node[pairs[:, 0]]), "b": pa.array(node[pairs[:, 1]])})

    return run


def _count_region(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """The number of links, inside one region, of each member at home in it."""
        # repeated rows are one member
        _, one = np.unique(table.column("node").to_numpy(), return_index=True)
        node, home, side = (table.column(x).to_numpy()[one] for x in ("node", "home", "side"))
        blobs = table.column("grams")
        region = Region([np.frombuffer(blobs[int(i)].as_py(), U64) for i in one], percent)
        degree = np.zeros(len(node), dtype=np.int64)
        region.count(np.arange(len(node)), home, side, degree)
        some = np.flatnonzero(degree)
        return pa.table({"node": pa.array(node[some]), "links": pa.array(degree[some])})

    return run


def _put_sets(uri: str, table: pa.Table) -> None:
    """Writes members: their number, lengths, nodes, labels (with 1 where there is one) and sets."""
    sets = [np.frombuffer(x, U64) for x in table.column("grams").to_pylist()]
    label = table.column("label")
    put(uri, [np.array([len(sets), *map(len, sets)], np.int64), table.column("node").to_numpy(), label.fill_null(0).to_numpy(), label.is_valid().to_numpy().astype(np.int64), *sets])


def _write_pivots(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes one region's pivots."""
        _put_sets(f"{folder}/{key[0].as_py()}", table)
        return pa.table({"region": pa.array([key[0].as_py()])})

    return run


def _write_chunks(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes one chunk's members, repeated rows as one."""
        _, one = np.unique(table.column("node").to_numpy(), return_index=True)
        _put_sets(f"{folder}/{key[3].as_py()}", table.take(pa.array(one)))
        return pa.table({name: pa.array([k.as_py()], pa.int64()) for name, k in zip(("region", "label", "band", "chunk"), key, strict=True)})

    return run


def _pair(folder: str, percent: int, x: int, y: int) -> tuple[Region, np.ndarray, np.ndarray, np.ndarray]:
    """The members of one chunk or of two, as a region with sides: their nodes, labels, and whether there is one."""
    node, label, known, sets = _read_sets(f"{folder}/{x}")
    side = np.full(len(node), -1)
    if x != y:
        other = _read_sets(f"{folder}/{y}")
        side = np.repeat([0, 1], [len(node), len(other[0])])
        node, label, known = (np.concatenate(p) for p in zip((node, label, known), other[:3], strict=True))
        sets = sets + other[3]
    region = Region(sets, percent)
    region.side = side
    return region, node, label, known


def _join_pairs(folder: str, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A spanning forest of the links inside a chunk or across two."""
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                region, node, label, known = _pair(folder, percent, x, y)
                if x == y:
                    region.side = None
                region.connected(np.where(known, np.unique(label, return_inverse=True)[1], -1))
                region.solve(np.arange(len(node)))
                pairs = np.array(region.links, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], names=["a", "b"])

    return run


def _count_pairs(folder: str, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The numbers of links, inside a chunk or across two, of the members whose label is 1."""
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                region, node, home, _ = _pair(folder, percent, x, y)
                degree = np.zeros(len(node), dtype=np.int64)
                region.count(np.arange(len(node)), home == 1, region.side, degree)
                some = np.flatnonzero(degree)
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(degree[some])], names=["node", "links"])

    return run


def _read_sets(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """What _write_pivots or _write_chunks wrote: nodes, labels, whether there is one, and sets."""
    raw = mapped(uri).view(U64)
    n = int(raw[0])
    size, node, label, known = raw[1:].view(np.int64)[: 4 * n].reshape(4, n)
    at = 1 + 4 * n + np.concatenate([[0], np.cumsum(size)])
    return node, label, known == 1, [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


class Pivots:
    """A region's pivots; those that link with each other, or had one label, share a label."""

    def __init__(self, uri: str, percent: int):
        self.node, label, known, self.sets = _read_sets(uri)
        self.percent, self.size = percent, np.array([len(x) for x in self.sets])
        top = np.arange(len(self.node))
        for i in range(len(top)):
            for j in np.flatnonzero(self.within(self.sets[i])[0] | (known[i] & known & (label == label[i]))):
                top[top == top[j]] = top[i]
        # a label that a pivot brings stands for its group, or else a pivot's node
        self.top = top
        self.label = np.array([next((label[j] for j in np.flatnonzero((top == t) & known)), self.node[t]) for t in top])

    def within(self, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pivots link with a set, and the distances to all."""
        both = np.array([np.isin(mine, p, assume_unique=True).sum() for p in self.sets])
        union = self.size + len(mine) - both
        return 100 * both >= self.percent * union, 1 - both / union


def _to_cells(folder: str, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The members with their labels, the Voronoi cells and windows that they belong to, and the pivots that they link with (one of each group)."""
        pivots: dict[int, Pivots] = {}
        for batch in slices(batches, "grams"):
            labels, cells, links = [], [], []
            for region, node, grams, label in zip(*(batch.column(x).to_pylist() for x in ("region", "node", "grams", "label")), strict=True):
                if region not in pivots:
                    pivots[region] = Pivots(f"{folder}/{region}", percent)
                p = pivots[region]
                linked, d = p.within(np.frombuffer(grams, U64))
                linked = np.flatnonzero(linked)
                # a pivot links with the others of its group, so that their links are out as well
                groups = linked if node in p.node else linked[np.unique(p.top[linked], return_index=True)[1]]
                near = np.flatnonzero(d <= d.min() + 2 * (1 - percent / 100) + 1e-9)
                cells.append(tv.mix(np.array([region], np.int64).view(U64) + near.astype(U64) + U64(1)).view(np.int64).tolist())
                links.append(p.node[groups].tolist())
                labels.append(int(p.label[linked[0]]) if len(linked) else label)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("region", "node", "grams")), pa.array(labels, pa.int64()), pa.array(cells, pa.list_(pa.int64())), pa.array(links, pa.list_(pa.int64()))], names=["region", "node", "grams", "label", "cells", "a"])

    return run


def _to_homes(folder: str, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The members with the Voronoi cells and windows that they belong to, and in which of these they are at home."""
        pivots: dict[int, Pivots] = {}
        for batch in slices(batches, "grams"):
            cells = []
            for region, grams, home in zip(*(batch.column(x).to_pylist() for x in ("region", "grams", "home")), strict=True):
                if region not in pivots:
                    pivots[region] = Pivots(f"{folder}/{region}", percent)
                d = pivots[region].within(np.frombuffer(grams, U64))[1]
                near = np.flatnonzero(d <= d.min() + 2 * (1 - percent / 100) + 1e-9)
                name = tv.mix(np.array([region], np.int64).view(U64) + near.astype(U64) + U64(1)).view(np.int64)
                cells.append([{"cell": c, "home": home and k == d.argmin()} for c, k in zip(name.tolist(), near.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("region", "node", "grams", "home")), pa.array(cells, pa.list_(pa.struct([("cell", pa.int64()), ("home", pa.bool_())])))], names=["region", "node", "grams", "home", "cells"])

    return run


def _degrees(members: DataFrame, percent: int) -> DataFrame:
    """(node, links): how many others each member links with; members is (region, node, grams, label), a written table."""
    spark = members.sparkSession
    mine = F.octet_length("grams") / 8 + EACH
    members = members.select("region", "node", "grams", F.lit(True).alias("home"))
    out, limit = [], None
    for level in range(8):
        heavy = written(members.groupBy("region").agg(F.sum(mine).alias("weight"), F.count("*").alias("n")).where(F.col("weight") > WEIGHT), "heavy")
        light = members.join(heavy, "region", "left_anti").withColumn("side", F.lit(-1).cast("long"))
        out.append(light.groupBy("region").applyInArrow(_count_region(percent), _DEGREE))
        if not heavy.head(1):
            break
        rest = members.join(heavy, "region")
        folder = shared_dir(spark, "pivots")
        luck = (F.xxhash64(F.col("node"), F.lit(level)).cast("double") / 2.0**64) + 0.5
        chosen = rest.where(luck * F.col("weight") <= mine * PIVOTS).select("region", "node", "grams", F.lit(None).cast("long").alias("label"))
        have = written(chosen.groupBy("region").applyInArrow(_write_pivots(folder), "region long"), "pivots-done")
        if level == 7 or have.isEmpty():
            out.append(_count_chunks(rest, percent))
            break
        without = rest.join(have, "region", "left_anti")
        if without.head(1):
            out.append(_count_chunks(without, percent))
        celled = written(map_texts(rest.join(have, "region", "left_semi").drop("weight", "n"), _to_homes(folder, percent), _CELLED), "celled")
        cell = celled.select("region", F.explode("cells.cell").alias("cell"))
        limit = limit or COPIES * heavy.agg(F.sum("weight")).first()[0]
        spread = celled.groupBy("region").agg(F.sum(mine * F.size("cells")).alias("spread"))
        state = written(_shrinking(heavy.select("region", "n").join(spread, "region"), cell), "shrinking")
        stuck = state.where("stuck") if _within(state, limit) else state
        stuck = stuck.select("region")
        if stuck.head(1):
            out.append(_count_chunks(celled.join(stuck, "region"), percent))
        inside = celled.join(stuck, "region", "left_anti").select("node", "grams", F.explode("cells").alias("c"))
        members = written(inside.select(F.col("c.cell").alias("region"), "node", "grams", F.col("c.home").alias("home")), "members")
    return _union(out).groupBy("node").agg(F.sum("links").alias("links"))


def _band(percent: int):
    """The band of a set's size: sets within the radius are in one band or in neighbouring ones."""
    size = F.octet_length("grams") / 8.0
    # a little wider than the ratio, so that no rounding parts a pair
    return (size if percent >= 100 else F.floor(F.log(size) / (math.log(100 / percent) * (1 + 1e-9)))).cast("long").alias("band")


def _dealt(rest: DataFrame, percent: int, labels: bool, join, schema: str) -> DataFrame:
    """Heavy regions by chunks, each written once: `join` maps single chunks and pairs of them, small enough for a task.

    A chunk has members of one band of sizes and, with labels, of one label; chunks whose bands are not neighbours do not meet, nor do chunks of one label.
    """
    spark, key = rest.sparkSession, ["region", "label", "band"]
    rest = rest.select("region", "node", "grams", "label", _band(percent))
    kind = F.col("label") if labels else F.lit(None).cast("long")
    parts = rest.groupBy("region", kind.alias("label"), "band").agg(F.ceil(F.sum(F.octet_length("grams") / 8 + EACH) * 2 / WEIGHT).cast("long").alias("n"))
    lists = written(parts, "parts").groupBy("region").agg(F.collect_list(F.struct("label", "band", "n")).alias("parts"))
    own = F.filter("parts", lambda p: p["label"].eqNullSafe(kind) & (p["band"] == F.col("band")))[0]["n"]
    dealt = rest.join(lists, "region").withColumns({"kind": kind, "chunk": F.xxhash64("region", kind, "band", F.pmod(F.xxhash64("node"), own))}).drop("parts")
    folder = shared_dir(spark, "chunks")
    chunks = written(dealt.groupBy("region", "kind", "band", "chunk").applyInArrow(_write_chunks(folder), _CHUNK), "chunks-done")
    other = chunks.select("region", *(F.col(c).alias(f"{c}_y") for c in ("label", "band", "chunk")))
    meet = (F.col("chunk") <= F.col("chunk_y")) & (F.abs(F.col("band") - F.col("band_y")) <= 1) & (F.col("label").isNull() | ~F.col("label").eqNullSafe(F.col("label_y")))
    pairs = written(chunks.join(other, "region").where(meet).select(F.col("chunk").alias("x"), F.col("chunk_y").alias("y")), "chunk-pairs")
    return pairs.repartition(max(shards(spark), pairs.count() // 16 + 1), "x", "y").mapInArrow(join(folder, percent), schema)


def _count_chunks(rest: DataFrame, percent: int) -> DataFrame:
    """Counts in heavy regions by single chunks and pairs of chunks of one band of sizes or of neighbouring ones."""
    return _dealt(rest.withColumn("label", F.col("home").cast("long")), percent, False, _count_pairs, _DEGREE)


def _chunks(rest: DataFrame, percent: int) -> DataFrame:
    """Joins heavy regions exactly by chunks of members without a label and pairs of chunks."""
    return _dealt(rest, percent, True, _join_pairs, _LINK)


def _shrinking(regions: DataFrame, cell: DataFrame) -> DataFrame:
    """regions (region, n, spread) with whether they are stuck: a cell has nearly all members, or all cells together too many copies; cell: (region, cell), a row a copy."""
    sizes = cell.groupBy("region", "cell").count().groupBy("region").agg(F.max("count").alias("most"), F.sum("count").alias("copies"))
    return regions.join(sizes, "region").select("region", "spread", ((F.col("most") > 0.7 * F.col("n")) | (F.col("copies") > COPIES * F.col("n"))).alias("stuck"))


def _within(state: DataFrame, limit: float) -> bool:
    """Whether the copies of all regions that are not stuck stay below the limit."""
    return (state.where("not stuck").agg(F.sum("spread")).first()[0] or 0) <= limit


def _unfinished(members: DataFrame, *more) -> DataFrame:
    """The regions that have more than one label, or members without one."""
    seen = members.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"), (F.count("label") == F.count("*")).alias("all"), *more)
    return seen.where(~F.col("all") | (F.col("low") < F.col("high"))).drop("low", "high", "all")


def _links(members: DataFrame, percent: int) -> DataFrame:
    """Links of all regions; members is (region, node, grams, label), a written table."""
    spark = members.sparkSession
    mine = F.octet_length("grams") / 8 + EACH
    out, limit = [], None
    for level in range(8):
        heavy = written(members.groupBy("region").agg(F.sum(mine).alias("weight")).where(F.col("weight") > WEIGHT), "heavy")
        light = members.join(heavy, "region", "left_anti")
        out.append(light.groupBy("region").applyInArrow(_join_region(percent), _LINK))
        total = heavy.agg(F.sum("weight")).first()[0]
        if total is None:
            return _union(out)
        limit = limit or COPIES * total
        rest = members.join(heavy, "region")
        if level == 7:
            break
        folder = shared_dir(spark, "pivots")
        luck = (F.xxhash64(F.col("node"), F.lit(level)).cast("double") / 2.0**64) + 0.5
        have = written(rest.where(luck * F.col("weight") <= mine * PIVOTS).drop("weight").groupBy("region").applyInArrow(_write_pivots(folder), "region long"), "pivots-done")
        if have.isEmpty():
            break
        without = rest.join(have, "region", "left_anti")
        if without.head(1):
            out.append(_chunks(without, percent))
        chosen = rest.join(have, "region", "left_semi").drop("weight")
        labelled = written(map_texts(chosen, _to_cells(folder, percent), _LABELLED), "labelled")
        out.append(labelled.select(F.explode("a").alias("a"), F.col("node").alias("b")).where("a <> b"))
        cell = labelled.select("region", "label", F.explode("cells").alias("cell"))
        state = written(_shrinking(_unfinished(labelled, F.count("*").alias("n"), F.sum(mine * F.size("cells")).alias("spread")), cell), "shrinking")
        divide = _within(state, limit)
        stuck = state.where("stuck") if divide else state
        if stuck.head(1):
            out.append(_chunks(labelled.join(stuck.select("region"), "region"), percent))
        into = state.where("not stuck").select("region")
        if not divide or not into.head(1):
            return _union(out)
        still = written(_unfinished(cell.join(into, "region", "left_semi").select(F.col("cell").alias("region"), "label")), "unfinished")
        cells = labelled.join(into, "region", "left_semi").select(F.explode("cells").alias("region"), "node", "grams", "label")
        members = written(cells.join(still, "region", "left_semi"), "members")
    out.append(_chunks(rest, percent))
    return _union(out)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _join(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their sets' digests, the members of regions, and a spanning forest of the links."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # texts are read once for the rows and twice for the n-grams, which go straight into their shuffles
    rows = written(map_texts(docs, _sized(n), _ROW), "sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    spark = docs.sparkSession
    parts = max(shards(spark), total // KEYS + 1)
    folder = shared_dir(spark, "gram-counts")
    map_texts(docs, _count_grams(n, parts), _COUNTS).groupBy("shard").applyInArrow(_write_counts(folder), "shard int").write.parquet(shared_dir(spark, "gram-counts-done"))
    near = map_texts(docs, closing(_signed(n, percent, parts, counts := Shards(folder, parts, 9)), counts), _BLOCK).groupBy("shard").applyInArrow(_shared_keys, _LINK)
    region = components(written(near, "near"))
    texts = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = region.join(texts, "node").select("doc_id", "node", F.col("component").alias("region"), F.pmod("node", F.lit(parts)).cast("int").alias("shard"))
    folder = shared_dir(spark, "wanted")
    wanted.groupBy("shard").applyInArrow(_write_wanted(folder), "shard int").write.parquet(shared_dir(spark, "wanted-done"))
    wanted = Shards(folder, parts, 32)
    members = written(map_texts(docs, closing(_with_sets(n, wanted, set(map(int, done(folder)))), wanted), _MEMBER), "members")
    links = written(_links(members, percent), "links")
    return rows, members, links


def jaccard_components(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id that links reach), class_id (smallest doc_id with the same set), links (how many other sets the row's set links with)."""
    rows, members, links = _join(documents, n, percent)
    return _result(rows, links, written(_degrees(members, percent), "degrees"))


def _write_kept(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Writes one shard's sets of groups, in order: the set, the id of the row that stays (and whether it has one), and the state."""
        node = table.column("node").to_numpy()
        order = np.argsort(node.view(U64))
        doc, state = table.column("id"), table.column("state").to_numpy()
        put(f"{folder}/{key[0].as_py()}", [node[order], doc.fill_null(0).to_numpy()[order], doc.is_valid().to_numpy().astype(np.int64)[order], state[order]])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())})

    return run


#: States of a set that is in a group: all its rows go, one row stays, one of several equal rows stays.
GONE, STAYS, REPEATED = 0, 1, 2


def _kept_rows(n: int, kept: Shards, present: set[int], repeated: str | None = None):
    """The rows that stay: those of no group and a group's only one, or else the equal rows of which one stays, with their set in a column named `repeated`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gram, at = shingle_sets(batch.column("text").cast(pa.string()).fill_null(""), n)
            digest, doc = digests(gram, at), batch.column("doc_id").cast(pa.int64())
            known, doc = doc.is_valid().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy()
            stays = np.full(len(digest), repeated is None)
            shard = digest % kept.parts
            for p in np.unique(shard).tolist():
                if p in present:
                    keys, rest = kept.open(p)
                    rest = rest.view(np.int64).reshape(3, -1)
                    mine = np.flatnonzero(shard == p)
                    k = find(keys, digest[mine].view(U64))
                    mine, k = mine[k >= 0], k[k >= 0]
                    own = (rest[1, k] == known[mine]) & (rest[0, k] == doc[mine])
                    stays[mine] = own & (rest[2, k] == (REPEATED if repeated else STAYS))
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(digest)], names=[*batch.schema.names, repeated]) if repeated else batch
            yield out.filter(pa.array(stays))

    return run


def one_of_each(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """One row of each group of sets that links connect, whatever their ids: one with the smallest id, or without one where none has any.

    Groups are decided on ids and digests alone and kept as sorted arrays that
    workers map, so rows are filtered where they are read; only equal rows (one
    id, one set) that stand first in their group meet in a shuffle.  Of rows
    without words only repeated ones (id and text) go.
    """
    rows, _, links = _join(documents, n, percent)
    spark, own = documents.sparkSession, documents.columns
    classes = rows.where("node is not null").groupBy("node", "doc_id").count()
    classes = classes.groupBy("node").agg(F.min("doc_id").alias("id"), F.sum("count").alias("n"), F.min_by("count", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("equal"))
    classes = classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = classes.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("first"), F.sum("n").alias("n")).where("n > 1")
    state = F.when(F.col("node") != F.col("first.node"), GONE).when(F.col("equal") == 1, STAYS).otherwise(REPEATED).cast("long")
    parts = max(shards(spark), (rows.count() // SETS) + 1)
    groups = written(classes.drop("n").join(first, "component").select("node", "id", state.alias("state"), F.pmod("node", F.lit(parts)).cast("int").alias("shard")), "groups")
    folder = shared_dir(spark, "kept")
    groups.groupBy("shard").applyInArrow(_write_kept(folder), "shard int").write.parquet(shared_dir(spark, "kept-done"))
    kept, present = Shards(folder, parts, 32), set(map(int, done(folder)))
    worded = documents.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    wordless = documents.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    known = F.col("doc_id").isNotNull()
    out = map_texts(worded, closing(_kept_rows(n, kept, present), kept), documents.schema)
    if groups.where(F.col("state") == REPEATED).head(1):
        name = "_set"
        while name in own:
            name += "_"
        again = map_texts(worded, closing(_kept_rows(n, kept, present, name), kept), StructType([*documents.schema.fields, StructField(name, LongType())]))
        out = out.unionByName(again.dropDuplicates([name]).select(own))
    return out.unionByName(wordless.where(known).dropDuplicates(["doc_id", "text"])).unionByName(wordless.where(~known))


def _result(rows: DataFrame, links: DataFrame, degree: DataFrame) -> DataFrame:
    # rows that share a doc_id share their component
    again = rows.where("node is not null and doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b")
    label = components(links.unionByName(again))
    copies = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("class_id"))
    label = copies.join(label, "node", "left").select("node", "class_id", F.coalesce("component", "node").alias("component"))
    least = label.groupBy("component").agg(F.min("class_id").alias("component_id"))
    label = label.join(least, "component").drop("component")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = rows.join(label, "node", "left").select("node", "doc_id", "n_shingles", own.alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.join(degree, "node", "left").select("doc_id", "n_shingles", "component_id", "class_id", F.coalesce("links", F.lit(0)).alias("links"))
