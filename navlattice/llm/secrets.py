"""Secret scanning through nested encodings: a worklist of layers, unwrapped to the fixpoint.

The text is the first layer.  Every layer is searched for secrets and for
encoded runs (percent escapes, Unicode escapes, base64) and compressed streams;
each that decodes becomes a further layer on the list.  Layers are bytes, as
all patterns are ASCII.  A layer carries, for each of its bytes, where that
byte began and ended in the original, so a secret found at any depth has a span
there; what comes out of a compressed stream has the stream's place.  The
layers met so far are kept by their bytes and places: one that comes again is
not unwrapped again, so the list runs dry.

Escapes of one kind are decoded over a whole layer, so that a secret keeps its
key and what else stands around them; a base64 run is a message of its own.
Base64 is read at all four alignments of a run, in the standard alphabet, the
URL-safe one and both together, and over line ends.
Compressed streams are opened wherever they begin in a decoded layer, all
members of a stream end to end, at any depth; bare deflate has no mark and is
tried where a base64 message begins.  Runs of two-byte ASCII, of either order,
in a decoded layer become a layer of single bytes.  A layer of over INFLATED bytes
goes on in an unlinked file that is mapped and searched whole like any other.

Defined cases: null and empty texts have no spans; bytes that
are no text stay in their layer and match nothing, what stands between them is
searched; a damaged gzip stream counts as far as it can be read; very long
texts are searched whole, one row at a time; repeated rows are searched each
for itself; other columns are carried along by `redact` and ignored by
`find_secrets`.
"""

from __future__ import annotations

import binascii
import hashlib
import mmap
import re
import tempfile
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, slices

KINDS = ("assign", "access", "hex")
# The patterns of the contract.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
_IN_TEXT = (ASSIGN, ACCESS, HEX)
_IN_BYTES = tuple(re.compile(p.pattern.encode()) for p in _IN_TEXT)

_PERCENT = re.compile(rb"%(?:[uU]([0-9A-Fa-f]{4})|([0-9A-Fa-f]{2}))")
# characters of two bytes, the second or the first of them zero
_WIDE = tuple(re.compile(x) for x in (rb"(?:[\x09\x0A\x0D\x20-\x7E]\x00){8,}", rb"(?:\x00[\x09\x0A\x0D\x20-\x7E]){8,}"))
_ESCAPE = re.compile(rb"\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
_BREAK = re.compile(rb"[\t\x20]*(?:\r?\n|(?:\\r)?\\n)[\t\x20]*")
_WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\t\x20]*+(?:\r?\n|(?:\\r)?\\n)[\t\x20]*+[A-Za-z0-9+/_-]++)++={0,2}")
# what splits a run, and the longest pieces without it
_ALPHABETS = ((re.compile(rb"[_-]"), re.compile(rb"[^_-]{16,}")), (re.compile(rb"[+/]"), re.compile(rb"[^+/]{16,}")))
_GZIP = b"\x1f\x8b\x08"
# gzip's first bytes, or a zlib header: method 8, no dictionary, a multiple of 31
_PACKED = re.compile(b"|".join([re.escape(_GZIP), *(re.escape(bytes([c])) + b"[" + b"".join(b"\\x%02x" % f for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 0x20) + b"]" for c in range(0x08, 0x80, 0x10))]))
_STANDARD = bytes.maketrans(b"-_", b"+/")
#: Bytes of one decoded layer that are held in memory; a larger one is a mapped file.
INFLATED = 64 << 20
#: Compressed bytes opened at once: at most 1032 times as many come out.
PIECE = 4096


def plain_spans(text, patterns=_IN_TEXT) -> list[tuple[str, int, int]]:
    """The contract's matches in one layer: leftmost, non-overlapping for each kind."""
    assign, access, hexes = patterns
    out = [("assign", m.start(), m.end()) for m in assign.finditer(text) if m.end(1) - m.start(1) >= 8]
    out += [("access", m.start(), m.end()) for m in access.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in hexes.finditer(text)]
    return out


class Layer:
    """Bytes between lo and hi of the original, with the places of each, which may be a function; without places each has the whole place."""

    def __init__(self, raw, lo: int, hi: int, places: tuple[np.ndarray, np.ndarray] | Callable | None = None, message: bool = False):
        self.raw, self.lo, self.hi, self._places, self.message = raw, lo, hi, places, message

    def places(self) -> tuple[np.ndarray, np.ndarray] | None:
        if callable(self._places):
            self._places = self._places()
        return self._places

    def span(self, a: int, z: int) -> tuple[int, int]:
        if (places := self.places()) is None:
            return self.lo, self.hi
        return int(places[0][a]), int(places[1][z - 1])

    def key(self, a: int, z: int) -> tuple:
        h = hashlib.blake2b(memoryview(self.raw)[a:z], digest_size=16)
        if (places := self.places()) is not None:
            h.update(places[0][a:z])
        return h.digest(), *self.span(a, z)


def _first(text: str) -> Layer:
    raw = text.encode("utf-8", "surrogatepass")

    def places():
        k = np.arange(len(raw), dtype=np.int32) if len(raw) == len(text) else np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80, dtype=np.int32) - 1
        return k, k + 1

    return Layer(raw, 0, len(text), places)


class Sink:
    """Bytes as they come, in memory or, once they are many, in an unlinked file."""

    def __init__(self):
        self.held, self.file = bytearray(), None

    def write(self, data) -> None:
        if self.file is not None:
            self.file.write(data)
            return
        self.held += data
        if len(self.held) > INFLATED:
            self.file = tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held = bytearray()

    def done(self):
        if self.file is None:
            return bytes(self.held)
        with self.file:
            self.file.flush()
            return mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)


def _member(view: memoryview, at: int, sink: Sink) -> tuple[int, bool]:
    """Opens one stream; where it ended, and whether it was whole."""
    d = zlib.decompressobj(47)
    while at < len(view) and not d.eof:
        before, piece = d.copy(), view[at : at + PIECE]
        try:
            out = d.decompress(piece)
        except zlib.error:  # what comes before the damage
            for k in range(len(piece)):
                try:
                    sink.write(before.decompress(piece[k : k + 1]))
                except zlib.error:
                    return at + k, False
            return at + len(piece), False
        sink.write(out)
        at += len(piece) - len(d.unused_data)
    return at, d.eof


def _streams(layer: Layer) -> Iterator[Layer]:
    """What the compressed streams of a layer hold; members that follow each other are one stream."""
    at, view = 0, memoryview(layer.raw)
    while m := _PACKED.search(layer.raw, at):
        sink, start = Sink(), m.start()
        stop, whole = _member(view, start, sink)
        # two bytes within a layer prove nothing without the stream's checksum
        if not whole and m[0] != _GZIP and start:
            at = start + 1
            continue
        while whole:
            follow = re.compile(rb"\x00*").match(layer.raw, stop).end()
            if not _PACKED.match(layer.raw, follow):
                break
            stop, whole = _member(view, follow, sink)
        raw = sink.done()
        if len(raw):
            yield Layer(raw, layer.lo if start == 0 else layer.span(start, stop)[0], layer.hi if stop == len(view) else layer.span(start, stop)[1])
        at = max(stop, start + 1)


def _replaced(layer: Layer, escape: re.Pattern, value: Callable[[re.Match], bytes]) -> Layer | None:
    """The whole layer with its escapes decoded, everything else as it is."""
    sink, at, cuts = Sink(), 0, []
    for m in escape.finditer(layer.raw):
        new = value(m)
        sink.write(layer.raw[at : m.start()])
        sink.write(new)
        cuts.append((m.start(), m.end(), len(new)))
        at = m.end()
    if not cuts:
        return None
    sink.write(layer.raw[at:])
    places = layer.places()
    if places is not None:
        start, stop, size = np.array(cuts, dtype=np.int64).T
        inside = np.zeros(len(layer.raw) + 1, dtype=np.int8)
        inside[start] += 1
        np.add.at(inside, stop, -1)
        kept = np.flatnonzero(np.cumsum(inside, dtype=np.int8)[:-1] == 0)
        first, last = np.concatenate([kept, np.repeat(start, size)]), np.concatenate([kept, np.repeat(stop - 1, size)])
        order = np.argsort(first, kind="stable")
        places = places[0][first[order]], places[1][last[order]]
    return Layer(sink.done(), layer.lo, layer.hi, places)


def _percent(m: re.Match) -> bytes:
    if m[1]:
        code = int(m[1], 16)
        return bytes([code]) if code < 256 else chr(0xFFFD if 0xD800 <= code < 0xE000 else code).encode()
    return bytes([int(m[2], 16)])


def _narrow(layer: Layer) -> Iterator[Layer]:
    """Runs of two-byte ASCII as single bytes."""
    if layer.raw.find(b"\0") < 0:
        return
    for first, pattern in enumerate(_WIDE):
        for m in pattern.finditer(layer.raw):
            a, z = m.span()
            places = layer.places()
            if places is not None:
                places = places[0][a:z:2].copy(), places[1][a + 1 : z : 2].copy()
            yield Layer(bytes(m[0][first::2]), *layer.span(a, z), places)


def _bare(layer: Layer) -> Iterator[Layer]:
    """What a whole deflate stream without header holds."""
    d, sink, view = zlib.decompressobj(-15), Sink(), memoryview(layer.raw)
    try:
        for at in range(0, len(view), PIECE):
            sink.write(d.decompress(view[at : at + PIECE]))
            if d.eof:
                break
    except zlib.error:
        return
    if d.eof:
        raw = sink.done()
        if len(raw):
            yield Layer(raw, layer.lo, layer.hi)


def _character(m: re.Match) -> bytes:
    if m[1]:
        code = 0x10000 + ((int(m[1], 16) & 0x3FF) << 10 | int(m[2], 16) & 0x3FF)
    else:
        code = int(m[3] or m[4] or m[6] or m[5], 10 if m[5] else 16)
    if code < 256:  # a byte of a binary string, or a character that no pattern has
        return bytes([code])
    return chr(0xFFFD if code > 0x10FFFF or 0xD800 <= code < 0xE000 else code).encode()


def _base64_runs(raw) -> Iterator[tuple[int, int]]:
    """Runs and wrapped runs of both alphabets together, and the pieces that are in one of them."""
    for m in chain(_BASE64.finditer(raw), _WRAPPED.finditer(raw) if raw.find(b"\n") >= 0 or raw.find(b"\\n") >= 0 else ()):
        a, z = m.span()
        if z - a < 16:
            continue
        yield a, z
        for other, piece in _ALPHABETS:
            if other.search(raw, a, z):
                yield from (p.span() for p in piece.finditer(raw, a, z))


def _from_base64(layer: Layer, a: int, z: int) -> Iterator[Layer]:
    """A run decoded at each of its four alignments."""
    raw = layer.raw
    ends = [a, *(x for m in _BREAK.finditer(raw, a, z) for x in m.span()), z]
    lines = [(s, t) for s, t in zip(ends[::2], ends[1::2], strict=True) if s < t]
    if not lines:
        return
    s, t = lines[-1]
    while s < t and raw[t - 1 : t] == b"=":
        t -= 1
    lines[-1] = s, t
    for skip in range(4):
        if skip:  # one letter less than before
            while lines and lines[0][0] == lines[0][1]:
                lines = lines[1:]
            if not lines:
                return
            lines = [(lines[0][0] + 1, lines[0][1]), *lines[1:]]
        sink, left = Sink(), b""
        for s, t in lines:
            for at in range(s, t, PIECE):
                body = left + raw[at : min(at + PIECE, t)]
                whole = len(body) & -4
                left = body[whole:]
                sink.write(_letters(body[:whole]))
        if len(left) > 1:
            sink.write(_letters(left + b"=" * (4 - len(left))))
        out = sink.done()

        def places(lines=lines, size=len(out)):
            begin, end = layer.places()
            letter = np.concatenate([np.arange(s, t) for s, t in lines])
            k = np.arange(size)
            return begin[letter[k * 8 // 6]], end[letter[np.minimum((k * 8 + 7) // 6, len(letter) - 1)]]

        yield Layer(out, *layer.span(next((s for s, t in lines if s < t), a), z), None if layer.places() is None else places, True)


def _letters(body: bytes) -> bytes:
    return binascii.a2b_base64(body.translate(_STANDARD))


def _unwrapped(layer: Layer, seen: set) -> Iterator[Layer | None]:
    """The layers inside a layer, compressed streams aside."""
    raw = layer.raw
    if raw.find(b"%") >= 0:
        yield _replaced(layer, _PERCENT, _percent)
    if raw.find(b"\\") >= 0 or raw.find(b"&#") >= 0:
        yield _replaced(layer, _ESCAPE, _character)
    for a, z in _base64_runs(raw):
        if (key := layer.key(a, z)) not in seen:  # not met in another layer
            seen.add(key)
            yield from _from_base64(layer, a, z)


def all_spans(text: str) -> tuple[list, list]:
    """(base spans, all spans), each sorted by start, kind and end; spans are (kind, start, end) in code points of the text."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = plain_spans(text)
    found = set(base)
    first = _first(text)
    work, seen = [first], set()
    while work:
        layer = work.pop()
        inner = _unwrapped(layer, seen)
        if layer is not first:
            found.update((kind, *layer.span(s, t)) for kind, s, t in plain_spans(layer.raw, _IN_BYTES))
            inner = chain(inner, _streams(layer), _narrow(layer), _bare(layer) if layer.message else ())
        for new in inner:
            if new is not None and len(new.raw) and (key := ("layer", *new.key(0, len(new.raw)))) not in seen:
                seen.add(key)
                work.append(new)
    return sorted(base, key=order), sorted(found, key=order)


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        base, full = [], []
        for text in batch.column("text"):
            b, f = all_spans(text.as_py() or "")
            base.append(_joined(b))
            full.append(_joined(f))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, pa.string()), pa.array(full, pa.string())], names=["doc_id", "base", "spans"])


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, base (the contract's spans) and spans (those and the ones inside encodings), as kind:start:end."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(docs, _scan, "doc_id long, base string, spans string")


def cover(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, replaced by a mark."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, s, e in all_spans(text)[1]:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, column: str = "text") -> DataFrame:
    """All rows and columns, with the secrets in `column` covered; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            clean = [None if t is None else cover(t) for t in (x.as_py() for x in batch.column(column))]
            i = batch.schema.get_field_index(column)
            yield pa.RecordBatch.from_arrays([pa.array(clean, batch.schema.field(i).type) if j == i else c for j, c in enumerate(batch.columns)], names=batch.schema.names)

    return map_texts(documents, run, documents.schema)
