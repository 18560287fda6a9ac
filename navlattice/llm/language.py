"""Language identification by rank-order profiles (out-of-place distance).

A language's profile is the list of its TOP most frequent letter n-grams (one
to three characters, words padded with a blank).  A document's own list is
compared with it: each n-gram adds the difference of its ranks, or TOP where
the profile lacks it; the language with the smallest sum wins.

Training counts are summed in every task before they are shuffled.  The top
lists are taken in two steps, first among dealt-out parts of a language, so
no task meets a language's whole vocabulary.  The profiles (TOP rows a
language, at most LANGUAGES of them, checked) are the only data sent to
workers.

Defined cases: null texts and ones without a letter are `und` with score 0; a
null lang is not learned; nothing learned makes every document `und`; equal
distances go to the language first in order; a null doc_id is held out;
repeated rows count and are scored each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chars import points, tables
from .common import find, held_out, map_texts, slices, totals, written

TOP, LANGUAGES, PARTS = 300, 10_000, 64


def ngrams(text: str) -> np.ndarray:
    """All n-grams of one to three characters of the words, as numbers; none crosses a blank inside."""
    letter, lower = tables()
    p = lower[points(text)].astype(np.int64)
    is_letter = letter[p]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    p = np.where(is_letter, p, 0x20)
    p = np.concatenate([[0x20], p, [0x20]])
    word = p != 0x20
    one = p[word]
    two = (p[:-1] << 21 | p[1:])[word[:-1] | word[1:]]
    three = (p[:-2] << 42 | p[1:-1] << 21 | p[2:])[word[1:-1]]
    return np.concatenate([one, two, three])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            k, n = totals(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in slices(batches):
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            k, n = np.unique(ngrams(text.as_py() or ""), return_counts=True)
            if len(k):
                held.setdefault(lang, []).append((k, n))
                size += len(k)
        if size > 4_000_000:
            for lang, parts in held.items():
                held[lang] = [totals(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))]
            size = sum(len(p[0][0]) for p in held.values())
            if size > 2_000_000:
                yield from flush()
                size = 0
    yield from flush()


def train(documents: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles: for each language its n-grams, most frequent first."""
    counts = map_texts(documents.where("text is not null and lang is not null").select("text", "lang"), _count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = (F.desc("n"), F.asc("gram"))
    part = F.pmod(F.xxhash64("gram"), F.lit(PARTS))
    for keys in (["lang", part], ["lang"]):
        counts = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    best = written(counts, "profiles")
    if best.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} language values")
    out: dict[str, list] = {}
    for lang, gram in best.orderBy("lang", "rank").select("lang", "gram").collect():
        out.setdefault(lang, []).append(gram)
    return {lang: np.array(g, np.int64) for lang, g in out.items()}


class Profiles:
    """All profiles over one sorted vocabulary, as a matrix of ranks."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int = TOP):
        self.langs, self.top = sorted(profiles), top
        self.vocabulary = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        self.rank = np.full((len(self.langs), len(self.vocabulary)), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.rank[i, find(self.vocabulary, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        gram, n = np.unique(ngrams(text or ""), return_counts=True)
        if not len(gram) or not self.langs:
            return "und", 0.0
        mine = gram[np.lexsort((gram, -n))[: self.top]]
        at = find(self.vocabulary, mine)
        ranks = np.where(at >= 0, self.rank[:, at], -1)
        away = np.where(ranks >= 0, np.abs(ranks - np.arange(len(mine))), self.top).sum(1)
        best = int(np.argmin(away))
        return self.langs[best], 1 - float(away[best]) / (self.top * len(mine))


def predict(documents: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP) -> DataFrame:
    """Per row: doc_id, lang_pred, score (1: the document's list is the profile's)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, top)
        for batch in slices(batches):
            got = [model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(docs, run, "doc_id long, lang_pred string, score double")


def language_id(documents: DataFrame, folds: int = 5) -> DataFrame:
    """Learns from the documents outside fold 0 and predicts all: doc_id, held_out, lang_pred, score."""
    profiles = train(documents.where(~held_out(F.col("doc_id"), folds)))
    return predict(documents, profiles).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score")
