"""Quality classifier: regularised quadratic discriminant over document statistics.

Every whole text becomes a vector of transformed statistics.  Each class has a
mean and a covariance that is shrunk toward the pooled one and toward a scaled
identity; its Cholesky factor is computed once.  The score is the posterior of
class 1 from the difference of the two log densities (Mahalanobis terms and
log determinants) and the log prior.

Texts are measured once, into a narrow table of ids and statistics; only that
table meets the labels, so no text is shuffled at any size.  Training sums are
aggregates of Spark over all labelled training rows; only they (one row a
class) reach the driver.

Defined cases: null and empty texts have the statistics of no characters and
are scored like others; a null label is not learned; a document with several
labels counts once for each; one class alone gives its own label to all, no
label at all 0.5; a null doc_id is held out; repeated rows are scored each for
itself; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .chars import points, tables
from .common import held_out, map_texts, slices, written

#: Shares of the pooled covariance and of the scaled identity.
POOLED, IDENTITY, THRESHOLD = 0.3, 0.02, 0.3
FEATURES = ("words", "word_length", "word_spread", "letters", "upper", "digits", "marks", "spaces", "unique", "top_word", "line_copies", "line_words", "stops", "ended", "packed", "pieces")


def _features(text: str, word: np.ndarray, size: np.ndarray) -> list[float]:
    p = points(text)
    n, m = len(p), len(word)
    letter, lower = tables()
    is_letter = letter[p]
    letters = int(is_letter.sum())
    upper = int((lower[p] != p).sum())
    digits = int(((p >= 48) & (p < 58)).sum())
    spaces = int((p <= 32).sum())
    lines = [x.strip() for x in text.split("\n")]
    lines = [x for x in lines if x]
    _, counts = np.unique(word, return_counts=True)
    share = lambda a, b: (a + 0.5) / (b + 1)
    logit = lambda a, b: float(np.log(share(a, b)) - np.log(share(b - a, b)))
    raw = text.encode("utf-8", "surrogatepass")
    return [
        float(np.log1p(m)),
        float(np.log1p(size.mean())) if m else 0.0,
        float(np.log1p(size.std())) if m else 0.0,
        logit(letters, n),
        logit(upper, letters) if upper <= letters else 0.0,
        logit(digits, n),
        logit(max(n - letters - digits - spaces, 0), n),
        logit(spaces, n),
        float(np.log(share(len(counts), m))),
        logit(int(counts.max(initial=0)), m),
        logit(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(m / max(len(lines), 1))),
        logit(sum(text.count(c) for c in ".!?"), m + n),
        logit(sum(x[-1] in ".!?\"')" for x in lines), len(lines)),
        float(np.log((len(zlib.compress(raw, 1)) + 8) / (len(raw) + 8))),
        logit(text.count("|") + text.count("#") + text.count("{") + text.count("<"), n),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offsets = tv.buffers(batch.column("text"))
        starts, ends, first = tv.spans(data, offsets, tv.SPACE_SEP)
        word, size = tv.hashes(data, starts, ends), ends - starts
        rows = [_features(t.as_py() or "", word[first[i] : first[i + 1]], size[first[i] : first[i + 1]]) for i, t in enumerate(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def statistics(documents: DataFrame) -> DataFrame:
    """Per row: doc_id and x, the transformed statistics in the order of FEATURES."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(docs, _measure, "doc_id long, x array<double>")


def _solved(factor: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Forward substitution: the rows of x by a lower triangular factor."""
    z = np.empty((len(factor), len(x)))
    for i, row in enumerate(factor):
        z[i] = (x[:, i] - row[:i] @ z[:i]) / row[i]
    return z


class Discriminant:
    """Class means, cached Cholesky factors and log determinants."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]], pooled: float = POOLED, identity: float = IDENTITY):
        self.prior = {c: s[0] for c, s in sums.items() if s[0]}
        self.parts = {}
        total = sum(self.prior.values())
        scatter = {c: sums[c][2] - np.outer(sums[c][1], sums[c][1]) / sums[c][0] for c in self.prior}
        all_ = sum(scatter.values()) / max(total, 1) if scatter else None
        self.scale = np.sqrt(np.maximum(np.diag(all_), 1e-9)) if scatter else None
        for c, n in self.prior.items():
            own = scatter[c] / n
            cov = ((1 - pooled) * own + pooled * all_) / np.outer(self.scale, self.scale)
            cov = (1 - identity) * cov + identity * np.eye(len(cov)) * max(np.trace(cov) / len(cov), 1e-9)
            factor = np.linalg.cholesky(cov)
            self.parts[c] = (sums[c][1] / n, factor, 2 * np.log(np.diag(factor)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 for each row."""
        if len(self.parts) < 2:
            return np.full(len(x), float(next(iter(self.parts))) if self.parts else 0.5)
        log = {}
        for c, (mean, factor, determinant) in self.parts.items():
            z = _solved(factor, (x - mean) / self.scale)
            log[c] = np.log(self.prior[c]) - 0.5 * ((z * z).sum(0) + determinant)
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(labelled: DataFrame) -> Discriminant:
    """labelled: (x, quality) rows."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    columns = [F.sum(F.col("x")[i]) for i in range(d)] + [F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in pairs]
    rows = labelled.where("quality in (0, 1)").groupBy("quality").agg(F.count("*").alias("n"), F.array(*columns).alias("s")).collect()
    sums = {}
    for c, n, s in rows:
        s = np.array(s)
        second = np.zeros((d, d))
        for (i, j), v in zip(pairs, s[d:], strict=True):
            second[i, j] = second[j, i] = v
        sums[int(c)] = (n, s[:d], second)
    return Discriminant(sums)


def train(measured: DataFrame, labels: DataFrame, folds: int = 5) -> Discriminant:
    """Learns from all labelled rows of `measured` (doc_id, x) outside fold 0."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(~held_out(F.col("doc_id"), folds) & F.col("quality").isNotNull())
    return fit(measured.join(labels, "doc_id"))


def score(measured: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `measured` (doc_id, x): doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
                s = model.score(x)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return measured.mapInArrow(run, "doc_id long, score double, predicted int")


def quality_scores(documents: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    measured = written(statistics(documents), "statistics")
    model = train(measured, labels, folds)
    return score(measured, model).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", "predicted")


def keep(documents: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([row for b in _measure(iter([batch])) for row in b.column("x").to_pylist()])
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return map_texts(documents, run, documents.schema)
