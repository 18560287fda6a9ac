"""The learned operators against plain versions: language model, language identification, quality, reputation."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navlattice.llm import language, lm_scoring, quality, queries, url_filter
from navlattice.llm.common import put

END, START = "</s>", "<s>"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def fold(i, mod):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod == 0


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")), END]


class PlainKneserNey:
    """Counts in dictionaries, formulas as published."""

    def __init__(self, texts):
        self.count, self.pair = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.count.update(w)
            self.pair.update(zip([START, *w], w))
        self.into = Counter(w for _, w in self.pair)
        self.total, self.followers = Counter(), defaultdict(Counter)
        for (u, _), c in self.pair.items():
            self.total[u] += c
            self.followers[u][min(c, 3)] += 1
        self.d2, self.d1 = self.discounts(self.pair.values()), self.discounts(self.into.values())
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.all, self.seen = sum(self.into.values()), Counter(min(c, 3) for c in self.into.values())

    @staticmethod
    def discounts(counts):
        n = Counter(min(c, 5) for c in counts)
        if min(n[i] for i in (1, 2, 3, 4)) == 0:
            return 0, 0.5, 0.5, 0.5
        y = n[1] / (n[1] + 2 * n[2])
        return 0, *(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i) for i in (1, 2, 3))

    def low(self, w):
        if not self.all:
            return 1 / (self.v + 1)
        gamma = sum(self.d1[i] * self.seen[i] for i in (1, 2, 3)) / self.all
        c = self.into[w]
        return max(c - self.d1[min(c, 3)], 0) / self.all + gamma / (self.v + 1)

    def p(self, u, w):
        if not self.total[u]:
            return self.low(w)
        c = self.pair[u, w]
        back = sum(self.d2[i] * self.followers[u][i] for i in (1, 2, 3))
        return (max(c - self.d2[min(c, 3)], 0) + back * self.low(w)) / self.total[u]

    def check(self, row, text):
        w = tokens(text)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(w), sum(self.count[x] > 0 for x in w), self.n)
        base = sum(math.log10((self.count[x] + 0.1) / (self.n + 0.1 * (self.v + 1))) for x in w)
        assert row.base_score == pytest.approx(base, rel=1e-9, abs=1e-6)
        assert row.score == pytest.approx(sum(math.log10(self.p(u, x)) for u, x in zip([START, *w], w)), rel=1e-9, abs=1e-6)


def test_scores(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    plain = PlainKneserNey(t for i, t in docs.items() if not fold(i, 10))
    rows = queries.op1_lm_scoring(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == fold(r.doc_id, 10)
        plain.check(r, docs[r.doc_id])


def test_scores_of_odd_rows(spark, monkeypatch):
    """Nulls, empty and very long texts, repeated rows, clashing columns, split words, no training rows, no rows."""
    monkeypatch.setattr(lm_scoring, "SPLIT", 50)
    rows = [(i, f"word{i % 7} and the the w{i} \t end", "x", True) for i in range(40)] + [(41, "", "x", True), (42, None, "x", None), (42, None, "x", None), (None, "a b", "x", True), (44, "A the " * 30_000, "x", True), (45, "é\u3000ü \x0b the", "x", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, held_out boolean")
    plain = PlainKneserNey(t for i, t, *_ in rows if not fold(i, 10))
    got = lm_scoring.lm_scores(docs).collect()
    assert len(got) == len(rows)
    texts = dict((r[0], r[1]) for r in rows)
    for r in got:
        plain.check(r, texts[r.doc_id])
    assert lm_scoring.lm_scores(docs.limit(0)).count() == 0
    (alone,) = lm_scoring.lm_scores(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert alone.held_out and alone.train_tokens == alone.n_known == 0 and alone.score == 0.0


def test_counts_beyond_32_bits(tmp_path):
    """Blocks of one pair whose counts add up to more than 2**32 come back whole."""
    u = np.array([7], np.uint64)
    block = lambda w, c: lm_scoring._row(0, "pair", u.tobytes() + np.array([1], np.uint32).tobytes(), np.array([w], np.uint64).tobytes(), np.array([c], np.uint32).tobytes(), 1)
    blocks = [block(9, 4_000_000_000), block(9, 4_000_000_000), block(11, 3)]
    lm_scoring._sum_pairs(1, str(tmp_path))((pa.scalar(0, pa.int32()),), pa.Table.from_batches(blocks))
    model = lm_scoring.Model(str(tmp_path), 1, np.zeros(0, np.uint64), 0, 0, (0, 0, 0), (0, 0, 0), 0, np.zeros(3), {"pair-0"})
    assert model.pairs(np.array([7, 7, 7], np.uint64), np.array([11, 9, 10], np.uint64)).tolist() == [3, 8_000_000_000, 0]
    put(f"file://{tmp_path}/x", [np.zeros(1)])


def plain_grams(text):
    out = Counter()
    clean = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
    for word in clean.split(" "):
        if word:
            padded = f" {word} "
            out.update(word)
            out.update(padded[i : i + 2] for i in range(len(padded) - 1))
            out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


def ranked(grams, top=300):
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], number(x[0])))[:top]]


def test_language_against_plain_profiles(spark, sf):
    docs = {r.doc_id: (r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = defaultdict(Counter)
    for i, (t, lang) in docs.items():
        if lang is not None and not fold(i, 5):
            counts[lang].update(plain_grams(t))
    profiles = {lang: {g: r for r, g in enumerate(ranked(c))} for lang, c in counts.items() if c}
    for r in queries.op8_language_id(spark, sf).collect():
        mine = ranked(plain_grams(docs[r.doc_id][0]))
        if not mine:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        away = {lang: sum(abs(p[g] - k) if g in p else 300 for k, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(away), key=away.get)
        assert r.lang_pred == best and r.score == pytest.approx(1 - away[best] / (300 * len(mine)), abs=1e-12)


def test_letters_of_all_planes():
    letter, _ = language.tables()
    for c in (0x30000, 0x3134A, 0x323B0, 0x1F600, 0x41, 0x4E00):
        assert letter[c] == chr(c).isalpha()


def test_quality_against_plain_densities(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    x = {r.doc_id: np.array(r.x) for r in quality.statistics(docs).collect()}
    wanted = [(x[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in x and r.quality is not None and not fold(r.doc_id, 5)]
    groups = {c: np.array([v for v, q in wanted if q == c]) for c in (0, 1)}
    own = {c: np.cov(g, rowvar=False, bias=True) for c, g in groups.items()}
    n = {c: len(g) for c, g in groups.items()}
    all_ = (own[0] * n[0] + own[1] * n[1]) / (n[0] + n[1])
    scale = np.sqrt(np.diag(all_))
    density = {}
    for c in (0, 1):
        cov = ((1 - quality.POOLED) * own[c] + quality.POOLED * all_) / np.outer(scale, scale)
        cov = (1 - quality.IDENTITY) * cov + quality.IDENTITY * np.eye(len(cov)) * np.trace(cov) / len(cov)
        inverse, (_, log) = np.linalg.inv(cov), np.linalg.slogdet(cov)
        mean = groups[c].mean(0)
        density[c] = lambda v, m=mean, i=inverse, d=log, k=n[c]: math.log(k) - 0.5 * (((v - m) / scale) @ i @ ((v - m) / scale) + d)
    for r in queries.op9_quality(spark, sf).collect():
        v = x[r.doc_id]
        want = 1 / (1 + math.exp(min(max(density[0](v) - density[1](v), -700), 700)))
        assert r.held_out == fold(r.doc_id, 5) and r.score == pytest.approx(want, abs=1e-6) and r.predicted == (r.score >= 0.3)


def plain_beta_below(x, a, b, steps=400_000):
    """P(X <= x) by the midpoint rule over the logit."""
    if not 0 < x < 1:
        return float(x >= 1)
    top, low = math.log(x) - math.log1p(-x), -max(50.0, 50 / a)
    u = low + (np.arange(steps) + 0.5) * (top - low) / steps
    body = np.exp(-a * np.logaddexp(0, -u) - b * np.logaddexp(0, u) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)).sum()
    return body * (top - low) / steps


def plain_strength(units):
    units = [u for u in units if u[0] > 0]
    v = [m * (1 - m) for _, _, m in units]
    s = sum(n * (bad / n - m) ** 2 for n, bad, m in units)
    more = sum(w * (n - 1) for w, (n, _, _) in zip(v, units))
    return 1000.0 if not more else 1 / min(max((s - sum(v)) / more, 1 / 1001), 1 / 2) - 1


def domain_of(host):
    two = re.search(r"(^|\.)((co|com|org|net|ac|gov|edu)\.[a-z]{2})$", host)
    parts = host.split(".")
    return (".".join(parts[-3:]), two[2]) if two else (".".join(parts[-2:]), parts[-1])


def check_reputation(rows, threshold=0.5):
    hosts = defaultdict(lambda: [0, 0])
    for r in rows:
        hosts[r.host][0] += r.rule is not None
        hosts[r.host][1] += r.rule is not None and r.verdict == "block"
    domains, suffixes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for h, (n, bad) in hosts.items():
        d, s = domain_of(h)
        for t, k in ((domains, d), (suffixes, s)):
            t[k][0] += n
            t[k][1] += bad
    n, bad = (sum(v[i] for v in suffixes.values()) for i in (0, 1))
    root = (bad + 0.5) / (n + 1)
    k = plain_strength([(n, b, root) for n, b in suffixes.values()])
    top = {s: (b + k * root) / (n + k) for s, (n, b) in suffixes.items()}
    suffix_of = {domain_of(h)[0]: domain_of(h)[1] for h in hosts}
    k = plain_strength([(n, b, top[suffix_of[d]]) for d, (n, b) in domains.items()])
    mid = {d: (b + k * top[suffix_of[d]]) / (n + k) for d, (n, b) in domains.items()}
    k = plain_strength([(n, b, mid[domain_of(h)[0]]) for h, (n, b) in hosts.items()])
    for r in rows:
        n, bad = hosts[r.host]
        m = mid[domain_of(r.host)[0]]
        a, b = bad + k * m, n - bad + k * (1 - m)
        assert r.mean == pytest.approx(a / (a + b), rel=1e-9)
        assert plain_beta_below(r.bound, a, b) == pytest.approx(0.05, abs=2e-3)
        assert 0 <= r.bound <= 1
        if r.rule is None:
            assert r.verdict == ("block" if r.bound > threshold else "allow")
    return k


def test_reputation_against_plain(spark, sf):
    check_reputation(url_filter.judge(spark.read.parquet(f"{sf}/pages.parquet")).collect())


def test_reputation_of_hosts(spark):
    """Bad hosts are blocked beyond the rules' paths, good ones not; small hosts follow their domain."""
    urls = [f"http://bad{i % 3}.example.com/de/{i}" for i in range(60)] + [f"http://good{i % 3}.org/fr/{i}" for i in range(60)] + ["http://bad0.example.com/x", "http://new.example.com/x", "http://good1.org/x", "http://fresh.org/y", "http://other.de/", "h://" + "x" * 100_000 + ".net/" + "y" * 100_000, None, "http://a.co.uk/", "http://b.a.co.uk/"]
    rows = url_filter.judge(spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")).collect()
    check_reputation(rows)
    verdict = {r.page_id: r.verdict for r in rows}
    assert [verdict[i] for i in range(120, 126)] == ["block", "block", "allow", "allow", "allow", "block"]
    none = url_filter.judge(spark.createDataFrame([(1, "http://x.de/"), (2, "http://y.fr/")], "page_id long, url string")).collect()
    assert all(r.verdict == "allow" for r in none)


def test_strength_sees_only_the_spread_beyond_counts(spark):
    """Small units of one rate are alike; units of two rates are not."""
    rng = np.random.default_rng(1)
    alike = [(5, int(b), 0.3) for b in rng.binomial(5, 0.3, 3000)]
    apart = [(5, int(rng.binomial(5, p)), 0.3) for p in rng.beta(0.6, 1.4, 3000)]
    strength = lambda rows: url_filter._strength(spark.createDataFrame(rows, "n long, bad long, prior double"))
    assert strength(alike) > 50 and strength(apart) == pytest.approx(2, rel=0.2)
    assert strength(alike) == pytest.approx(plain_strength(alike))
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_beta_quantile():
    a, b = np.array([0.5, 3.0, 20.5, 500.0, 1.0]), np.array([0.5, 1.0, 979.0, 500.0, 1.0])
    for p in (0.05, 0.5, 0.95):
        q = url_filter.beta_quantile(p, a, b)
        assert [plain_beta_below(x, s, t) for x, s, t in zip(q, a, b)] == pytest.approx([p] * 5, abs=2e-3)
        assert q[4] == pytest.approx(p)
