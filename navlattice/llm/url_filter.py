"""URL filtering by rules and by empirical-Bayes host reputation.

Pages that a rule decides are the labelled outcomes.  They are summed by host,
registered domain and suffix.  At each level the units' shares have a beta
prior round the posterior mean of the level above, and counts are binomial in
them.  The prior's strength, alpha + beta, comes from the moments of the
beta-binomial: the spread of the shares round their parents' means beyond what
binomial counts of their sizes spread by themselves.  A page without a rule is
blocked if the lower bound, a quantile of its host's beta posterior, exceeds
the threshold.

Sums are shuffled for the reputation; pages are then joined with their hosts,
domains with suffixes and hosts with domains, hot keys dealt out.  URLs are
cut to host and path before any row moves.

Defined cases: null URLs and ones without `://` have an empty host and path
and the reputation of the empty host; a host without dots is its own domain
and suffix; no labelled page at all leaves an even prior, so nothing is
blocked; levels whose units have one labelled page each tell nothing of their
spread and count as alike; very long URLs are judged whole; repeated rows are
judged each for itself and count each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join, written

# The contract's rules (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels below which domains are registered.
TWO_LABEL = r"(^|\.)((co|com|org|net|ac|gov|edu)\.[a-z]{2})$"
#: The posterior's lower quantile, the share of blocked pages that it must exceed, and the bounds of a prior's strength.
TAIL, THRESHOLD = 0.05, 0.5
WEAKEST, STRONGEST = 1.0, 1000.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule(rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    text = verdict = F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _strength(units: DataFrame) -> float:
    """alpha + beta of the beta-binomial whose moments the units (n, bad, prior: their parent's mean) have.

    With intra-class correlation r = 1 / (alpha + beta + 1), n (bad / n - prior)^2
    has the mean v (1 + (n - 1) r), v = prior (1 - prior).
    """
    v = F.col("prior") * (1 - F.col("prior"))
    off = F.col("bad") / F.col("n") - F.col("prior")
    s, plain, more = units.where("n > 0").agg(F.sum(F.col("n") * off * off), F.sum(v), F.sum(v * (F.col("n") - 1))).first()
    if not more:
        return STRONGEST
    r = min(max((s - plain) / more, 1 / (STRONGEST + 1)), 1 / (WEAKEST + 1))
    return 1 / r - 1


def incomplete_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """P(X <= x) of a beta distribution, by its continued fraction."""
    turn = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(turn, 1 - x, x), np.where(turn, b, a), np.where(turn, a, b)
    log = np.array([math.lgamma(p + q) - math.lgamma(p) - math.lgamma(q) for p, q in zip(a.tolist(), b.tolist(), strict=True)])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(log + a * np.log(x) + b * np.log1p(-x)) / a
    tiny = 1e-300
    c, d = np.ones_like(x), 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h, m = d.copy(), 0
    moving = np.ones(len(x), bool)
    while moving.any():
        m += 1
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            h = np.where(moving, h * c * d, h)
        moving &= np.abs(c * d - 1) > 1e-12
    p = np.where(x <= 0, 0.0, np.minimum(front * h, 1.0))
    return np.where(turn, 1 - p, p)


def beta_quantile(p: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The value that a beta variable stays below with probability p, by halving."""
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(50):
        mid = (low + high) / 2
        less = incomplete_beta(mid, a, b) < p
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    return (low + high) / 2


def _bounds(tail: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            (a, b), of = np.unique(np.stack([a, b]), axis=1, return_inverse=True)
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array((a / (a + b))[of]), pa.array(beta_quantile(tail, a, b)[of])], names=["host", "mean", "bound"])

    return run


def reputation(hosts: DataFrame, tail: float = TAIL) -> DataFrame:
    """hosts (host, n, bad, with n = 0 for unlabelled ones) with the mean and a lower quantile of the posterior share of blocked pages."""
    suffix = F.when(F.col("host").rlike(TWO_LABEL), F.regexp_extract("host", TWO_LABEL, 2)).otherwise(F.substring_index("host", ".", -1))
    domain = F.when(F.col("host").rlike(TWO_LABEL), F.substring_index("host", ".", -3)).otherwise(F.substring_index("host", ".", -2))
    hosts = written(hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    domains = written(hosts.groupBy("domain").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = written(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    mean = lambda k: (F.col("bad") + k * F.col("prior")) / (F.col("n") + k)
    suffixes = suffixes.withColumn("prior", F.lit((bad + 0.5) / (n + 1)))
    k = _strength(suffixes)
    domains = written(salted_join(domains, suffixes.select("suffix", mean(k).alias("prior")), "suffix", F.col("domain")), "domains")
    k = _strength(domains)
    hosts = written(salted_join(hosts, domains.select("domain", mean(k).alias("prior")), "domain", F.col("host")), "hosts")
    k = _strength(hosts)
    posterior = hosts.select("host", (F.col("bad") + k * F.col("prior")).alias("a"), (F.col("n") - F.col("bad") + k * (1 - F.col("prior"))).alias("b"))
    return posterior.mapInArrow(_bounds(tail), "host string, mean double, bound double")


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and the host's mean and bound."""
    host, path = parts(F.col("url").cast("string"))
    text, verdict = _rule(rules)
    pages = pages.select("page_id", host.alias("host"), path.alias("path")).select("page_id", "host", "path", text.alias("rule"), verdict.alias("ruled"))
    pages = written(pages, "urls")
    labelled = F.col("ruled").isNotNull()
    hosts = pages.groupBy("host").agg(F.count(F.when(labelled, 1)).alias("n"), F.count(F.when(F.col("ruled") == "block", 1)).alias("bad"))
    known = written(reputation(hosts), "reputation")
    own = F.when(F.col("bound") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    out = salted_join(pages, known, "host", F.struct("page_id", "path"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "mean", "bound")
