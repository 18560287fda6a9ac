"""Every stage of the pipeline on odd rows, empty tables and clashing columns, and against plain versions."""

import re

import pytest

import corpus_pipeline
from navlattice.llm import decontamination, quality, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, x string, _set long, score string, shard int"
STAGES = dict(corpus_pipeline.STAGES)


def word(i, n=60):
    return " ".join(f"{chr(97 + i % 26)}{i}w{k}" for k in range(n))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder with labels and a benchmark, and documents with nulls, repeats, long texts and clashing columns."""
    folder = str(tmp_path_factory.mktemp("odd"))
    item = " ".join(f"bench{i}" for i in range(20))
    spark.createDataFrame([(1, item), (2, None), (None, "only three words"), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)] + [(5, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    text = {i: word(i) for i in range(1, 40)} | {50: None, 51: "", 52: " \t\n", 53: "a b", 54: item, 55: "long " * 400_000 + "password=abcdefgh1234", 56: "see password=abcdefgh1234 and é 漢字"}
    rows = [(i, t) for i, t in text.items()] + [(3, word(3)), (3, word(70)), (None, word(4)), (None, None), (60, word(5) + " more"), (None, word(71)), (None, word(71)), (None, "")]
    docs = spark.createDataFrame([(i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else "s", None if t is None else len(t), "n", "x", 1, "s", 0) for n, (i, t) in enumerate(rows)], SCHEMA)
    return folder, docs


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_on_odd_rows(spark, odd, name):
    folder, docs = odd
    for part in (docs, docs.limit(0)):
        out = STAGES[name](spark, part, folder)
        assert out.columns == docs.columns and out.schema == docs.schema
        got = out.collect()
        assert len(got) <= part.count()
        for r in got:
            assert (r.node, r.x, r._set, r.score, r.shard) == ("n", "x", 1, "s", 0)


def test_quality_keeps_what_is_not_rejected(spark, odd):
    folder, docs = odd
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    measured = quality.statistics(docs)
    scores = {(r.doc_id, round(r.score, 9)) for r in quality.score(measured, quality.train(measured, labels)).collect()}
    kept = STAGES["quality"](spark, docs, folder)
    again = quality.score(quality.statistics(kept), quality.train(measured, labels)).collect()
    assert all(r.score >= quality.THRESHOLD for r in again)
    assert len(again) == sum(r.score >= quality.THRESHOLD for r in quality.score(measured, quality.train(measured, labels)).collect())
    assert {(r.doc_id, round(r.score, 9)) for r in again} <= scores


def test_near_duplicates_keeps_one_of_each(spark, odd):
    folder, docs = odd
    got = STAGES["near_duplicates"](spark, docs, folder).collect()
    sets = lambda t: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").split()) else frozenset()
    kept = [sets(r.text) for r in got if sets(r.text)]
    for a in range(len(kept)):
        for b in range(a):
            assert 100 * len(kept[a] & kept[b]) < 80 * len(kept[a] | kept[b])
    for r in docs.collect():
        s = sets(r.text)
        assert not s or any(100 * len(s & k) >= 80 * len(s | k) for k in kept)
    assert sum(r.doc_id == 3 for r in got) == 2 and not any(r.doc_id == 60 for r in got)


def test_decontaminate_drops_only_contaminated(spark, odd):
    folder, docs = odd
    bad = {r.doc_id for r in decontamination.contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect() if r.contaminated}
    kept = STAGES["decontaminate"](spark, docs, folder)
    assert bad == {54} and kept.count() == docs.count() - 1 and 54 not in {r.doc_id for r in kept.collect()}


def test_secrets_are_covered(spark, odd):
    folder, docs = odd
    got = {r.doc_id: r for r in STAGES["secrets"](spark, docs, folder).collect() if r.doc_id is not None}
    for i in (55, 56):
        assert "abcdefgh1234" not in got[i].text and "[SECRET]" in got[i].text and got[i].n_chars == len(got[i].text)
    assert got[50].text is None and got[50].n_chars is None and got[51].text == ""


def test_packing_of_odd_rows(spark, odd):
    folder, docs = odd
    pieces = STAGES["packing"](spark, docs, folder).collect()
    assert sum(p.start == 0 for p in pieces) == docs.count()
    assert STAGES["packing"](spark, docs.limit(0), folder).count() == 0


def test_run_ends_in_packed_sequences(spark, sf):
    pieces = corpus_pipeline.run(spark, sf).collect()
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    total = [sum(p.length for p in s) for s in by.values()]
    assert total and all(n == 2048 or n & (n - 1) == 0 for n in total)
    assert [n for _, n in corpus_pipeline.STAGES] and re.match("quality", corpus_pipeline.STAGES[0][0])


def test_long_runs_are_searched_in_time():
    """A megabyte without a break, with escapes, base64 and hex, takes seconds at most."""
    import time

    begin = time.process_time()
    for text in ("%41" + "x" * 1_000_000, "\\u0041" + "x" * 1_000_000, "A" * 1_000_000, "a1" * 500_000, "a%41b\\x41" * 100_000):
        secrets.all_spans(text)
    assert time.process_time() - begin < 20


def _first_of_groups(docs, percent=80, n=5):
    """Plain version: one row, with the smallest id, of each group that links connect."""
    sets = {i: frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if (w := re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) else None for i, t in docs.items()}
    top = {i: i for i in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(docs)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i for i in ids if find(i) == i}


def _contaminated(text, windows, word=re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
    w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit = {k for n in {len(x) for x in windows} for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in windows for k in range(j, j + n)}
    return bool(hit) and 20 * len(hit) >= len(w)


def test_run_against_plain_stages(spark, sf):
    """The documents that reach the packed sequences, and their tokens, are those of plain versions of all stages."""
    from navlattice.llm import packing

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    measured = quality.statistics(spark.read.parquet(f"{sf}/documents.parquet"))
    good = {r.doc_id for r in quality.score(measured, quality.train(measured, spark.read.parquet(f"{sf}/labels.parquet"))).collect() if r.score >= 0.3}
    docs = {i: t for i, t in docs.items() if i in good}
    docs = {i: docs[i] for i in _first_of_groups(docs)}
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        windows |= {tuple(w[k : k + min(13, len(w))]) for k in range(len(w) - min(13, len(w)) + 1) if w}
    docs = {i: secrets.cover(t or "") for i, t in docs.items() if not _contaminated(t, windows)}
    coder = packing.tokenizer(packing.default_tokenizer())
    want = {i: len(coder.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs.items()}
    got = {}
    for p in corpus_pipeline.run(spark, sf).collect():
        assert p.doc_tokens == want[p.doc_id]
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == want
