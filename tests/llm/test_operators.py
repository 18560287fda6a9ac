"""Operators against brute-force versions, and on nulls, empty texts, repeated rows and empty tables."""

import hashlib
import re
import zlib

import pyarrow as pa
import pytest

from navlattice.llm import decontamination, fingerprints, jaccard_join, language, packing, quality, queries, secrets, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, region int"
ODD = [(None, None, None, None, None, "x", 1), (1, "", "en", "s", 0, "x", 1), (2, None, "en", "s", 0, "x", 1), (3, "a b", "en", "s", 3, "x", 1), (3, "a b", "en", "s", 3, "x", 1), (4, "é ü 漢字 \U0001f600 " * 3, "de", "s", 9, "x", 1), (5, "w " * 50_000, "en", "s", 9, "x", 1)]


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def test_secrets_base(spark, sf):
    got = {r.doc_id: r for r in queries.op2_secrets(spark, sf).collect()}
    for i, t in texts(spark, sf).items():
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        want = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got[i].n_assign + got[i].n_access + got[i].n_hex == len(found)


def test_secrets_nested():
    import base64
    from urllib.parse import quote

    plain = "password=abcdefgh1234"
    for run in (base64.b64encode(plain.encode()).decode(), quote(quote(plain, safe=""), safe=""), "".join(f"\\u{ord(c):04x}" for c in plain), base64.b64encode(zlib.compress(plain.encode() * 3)).decode(), base64.b64encode(quote(plain, safe="").encode()).decode()):
        text = f"see {run} here"
        spans = [s for s in secrets.all_spans(text)[1] if s[0] == "assign"]
        assert spans and all(4 <= s and e <= 4 + len(run) for _, s, e in spans), run
        assert "[SECRET]" in secrets.cover(text)
    assert secrets.all_spans("token: AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA")[0][0] == ("assign", 0, 39)


def test_secrets_compressed_layers(monkeypatch):
    """Streams in streams, of several members, larger than what is held in memory, and in escapes."""
    import base64
    import gzip

    plain = b"password=abcdefgh1234"
    far = b"n " * 5000 + plain + b" n" * 5000
    half = gzip.compress(plain[:12]) + gzip.compress(plain[12:])
    raws = [gzip.compress(gzip.compress(plain)), zlib.compress(gzip.compress(zlib.compress(plain))), gzip.compress(b"nothing here") + gzip.compress(plain), half, gzip.compress(far)]
    runs = [base64.b64encode(r).decode() for r in raws]
    runs += ["".join(f"%{c:02X}" for c in raws[0]), "".join(f"\\x{c:02x}" for c in raws[1]), base64.b64encode(gzip.compress(base64.b64encode(far))).decode()]
    for held in (secrets.INFLATED, 100):
        monkeypatch.setattr(secrets, "INFLATED", held)
        for run in runs:
            assert ("assign", 4, 4 + len(run)) in secrets.all_spans(f"see {run} here")[1], run


def test_secrets_key_outside_the_run():
    """A value in escapes whose key is plain, and the reverse: the span reaches over both."""
    for secret in ('api_key": "\\u0041bCdEfGh1234567', "token: abcd%2Fefgh1234", 'password="abc%2Bdefgh12', 'token": "abc&#x2F;defgh12', "p%61ssword: abcd%2Fefgh", "p\\u0061ssword : abcd%2Fefgh"):
        text = f'{{"é": 1, "{secret}"}}'
        at = text.index(secret)
        assert ("assign", at, at + len(secret)) in secrets.all_spans(text)[1], secret


def test_secrets_among_bad_bytes():
    import base64
    import gzip

    binary = bytes(range(128, 256)) * 2
    text = "https://x.org/?q=caf%E9&api_key%3DAbCd1234EfGh"
    assert ("assign", text.index("api"), len(text)) in secrets.all_spans(text)[1]
    run = base64.b64encode(binary + b"\x00password=abcdefgh1234\xff" + binary).decode()
    (span,) = (s for s in secrets.all_spans(f"see {run} here")[1] if s[0] == "assign")
    assert len(binary) * 4 // 3 <= span[1] - 4 <= span[2] - 4 <= len(run) - len(binary) * 4 // 3
    run = base64.b64encode(gzip.compress(binary + b"password=abcdefgh1234" + binary)).decode()
    assert ("assign", 4, 4 + len(run)) in secrets.all_spans(f"see {run} here")[1]


def test_secrets_base64_alignment_alphabets_and_lines():
    import base64
    import gzip

    plain = b"some words?> password=abcdefgh1234"
    run, safe = base64.b64encode(plain).decode(), base64.urlsafe_b64encode(plain).decode()
    for before in ("https://x.io/cb/", "id_", "v1-", "x", "xy", "+/+", "a-b/"):
        for r in (run, safe):
            text = f"{before}{r.rstrip('=')} here"
            (span,) = (s for s in secrets.all_spans(text)[1] if s[0] == "assign")
            assert len(before) + 16 <= span[1] and len(before) + len(r) - 4 <= span[2] <= len(text) - 5, text
    long = base64.b64encode(b"n" * 35 + b" password=abcdefgh1234 " + b"n" * 90).decode()
    packed = base64.b64encode(gzip.compress(bytes(range(256)) + b"password=abcdefgh1234")).decode()
    for width in (64, 76):
        for end in ("\n", "\r\n", "\\n", "\n  "):
            for r in (long, packed):
                wrapped = end.join(r[i : i + width] for i in range(0, len(r), width))
                span = max((s for s in secrets.all_spans(f"see\n{wrapped}\nhere")[1] if s[0] == "assign"), key=lambda s: s[2] - s[1])
                assert 4 <= span[1] < span[2] <= 4 + len(wrapped)
                assert r is packed or span[1] >= 4 + 48 and span[2] <= 4 + 80 + 2 * len(end)


def _layers():
    """Encoders of text to text."""
    import base64
    import gzip
    from urllib.parse import quote

    def bare(t):
        d = zlib.compressobj(9, zlib.DEFLATED, -15)
        return base64.b64encode(d.compress(t.encode()) + d.flush()).decode()

    return {
        "base64": lambda t: base64.b64encode(t.encode()).decode(), "url-safe": lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("="), "percent": lambda t: quote(t, safe=""), "all percent": lambda t: "".join(f"%{c:02x}" for c in t.encode()),
        "wide percent": lambda t: "".join(f"%u{ord(c):04X}" for c in t), "escapes": lambda t: "".join(f"\\u{ord(c):04x}" for c in t), "bytes": lambda t: "".join(f"\\x{c:02x}" for c in t.encode()), "entities": lambda t: "".join(f"&#{ord(c)};" for c in t), "hex entities": lambda t: "".join(f"&#x{ord(c):x};" for c in t),
        "gzip": lambda t: base64.b64encode(gzip.compress(t.encode())).decode(), "zlib": lambda t: base64.b64encode(zlib.compress(t.encode())).decode(), "bare deflate": bare, "percent gzip": lambda t: "".join(f"%{c:02X}" for c in gzip.compress(t.encode())),
        "utf-16": lambda t: base64.b64encode(t.encode("utf-16-le")).decode(), "utf-16 be": lambda t: base64.b64encode(t.encode("utf-16-be")).decode(), "wrapped": lambda t: "\n".join(re.findall(".{1,64}", base64.b64encode(t.encode()).decode())), "after data_": lambda t: "data_" + base64.b64encode(t.encode()).decode(),
    }


def test_secrets_under_every_pair_of_layers():
    """A secret under any one encoding, any two, and chains of up to five: its spans lie in the run, and covering leaves no trace of it."""
    import random

    layers, rnd = _layers(), random.Random(9)
    names = sorted(layers)
    chains = [(a,) for a in names] + [(a, b) for a in names for b in names] + [tuple(rnd.choices(names, k=rnd.randint(3, 5))) for _ in range(60)]
    for chain in chains:
        run = "some words, password=abcdefgh1234 and more"
        for name in chain:
            run = layers[name](run)
            if len(run) > 200_000:
                break
        text = f"é before\n\n{run}\n\nafter"
        lo = len("é before\n\n")
        spans = [x for x in secrets.all_spans(text)[1] if x[0] == "assign"]
        assert spans and all(lo <= a < z <= lo + len(run) for _, a, z in spans), chain
        assert not [x for x in secrets.all_spans(secrets.cover(text))[1] if x[0] == "assign"], chain


def test_urls(spark, sf):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    rows = queries.op3_url_filter(spark, sf).collect()
    urls = {r.page_id: r.url for r in table(spark, sf, "pages").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fit = [k for k in rules if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith(k[k.index("/") :])]
        best = max(fit, key=len, default=None)
        assert (r.host, r.path, r.rule) == (host, path, best)
        assert r.verdict in ("allow", "block") and (best is None or r.verdict == rules[best])


def test_jaccard(spark, sf):
    docs = texts(spark, sf)
    sets = {}
    for i, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    top = {i: i for i in docs}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(docs)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op4_jaccard_join(spark, sf).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in ids}


def test_op4_links_are_all_links(spark, monkeypatch):
    """The numbers of links against all pairs: in tasks, in cells with windows, in chunks and across them."""
    import random

    monkeypatch.setattr(jaccard_join, "WEIGHT", 20_000)
    monkeypatch.setattr(jaccard_join, "LEAF", 16)
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for size, changes in ((90, 3), (60, 1), (40, 6)):
        base = rnd.choices(vocabulary, k=60)
        for _ in range(size):
            words = list(base)
            for _ in range(rnd.randrange(changes + 1)):
                words[rnd.randrange(60)] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    walk = rnd.choices(vocabulary, k=60)  # a chain: far ends, near neighbours
    for _ in range(120):
        walk[rnd.randrange(60)] = rnd.choice(vocabulary)
        texts.append(" ".join(walk))
    texts += [texts[0], "", "a b"]
    frame = spark.createDataFrame([*enumerate(texts), *enumerate(texts[:30])], "doc_id long, text string")
    for n, percent in ((3, 90), (1, 80)):
        sets = [frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if (w := t.split()) else frozenset() for t in texts]
        distinct = set(sets)
        want = [sum(a != b and 100 * len(a & b) >= percent * len(a | b) for b in distinct) for a in sets]
        got = {r.doc_id: r.links for r in jaccard_join.jaccard_components(frame, n, percent).collect()}
        assert max(want) > 20 and [got[i] for i in range(len(sets))] == want


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def check_contamination(rows, docs, items, window=13):
    """rows against all windows of all items; docs: texts by id, items: (id, text) pairs."""
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t or ""))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    sizes = {len(k) for k in windows}
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(docs)
    for i, t in docs.items():
        found = [(m.start(), m.end()) for m in WORD.finditer(lower(t or ""))]
        w = [lower(t)[a:z] for a, z in found]
        hit, who = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                met = windows.get(tuple(w[j : j + n]))
                if met:
                    hit.update(range(j, j + n))
                    who |= met
        names = sorted(str(x) for x in who if x is not None)
        r = got[i]
        assert (r.n_words, r.n_hit, list(r["items"])) == (len(w), len(hit), names)
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        at = lambda c: len(t[:c].encode())
        spans = []
        for j in sorted(hit):
            if spans and spans[-1][2] == j - 1:
                spans[-1][1:] = [at(found[j][1]), j]
            else:
                spans.append([at(found[j][0]), at(found[j][1]), j])
        assert [(x.start, x.end) for x in r.spans] == [(a, z) for a, z, _ in spans]


def test_decontamination(spark, sf):
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    found = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).collect()
    check_contamination(found, texts(spark, sf), items)
    by_id = {r.doc_id: r for r in found}
    for r in queries.op5_decontamination(spark, sf).collect():
        f = by_id[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (f.n_words, f.n_hit, len(f["items"]), f.items_sha256, f.contaminated)


def test_decontamination_with_few_words(spark, monkeypatch):
    """Small vocabularies make long suffix chains, short items lie in long ones, several automata and short stretches give the same."""
    import random

    rnd = random.Random(4)
    make = lambda n: " ".join(rnd.choice("ab") for _ in range(n))
    items = [(i, make(rnd.choice((0, 1, 2, 3, 5, 6, 9, 14)))) for i in range(30) if i] + [(None, "a b a"), (99, None), (7, make(6)), (7, make(6))]
    docs = {i: " ".join(rnd.choice("aabbcéA") for _ in range(rnd.randrange(60))) for i in range(80)} | {100: "a " * 2000, 101: "", 102: make(900)}
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs.items()], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for few in (False, True):
        if few:
            items = [x for x in items if x[1] is None or len(x[1].split()) > 4]
            bench = spark.createDataFrame(items, "item_id long, text string")
        for words, stretch in ((2_000_000, 256), (5, 16)):
            monkeypatch.setattr(decontamination, "BLOCK_WORDS", words)
            monkeypatch.setattr(decontamination, "STRETCH", stretch)
            check_contamination(decontamination.contamination(frame, bench, 6).collect(), docs, items, 6)


def check_packing(rows, docs, window=2048):
    coder = packing.tokenizer(packing.default_tokenizer())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in docs.items():
        ids = [*coder.encode(t, add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            raw = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length])
            assert r.ids_crc32 == zlib.crc32(raw)
            at += r.length
        assert at == len(ids)
    pad = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        pad += 0 if at & (at - 1) == 0 else window - at
    assert pad == 0


def test_packing(spark, sf):
    check_packing(queries.op6_packing(spark, sf).collect(), texts(spark, sf))


def test_packing_rule():
    """The level chosen is one whose use makes the sum of squares smallest."""
    import random

    random.seed(7)
    p = packing.Packer(0, 16)
    for step in range(300):
        x = random.randint(1, 15)
        def total(f):
            n = p.level.copy()
            if f:
                n[f] -= 1
            if f + x < 16:
                n[f + x] += 1
            return int((n[1:16] ** 2).sum())
        allowed = [0] + [f for f in range(1, 16 - x + 1) if p.level[f]]
        f = p.choose(x)
        assert f in allowed and total(f) == min(map(total, allowed))
        p.add((step, 0, __import__("numpy").zeros(x, "<u4"), x))


def test_packing_ids_of_pieces(monkeypatch):
    """Ids from pieces are the ids of the whole texts, at any white space, and with a memory that is too small."""
    import random

    random.seed(1)
    coder = packing.tokenizer(packing.default_tokenizer())
    parts = [" ", " ", "  ", "\n", "\t", "a", "B1", "é", "漢", "\x1c", "\x85", "\xa0", "'s", "'", "12", "..", "\0", "\u3000", "<|endoftext|>", "👍🏽", "\r\n", "x" * 70]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(40))) for _ in range(3000)]
    for known in (packing.KNOWN, 50):
        monkeypatch.setattr(packing, "KNOWN", known)
        encode = packing.Encoder(packing.default_tokenizer(), 1)
        got = [ids for i in range(0, len(texts), 100) for ids in encode(pa.array(texts[i : i + 100]))]
        assert [x.tolist() for x in got] == [[*coder.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_packing_closes_windows_as_placed():
    """Only the emptiest open windows are cut; the others keep what the rule placed, and nothing is padded."""
    import random

    import numpy as np

    random.seed(3)
    p = packing.Packer(0, 64)
    for i in range(200):
        x = random.randint(1, 63)
        p.add((i, 0, np.full(x, i, "<u4"), x))
    windows = [w for level in p.open for w in level]
    whole = sorted(windows, key=lambda w: -sum(len(x[2]) for x in w))
    total = sum(len(x[2]) for w in windows for x in w)
    rows = p.close()
    by_sequence = {}
    for doc, start, n, _, _, sequence, offset in rows:
        by_sequence.setdefault(sequence, []).append((doc, start, n, offset))
    sizes = [sum(r[2] for r in rows_) for rows_ in by_sequence.values()]
    assert sum(sizes) == total and all(s == 64 or s & (s - 1) == 0 for s in sizes)
    assert sizes.count(64) == total // 64 and len(sizes) - sizes.count(64) == bin(total % 64).count("1")
    for placed, got in zip(whole[: total // 64], by_sequence.values()):
        assert [(x[0], len(x[2])) for x in placed] == [(d, n) for d, _, n, _ in got][: len(placed)]


def test_warc(spark, sf):
    first, want = {}, {}
    pages = {r.page_id: (r.html or "").encode() for r in table(spark, sf, "pages").collect()}
    for i in sorted(pages):
        b = pages[i]
        d = hashlib.sha256(b).hexdigest()
        origin = first.setdefault(d, i)
        again = len(b) >= 100 and origin != i
        want[i] = (len(b), d, "revisit" if again else "response", origin if again else None)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op7_warc(spark, sf).collect()}
    assert got == want


def test_warc_odd(spark):
    long = "é" * 3_000_000
    rows = [(1, None, "x" * 200), (2, "http://a/\r\nb", "x" * 200), (2, "u", None), (None, "u", "x" * 200), (5, "u", ""), (1, "v", "x" * 200), (6, "w", long), (7, "w", long), (8, "w", "y\r\n\r\nz" * 20)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, first int")
    found = warc.read_archives(warc.write_archives(pages)).collect()
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in found), key=str)
    assert got == sorted([(1, "response", None), (1, "response", None), (2, "revisit", 1), (2, "response", None), (None, "revisit", 1), (5, "response", None), (6, "response", None), (7, "revisit", 6), (8, "response", None)], key=str)
    assert {(r.payload_bytes, r.payload_digest) for r in found if r.page_id in (6, 7)} == {(6_000_000, hashlib.sha256(long.encode()).hexdigest())}
    assert {r.payload_digest for r in found if r.page_id == 8} == {hashlib.sha256(rows[8][2].encode()).hexdigest()}
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_moves_no_payload(spark):
    """No html is in an exchange, even where nothing can be broadcast."""
    pages = spark.createDataFrame([(i, f"u{i}", "x" * 200) for i in range(50)], "page_id long, url string, html string")
    known = warc.originals(pages)
    assert known.of(hashlib.sha256(b"x" * 200).digest()) == (0, "u0") and known.of(hashlib.sha256(b"y").digest()) is None
    paths = warc.write_archives(pages)
    raw = b"".join(bytes(warc.mapped(r.path)) for r in paths.collect())
    heads = [h for h, _ in warc.records(memoryview(raw))]
    ids = {h["X-Page"]: h["WARC-Record-ID"] for h in heads if h["WARC-Type"] != "warcinfo"}
    assert len(set(ids.values())) == 50
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 49 and all(h["WARC-Refers-To"] == ids["0"] and h["WARC-Refers-To-Target-URI"] == "u0" and "WARC-Refers-To-Date" in h for h in revisits)


def test_language_and_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in table(spark, sf, "documents").collect()}
    rows = queries.op8_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang and r.lang_pred != "und"]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held)
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    q = [r for r in queries.op9_quality(spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in q)
    accuracy = sum(r.predicted == labels[r.doc_id] for r in q) / len(q)
    good = [r for r in q if labels[r.doc_id] == 1]
    kept = sum(r.predicted for r in good) / len(good)
    print("language", right, len(held), "quality", accuracy, len(q), "kept", kept)
    assert right > 0.9 and accuracy > 0.8 and kept > 0.9


def _mix64(x):
    """The 64-bit finaliser, in plain integers."""
    m = (1 << 64) - 1
    for _ in range(2):
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & m
    return x ^ (x >> 32)


def _hash64(raw):
    """The polynomial hash of bytes, in plain integers."""
    m, base, h = (1 << 64) - 1, 0x9E3779B97F4A7C15 | 1, 0
    for k, c in enumerate(raw):
        h = (h + (c + 1) * pow(base, k, 1 << 64)) & m
    return _mix64((h + len(raw)) & m)


def _plain_signature(text):
    """LZ78 by a trie of nodes, and the 64 smallest of the upper halves of the phrases' hashes."""
    trie, at, found, begin = {}, 0, set(), 0
    for i, c in enumerate(text):
        if (at, c) in trie:
            at = trie[at, c]
        else:
            trie[at, c] = len(trie) + 1
            found.add(text[begin : i + 1])
            at, begin = 0, i + 1
    # the open run at the end is a phrase that is known already
    return sorted({_hash64(p.encode()) >> 32 for p in found})[:64]


def _plain_likeness(a, b):
    if not a and not b:
        return 1.0
    least = sorted(set(a) | set(b))[:64]
    return sum(x in a and x in b for x in least) / len(least)


def check_fingerprints(rows, docs):
    """docs: ordered (doc_id, text) pairs with distinct ids."""
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(rows) == len(docs)
    text = lambda s: "".join(f"{x:08x}" for x in s)
    for a, (i, t) in enumerate(docs):
        nxt = docs[(a + 1) % len(docs)][1]
        half = len(t) // 2
        new = t[: len(t) - half] + nxt[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        s, e, n = map(_plain_signature, (t, new, nxt))
        assert (r.fingerprint, r.edited_fingerprint) == (text(s), text(e))
        assert r.near_edited == pytest.approx(_plain_likeness(s, e)) and r.near_next == pytest.approx(_plain_likeness(s, n))


def test_fingerprints(spark, sf):
    docs = sorted(texts(spark, sf).items())
    check_fingerprints([r for r in queries.op10_fingerprints(spark, sf).collect()], docs)


def test_fingerprints_over_ranges(spark):
    """Few and many ranges, hot ids and null ids: every row has the next of the order as its neighbour."""
    docs = [(i * 7 - 50, f"text {i} " * (i % 9)) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for n in (1, 2, 13, 200):
        check_fingerprints(fingerprints.fingerprints(frame, n).collect(), docs)
    hot = [(None, f"null {i}") for i in range(40)] + [(5, f"five {i}") for i in range(40)] + [(5, "same")] * 20 + [(i, f"t{i}") for i in range(6, 40)]
    want = None
    for n in (1, 7, 50):
        rows = fingerprints.fingerprints(spark.createDataFrame(hot, "doc_id long, text string"), n).collect()
        found = sorted(((r.doc_id, r.n_chars, r.fingerprint, r.edited_sha256, r.near_next) for r in rows), key=str)
        assert len(found) == len(hot) and (want is None or found == want)
        want = found


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    items = spark.createDataFrame([(1, "a b", "x"), (None, "é ü 漢字", "y"), (3, None, "z")], "item_id long, text string, node string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, None), (None, 1)], "doc_id long, quality int")
    for part in (docs, docs.limit(0)):
        n = part.count()
        assert secrets.find_secrets(part).count() == n and secrets.redact(part).count() == n
        assert jaccard_join.jaccard_components(part).count() == n
        assert decontamination.contamination(part, items).count() == n and decontamination.contamination(part, items.limit(0)).where("contaminated").count() == 0
        assert packing.pack(part).where("start = 0").count() == n
        assert language.language_id(part).count() == n
        assert quality.quality_scores(part, labels).count() == n and quality.quality_scores(part, labels.limit(0)).count() == n
        assert fingerprints.fingerprints(part).count() == n
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, "http://NET"), (3, "http://NET/"), (None, "a://x.org/fr/?q")], "page_id long, url string")
    got = sorted(((r.page_id, r.host, r.path, r.rule) for r in url_filter.judge(pages).collect()), key=str)
    assert got == sorted([(1, "", "", None), (2, "", "", None), (3, "net", "", None), (3, "net", "/", "net/"), (None, "x.org", "/fr/", "org/fr/")], key=str)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = table(spark, sf, "documents")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).toPandas().astype(object).where(lambda d: d.notna(), None), docs.schema)
        print(name, n, docs.count())
        assert docs.columns == table(spark, sf, "documents").columns and 0 < docs.count() <= n
        n = docs.count()
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_near_duplicates_decides_by_row(spark):
    """Rows of one id with unlike texts stay; copies and repeated rows go, whatever their ids."""
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (1, ""), (1, ""), (2, a + " more"), (3, c), (3, c), (4, b), (4, "x y"), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, a), (1, b), (1, ""), (3, c), (4, "x y"), (5, None)], key=str)


def test_near_duplicates_without_ids(spark):
    """Copies among rows without an id, and of a row with one, go; links count their sets."""
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(None, a), (0, a + " more"), (None, b), (None, b), (None, b + " more"), (None, c)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert [r.text for r in got if r.doc_id == 0] == [a + " more"]
    assert sorted(r.text[0] for r in got) == ["a", "b", "c"]
    links = jaccard_join.jaccard_components(docs, 5, 80).collect()
    assert sorted((r.doc_id is None, r.component_id, r.links) for r in links if r.links) == [(False, 0, 1)] + [(True, None, 1)] * 4


def test_op4_heavy_regions_stay_exact(spark, monkeypatch):
    """Groups far over a task's weight: pivots, labels, cells and chunks against all pairs."""
    import random

    from navlattice.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "WEIGHT", 20_000)
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(4):
        base = rnd.choices(vocabulary, k=80)
        for _ in range(150):
            words = list(base)
            for _ in range(rnd.randrange(5)):
                words[rnd.randrange(80)] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [" ".join(rnd.choices(vocabulary, k=rnd.randrange(12))) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n, percent in ((5, 80), (3, 90)):
        sets = [frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if (w := t.split()) else frozenset() for t in texts]
        top = list(range(len(sets)))
        for x in range(len(sets)):
            for y in range(x):
                both = len(sets[x] & sets[y])
                if both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = top[x], top[y]
                    if a != b:
                        top = [min(a, b) if t in (a, b) else t for t in top]
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(frame, n, percent).collect()}
        assert [got[i] for i in range(len(sets))] == top


def test_op4_large_group_is_not_copied(spark, monkeypatch):
    """A large group of near copies, too unlike for one pivot and too alike for cells: its sets are not written again and again, and all that links is found."""
    import random

    monkeypatch.setattr(jaccard_join, "WEIGHT", 20_000)
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    base, texts = rnd.choices(vocabulary, k=200), []
    for _ in range(400):
        words = list(base)
        for _ in range(rnd.randrange(12)):
            words[rnd.randrange(200)] = rnd.choice(vocabulary)
        texts.append(" ".join(words))
    copies, plain = [], jaccard_join.written

    def counted(df, name):
        out = plain(df, name)
        if "grams" in out.columns:
            copies.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(196)) for w in map(str.split, texts)]
    top = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            if top[x] != top[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                a, b = top[x], top[y]
                top = [min(a, b) if t in (a, b) else t for t in top]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = jaccard_join.one_of_each(frame, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(top))
    assert sum(n for _, n in copies) <= 4 * len(set(sets)), copies
