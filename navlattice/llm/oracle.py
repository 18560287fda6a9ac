"""DuckDB SQL for the queries of this subpackage that SQL can state."""

from __future__ import annotations

from .url_filter import LOWER, RULES, STRONGEST, TAIL, THRESHOLD, TWO_LABEL, UPPER, WEAKEST

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


def _urls() -> str:
    """Rules, and reputation by moments; the posterior's quantile exceeds the threshold where less than TAIL of it lies below, by the midpoint rule over the logit."""
    order = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host='{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    text = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in order) + " END"

    def strength(units: str) -> str:
        return f"(SELECT CASE WHEN coalesce(sum(prior*(1-prior)*(n-1)),0)=0 THEN {STRONGEST}e0 ELSE 1e0/least(greatest((sum(n*(bad/n-prior)*(bad/n-prior))-sum(prior*(1-prior)))/sum(prior*(1-prior)*(n-1)), {1 / (STRONGEST + 1)!r}e0), {1 / (WEAKEST + 1)!r}e0)-1 END AS k FROM {units} WHERE n>0)"

    steps = 4000
    low = "-greatest(50e0, 50e0/a)"
    at = f"({low}+(i+0.5e0)*(ln({THRESHOLD}e0)-ln(1-{THRESHOLD}e0)-({low}))/{steps})"
    soft = lambda x: f"(greatest({x},0)+ln(1+exp(-abs({x}))))"
    minus = soft(f"-{at}")
    return f"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://')>0 THEN substr(url, strpos(url, '://')+3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, {text} AS rule, {verdict} AS ruled FROM h),
hosts AS (SELECT host, count(ruled) AS n, count(*) FILTER (WHERE ruled='block') AS bad, CASE WHEN regexp_matches(host, '{TWO_LABEL}') THEN regexp_extract(host, '{TWO_LABEL}', 2) ELSE split_part(host, '.', -1) END AS suffix, array_to_string(string_split(host, '.')[CASE WHEN regexp_matches(host, '{TWO_LABEL}') THEN -3 ELSE -2 END:], '.') AS domain FROM r GROUP BY host),
domains AS (SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
s1 AS (SELECT *, (SELECT (sum(bad)+0.5e0)/(sum(n)+1) FROM suffixes) AS prior FROM suffixes), k1 AS {strength('s1')},
d1 AS (SELECT d.*, (s.bad+k*s.prior)/(s.n+k) AS prior FROM domains d JOIN s1 s USING (suffix), k1), k2 AS {strength('d1')},
h1 AS (SELECT h.*, (d.bad+k*d.prior)/(d.n+k) AS prior FROM hosts h JOIN d1 d USING (domain), k2), k3 AS {strength('h1')},
post AS (SELECT host, bad+k*prior AS a, n-bad+k*(1-prior) AS b FROM h1, k3),
below AS (SELECT a, b, sum(exp(-a*{minus}-b*{soft(at)}+lgamma(a+b)-lgamma(a)-lgamma(b)))*(ln({THRESHOLD}e0)-ln(1-{THRESHOLD}e0)-any_value({low}))/{steps} AS p FROM (SELECT DISTINCT a, b FROM post), range({steps}) t(i) GROUP BY a, b)
SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN p<{TAIL}e0 THEN 'block' ELSE 'allow' END) AS verdict, round(a/(a+b), 9) AS mean FROM r JOIN post USING (host) JOIN below USING (a, b)"""


def _join(n: int = 3, percent: int = 90) -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+{n - 1}], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w)-{n - 2}, 2))) AS i FROM w WHERE len(w)>0)),
s AS (SELECT doc_id, count(*) AS size, md5(string_agg(gram, chr(10) ORDER BY gram)) AS node FROM g GROUP BY doc_id),
c AS (SELECT node, min(doc_id) AS class_id, any_value(size) AS size FROM s GROUP BY node),
cg AS (SELECT c.node, g.gram FROM c JOIN g ON g.doc_id=c.class_id),
pairs AS (SELECT a.node AS a, b.node AS b, count(*) AS n FROM cg a JOIN cg b ON a.gram=b.gram AND a.node<>b.node GROUP BY a.node, b.node),
link AS (SELECT a, b FROM pairs JOIN c ca ON ca.node=a JOIN c cb ON cb.node=b WHERE 100*n>={percent}*(ca.size+cb.size-n)),
reach AS (SELECT node AS a, node AS b FROM c UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b=link.a),
comp AS (SELECT a AS node, min(class_id) AS component_id FROM reach JOIN c ON c.node=reach.b GROUP BY a)
SELECT w.doc_id, coalesce(size, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(class_id, w.doc_id) AS class_id, (SELECT count(*) FROM link WHERE link.a=s.node) AS links FROM w LEFT JOIN s USING (doc_id) LEFT JOIN c USING (node, size) LEFT JOIN comp USING (node)"""


def _contaminated(n: int = 13) -> str:
    words = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH d AS (SELECT doc_id, {words} AS w FROM documents), b AS (SELECT item_id, {words} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {n}) AS n, array_to_string(w[i:i+least(len(w), {n})-1], ' ') AS t FROM (SELECT item_id, w, unnest(range(1, greatest(len(w)-{n - 2}, 2))) AS i FROM b WHERE len(w)>0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w)-n+2)) AS i FROM d, sizes WHERE len(w)>=n)),
hit AS (SELECT DISTINCT doc_id, n, i, item_id FROM dw JOIN win USING (n, t)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i+n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0)>0 AND 20*coalesce(n_hit, 0)>=len(w) AS contaminated FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)"""


def _revisits(least: int = 100) -> str:
    return f"""WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes>={least} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first<>page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first<>page_id THEN first END AS refers_to FROM f"""


def _held_out(mod: int) -> str:
    """crc32 of the id as text, bit by bit: every byte goes in, then eight shifts."""
    ops = "flatten(list_transform(range(1, length(id)+1), i -> list_concat([CAST(unicode(id[i]) AS BIGINT)], [-1,-1,-1,-1,-1,-1,-1,-1])))"
    step = "CASE WHEN o>=0 THEN xor(c, o) WHEN c%2=1 THEN xor(c//2, 3988292384) ELSE c//2 END"
    return f"(SELECT xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {ops}), lambda c, o: {step}), 4294967295)%{mod}=0 FROM (SELECT CAST(doc_id AS VARCHAR) AS id))".replace("i -> ", "lambda i: ")


def _discounts(table: str, column: str) -> str:
    n = [f"CAST(count(*) FILTER (WHERE {column}={i}) AS DOUBLE)" for i in (1, 2, 3, 4)]
    y = "n1/(n1+2*n2)"
    d = ", ".join(f"CASE WHEN least(n1,n2,n3,n4)=0 THEN 0.5e0 ELSE least(greatest({k}-{k + 1}*{y}*n{k + 1}/n{k}, 0.05e0), {k}) END AS d{k}" for k in (1, 2, 3))
    return f"(SELECT {d}, n1, n2, more, total FROM (SELECT {', '.join(f'{x} AS n{i}' for i, x in enumerate(n, 1))}, CAST(count(*) FILTER (WHERE {column}>2) AS DOUBLE) AS more, coalesce(sum({column}), 0) AS total FROM {table}))"


def _language_model() -> str:
    d = lambda c, t: f"CASE {c} WHEN 0 THEN 0 WHEN 1 THEN {t}.d1 WHEN 2 THEN {t}.d2 ELSE {t}.d3 END"
    return f"""WITH d AS (SELECT doc_id, {_held_out(10)} AS held_out, list_append(list_transform(regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+'), lambda x: 'w' || x), 'e') AS w FROM documents),
tok AS (SELECT doc_id, held_out, unnest(w) AS w, unnest(list_prepend('s', w[1:len(w)-1])) AS u FROM d),
cnt AS (SELECT w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY w), pair AS (SELECT u, w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY u, w),
before AS (SELECT w, count(*) AS k FROM pair GROUP BY w), fol AS (SELECT u, sum(c) AS t, count(*) FILTER (WHERE c=1) AS f1, count(*) FILTER (WHERE c=2) AS f2, count(*) FILTER (WHERE c>2) AS f3 FROM pair GROUP BY u),
a AS {_discounts('pair', 'c')}, b AS {_discounts('before', 'k')}, nv AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM cnt),
low AS (SELECT t.w, coalesce(c, 0) AS c, CASE WHEN b.total=0 THEN 1e0/(v+1) ELSE greatest(coalesce(k, 0)-({d('coalesce(k, 0)', 'b')}), 0)/b.total+(b.d1*b.n1+b.d2*b.n2+b.d3*b.more)/b.total/(v+1) END AS low FROM (SELECT DISTINCT w FROM tok) t LEFT JOIN cnt ON cnt.w=t.w LEFT JOIN before ON before.w=t.w, b, nv),
p AS (SELECT doc_id, held_out, low.c, log10((low.c+0.1e0)/(n+0.1e0*(v+1))) AS base, log10(CASE WHEN coalesce(t, 0)>0 THEN (greatest(coalesce(pair.c, 0)-({d('coalesce(pair.c, 0)', 'a')}), 0)+(a.d1*f1+a.d2*f2+a.d3*f3)*low)/t ELSE low END) AS score FROM tok JOIN low ON low.w=tok.w LEFT JOIN pair ON pair.u=tok.u AND pair.w=tok.w LEFT JOIN fol ON fol.u=tok.u, a, nv)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (WHERE c>0) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens, round(sum(base), 6) AS base_score, round(sum(score), 6) AS score, round(pow(10, -sum(score)/count(*)), 3) AS perplexity FROM p, nv GROUP BY doc_id, held_out"""


def _language(top: int = 300) -> str:
    grams = "unnest(list_concat(list_transform(range(2, length(x)), lambda i: x[i]), list_transform(range(1, length(x)), lambda i: x[i:i+1]), list_transform(range(1, length(x)-1), lambda i: x[i:i+2])))"
    order = "length(g), unicode(g), unicode(g[2:]), unicode(g[3:])"
    return f"""WITH d AS (SELECT doc_id, lang, {_held_out(5)} AS held_out, regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}+') AS words FROM documents),
g AS (SELECT doc_id, lang, held_out, {grams} AS g FROM (SELECT doc_id, lang, held_out, ' ' || unnest(words) || ' ' AS x FROM d)),
lg AS (SELECT lang, g, count(*) AS n FROM g WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, g),
profile AS (SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, {order})-1 AS rank FROM lg QUALIFY rank<{top}),
dg AS (SELECT doc_id, g, count(*) AS n FROM g GROUP BY doc_id, g),
mine AS (SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, {order})-1 AS rank FROM dg QUALIFY rank<{top}),
size AS (SELECT doc_id, count(*) AS m FROM mine GROUP BY doc_id),
away AS (SELECT doc_id, l.lang, m, {top}*m+coalesce(sum(abs(p.rank-mine.rank)-{top}) FILTER (WHERE p.rank IS NOT NULL), 0) AS away FROM mine JOIN size USING (doc_id) CROSS JOIN (SELECT DISTINCT lang FROM profile) l LEFT JOIN profile p ON p.lang=l.lang AND p.g=mine.g GROUP BY doc_id, l.lang, m),
best AS (SELECT * FROM away QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY away, lang)=1)
SELECT d.doc_id, held_out, coalesce(best.lang, 'und') AS lang_pred, CASE WHEN best.lang IS NULL THEN 0e0 ELSE 1-CAST(away AS DOUBLE)/({top}*m) END AS score FROM d LEFT JOIN best USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_lm_scoring": _language_model(), "op3_url_filter": _urls(), "op4_jaccard_join": _join(), "op5_decontamination": _contaminated(), "op7_warc": _revisits(), "op8_language_id": _language()}
