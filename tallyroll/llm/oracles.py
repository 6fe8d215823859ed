"""The same results in SQL for DuckDB, where SQL can express them on whole tables."""

from __future__ import annotations

from tallyroll.llm import quality_rules, url_filter

_WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM words),
classes AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT c, n, unnest(s) AS u FROM classes),
counted AS (SELECT u, count(*) AS df FROM shingles GROUP BY u),
-- Of two linked sets, the rarest quarter of each (and one more) share a shingle.
placed AS (SELECT c, n, u, row_number() OVER (PARTITION BY c ORDER BY df, u) AS place FROM shingles JOIN counted USING (u)),
kept AS (SELECT c, n, u FROM placed WHERE place <= n - CAST(ceil(75 * n / 100.0) AS BIGINT) + 1),
met AS (SELECT DISTINCT a.c AS x, b.c AS y FROM kept a JOIN kept b ON a.u = b.u AND a.c < b.c AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
links AS (
    SELECT m.x, m.y FROM met m JOIN classes a ON a.c = m.x JOIN classes b ON b.c = m.y
    WHERE 100 * len(list_intersect(a.s, b.s)) >= 75 * (a.n + b.n - len(list_intersect(a.s, b.s)))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT c AS x, c AS y FROM classes UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON l.x = r.y),
parts AS (SELECT x AS c, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(p.component_id, d.doc_id) AS component_id,
    CASE WHEN c.c IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY c.c) END AS n_copies
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN parts p ON p.c = c.c
"""

# 160 bits are 32 characters of 5 bits: 5 hexadecimal digits (20 bits) give 4 characters.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * group}, 5))::BIGINT >> {15 - 5 * k}) & 31), 1)"
    for group in range(8) for k in range(4))

OP3 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < newest THEN newest END AS refers_to
FROM q
"""

OP5 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
"""


def _hits(terms: tuple[str, ...]) -> str:
    edge = "[^a-z0-9]"
    return " + ".join(f"CAST(regexp_matches(low, '(^|{edge}){term}({edge}|$)') AS INTEGER)" for term in terms)


OP6 = f"""
WITH u AS (
    SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS bare FROM pages),
s AS (
    SELECT page_id, low, translate(regexp_extract(bare, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        substr(bare, length(regexp_extract(bare, '^[^/]*')) + 1) AS path FROM u),
rules AS (SELECT * FROM (VALUES {", ".join(f"('{r}', '{v}')" for r, v in url_filter.RULES)}) t(rule, verdict)),
fit AS (
    SELECT s.page_id, r.rule, r.verdict, row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule) DESC, r.rule) AS place
    FROM s JOIN rules r ON starts_with(s.path, substr(r.rule, strpos(r.rule, '/')))
        AND (s.host = split_part(r.rule, '/', 1) OR ends_with(s.host, '.' || split_part(r.rule, '/', 1))))
SELECT s.page_id, s.host, s.path, f.rule,
    coalesce(f.verdict, CASE WHEN {_hits(url_filter.STRICT)} > 0 OR {_hits(url_filter.SOFT)} >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN fit f ON f.page_id = s.page_id AND f.place = 1
"""

_FAILED = " + ".join(f"CASE WHEN {condition} THEN {quality_rules.BITS[name]} ELSE 0 END" for name, condition in quality_rules.RULES)

OP7 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM t),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY doc_id),
m AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        len(lines) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_shouted
    FROM w LEFT JOIN repeated USING (doc_id)),
f AS (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {quality_rules.BASE}) <> 0 AS base_failed,
    (failed & {quality_rules.POLICIES[quality_rules.PRODUCTION]}) = 0 AS kept, failed
FROM f
"""

OP11 = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, w[i:i + m - 1] AS g FROM places, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30),
inner_parts AS (SELECT lang, f, unnest(list_concat(
    CASE WHEN len(g) = 3 THEN [g[1:2], g[2:3]] ELSE [] END,
    CASE WHEN len(g) = 4 THEN [g[1:2], g[2:3], g[3:4], g[1:3], g[2:4]] ELSE [] END)) AS g FROM f WHERE len(g) > 2),
around AS (SELECT lang, g, max(f) AS around FROM inner_parts GROUP BY lang, g),
kept AS (SELECT f.lang, f.g, f.f AS a FROM f LEFT JOIN around USING (lang, g) WHERE len(f.g) > 1 AND (around IS NULL OR 100 * around < 80 * f.f)),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM kept),
scored AS (
    SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM scored),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, score
    FROM lowest WHERE o = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op2_ngram_jaccard": OP2, "op3_warc_records": OP3, "op5_maxscore_top_k": OP5, "op6_url_filter": OP6, "op7_quality_rules": OP7,
                           "op11_setm_collocations": OP11}
