"""SQL of the registered text queries where SQL can express them on whole tables in fair time."""

from __future__ import annotations

OP4 = r"""
WITH parts AS (
    SELECT page_id, url,
        CASE WHEN instr(url, '://') > 0
            THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') END AS rest
    FROM pages
), split AS (
    SELECT page_id, url,
        coalesce(translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1), '') AS path
    FROM parts
), rules(verdict, rule) AS (
    VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')
), cut AS (
    SELECT verdict, rule, substr(rule, 1, instr(rule, '/') - 1) AS own, substr(rule, instr(rule, '/')) AS start FROM rules
)
SELECT page_id, host, path,
    (SELECT arg_max(rule, length(rule)) FROM cut WHERE (host = own OR ends_with(host, '.' || own)) AND starts_with(path, start)) AS rule,
    coalesce((SELECT arg_max(verdict, length(rule)) FROM cut WHERE (host = own OR ends_with(host, '.' || own)) AND starts_with(path, start)), 'allow') AS verdict
FROM split
"""

OP2 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SYMBOLS = "length({0}) - length(translate({0}, '#*$%&|<>', ''))"
_FAILS = rf"""(({_SYMBOLS.format('x')}) >= 3 AND ({_SYMBOLS.format('x')}) * 10 > length(x))
    OR (length(x) - length(replace(x, '!!', '!')) >= 3
        AND (length(x) - length(replace(x, '!!', '!'))) * 4 > length(x) - length(replace(x, ' ', '')))
    OR NOT regexp_matches(x, '[.!?…:;。！？]')
    OR (length(x) - length(translate(x, '|•»›·', '')) >= 3
        AND length(x) - length(replace(x, ' ', '')) < 6 * (length(x) - length(translate(x, '|•»›·', ''))))
    OR regexp_matches(x, '(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|accept (all )?cookies|enable javascript|lorem ipsum|subscribe to our newsletter|click here to|skip to (main )?content|powered by|add to cart)\b')"""

OP5 = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), tokens AS (
    SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM texts
), windows AS (
    SELECT doc_id, p, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g
    FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), again AS (
    SELECT doc_id, p FROM windows WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY doc_id
), counted AS (
    SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(translate(t, {_BLANK}, '')) AS BIGINT) AS word_chars,
        CAST({_SYMBOLS.format('t')} AS BIGINT) AS n_symbols,
        CAST(len(list_filter(lines, lambda x: trim(x, {_BLANK}) <> ''))
            - len(list_distinct(list_filter(lines, lambda x: trim(x, {_BLANK}) <> ''))) AS BIGINT) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words,
        length(translate(array_to_string(list_filter(lines,
            lambda x: trim(x, {_BLANK}) <> '' AND NOT ({_FAILS})), chr(10)), {_BLANK}, '')) AS stays
    FROM texts t LEFT JOIN repeats r ON r.doc_id = t.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * stays >= word_chars AS kept
FROM counted
"""

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {i} AS k, unnest(m) AS m, unnest(g[1:len(m)]) AS g, generate_subscripts(m, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM texts)"""
    for i, (kind, pattern) in enumerate(_PATTERNS.items())
)

OP10 = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), found AS (
    {_FOUND}
), placed AS (
    SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d, CAST(sum(length(g)) OVER (PARTITION BY doc_id, k ORDER BY i)
        + sum(length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) - length(m) AS BIGINT) AS s
    FROM found
), fits AS (
    SELECT doc_id, kind, k, s, kind || ':' || s || ':' || (s + length(m)) AS span FROM placed
    WHERE CASE kind WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda x: coalesce(TRY_CAST(x AS HUGEINT), 256) > 255)) = 0
        WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(d)), lambda j:
            CASE WHEN j % 2 = 0 THEN CAST(d[length(d) - j] AS INTEGER)
                WHEN CAST(d[length(d) - j] AS INTEGER) > 4 THEN 2 * CAST(d[length(d) - j] AS INTEGER) - 9
                ELSE 2 * CAST(d[length(d) - j] AS INTEGER) END)) % 10 = 0
        WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
        WHEN 'iban' THEN list_reduce(list_transform(string_split(replace(m, ' ', '')[5:] || m[1:4], ''),
            lambda c: CASE WHEN ascii(c) >= 65 THEN ascii(c) - 55 ELSE ascii(c) - 48 END),
            lambda r, x: CASE WHEN x > 9 THEN (r * 100 + x) % 97 ELSE (r * 10 + x) % 97 END, 0) = 1
        ELSE regexp_matches(lower(right(g, 40)), 'ssn|social security') END
), listed AS (
    SELECT doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip,
        count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
        coalesce(string_agg(span, ',' ORDER BY k, s) FILTER (k < 4), '') AS base,
        string_agg(span, ',' ORDER BY k, s) AS spans
    FROM fits GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
    coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN listed l ON l.doc_id = t.doc_id
"""

_TERMS = (
    "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
)

OP11 = f"""
WITH counted AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY doc_id, term
), sizes AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term) CROSS JOIN corpus
), shares AS (
    SELECT doc_id, 10 + (90 * n * documents) // length AS m FROM sizes CROSS JOIN corpus
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM (SELECT DISTINCT item_id, {_TERMS} FROM benchmark) JOIN counted USING (term)
    JOIN weights USING (term) JOIN shares USING (doc_id)
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

OP12 = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), held AS (
    SELECT payload_digest, max(page_id) AS held_by FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
    CASE WHEN held_by IS DISTINCT FROM page_id AND held_by IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN held_by IS DISTINCT FROM page_id THEN held_by END AS refers_to
FROM payloads p LEFT JOIN held h ON h.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
"""

ORACLE: dict[str, str] = {
    "op2_ngram_join": OP2,
    "op4_url_filter": OP4,
    "op5_quality_rules": OP5,
    "op10_pii": OP10,
    "op11_lexical_search": OP11,
    "op12_warc": OP12,
}
