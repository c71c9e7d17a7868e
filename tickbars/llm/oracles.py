"""DuckDB SQL for the corpus queries that SQL can express."""

from tickbars.llm import license_scan as L
from tickbars.llm import pii as P

WORD = r"[^\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS gram
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM d)),
rep AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM win),
cover AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM rep WHERE c > 1) GROUP BY rid),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}') GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cover USING (rid) LEFT JOIN lines USING (rid)),
g AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * n_symbols > 25 * word_chars AS symbols_failed FROM f),
h AS (
  SELECT source, count(*) AS n, sum(CAST(base_failed OR symbols_failed AS INT)) AS failed
  FROM g WHERE source IS NOT NULL GROUP BY source),
p AS (
  SELECT avg(failed / n) AS m, var_pop(failed / n) AS v FROM h),
k AS (
  SELECT m, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 1) ELSE 1e9 END AS w FROM p),
bad AS (
  SELECT source FROM h, k WHERE (failed + w * m) / (n + w) > 0.9)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.source IS NULL AS kept, bad.source IS NOT NULL AS host_rejected
FROM g LEFT JOIN bad ON g.source = bad.source
"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _license_canonical(column: str) -> str:
    x = f"regexp_replace(lower({column}), {_quoted('(?m)' + L.COPYRIGHT_LINE)}, ' ', 'g')"
    x = f"replace({x}, 'https://', 'http://')"
    x = f"'  ' || regexp_replace({x}, {_quoted(L.NOT_WORD)}, '  ', 'g') || '  '"
    for old, new in L.replacements():
        x = f"replace({x}, {_quoted(old)}, {_quoted(new)})"
    return f"trim({x})"


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, texts in L.NOTICES.items() for text in texts)

ORACLE_SQL["op1_license_scan"] = f"""
WITH known AS (
  SELECT DISTINCT license, {_license_canonical('text')} AS form FROM (VALUES {_KNOWN}) AS k(license, text)),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT rid, doc_id, true AS whole, text AS unit FROM d
  UNION ALL SELECT rid, doc_id, false, unnest(string_split(text, chr(10))) FROM d),
forms AS (SELECT rid, doc_id, whole, {_license_canonical('unit')} AS form FROM units)
SELECT doc_id, license, bool_or(whole) AS whole_text, CAST(sum(CAST(NOT whole AS INT)) AS BIGINT) AS n_lines
FROM forms JOIN known USING (form) WHERE form <> '' GROUP BY rid, doc_id, license
"""


def _matches(kind: str, rank: int, pattern: str, group: int = 0, source: str = "d") -> str:
    """(rid, kind, rank, start, end, value) of every match: a match starts after
    all gaps up to it and all matches before it."""
    p = _quoted(pattern)
    return f"""
  SELECT rid, '{kind}' AS kind, {rank} AS rank, p0 AS "start", p0 + length(m[i]) AS "end", v[i] AS value
  FROM (SELECT *, CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
                       + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS p0
        FROM (SELECT rid, m, v, gaps, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT rid, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS v,
                           string_split_regex(t, {p}) AS gaps FROM {source})))"""


_KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in (
    "password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"

ORACLE_SQL["op8_secret_scan"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS owner, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT * FROM ({_matches('assign', 0, f'''({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', 2)})
  WHERE length(value) >= 6
  UNION ALL {_matches('access', 1, 'AKIA[A-Z0-9]{16,}')}
  UNION ALL {_matches('hex', 2, '[0-9a-f]{24,}')}),
opaque AS (
  SELECT * FROM ({_matches('opaque', 3, '[A-Za-z0-9+/_=-]{20,}')}) o
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = o.rid AND b."start" < o."end" AND o."start" < b."end")),
found AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
live AS (
  SELECT value FROM found JOIN d USING (rid) GROUP BY value HAVING count(DISTINCT owner) <= 2),
shown AS (
  SELECT * FROM base UNION ALL SELECT * FROM opaque WHERE value IN (SELECT value FROM live)),
b AS (
  SELECT rid, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
         string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY "start", rank) AS spans FROM base GROUP BY rid),
s AS (
  SELECT rid, string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY "start", rank) AS spans FROM shown GROUP BY rid),
l AS (
  SELECT rid, count(*) AS n_live FROM found WHERE value IN (SELECT value FROM live) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(b.spans, '')) AS base_sha256,
       coalesce(s.spans, '') AS spans, CAST(coalesce(n_live, 0) AS BIGINT) AS n_live
FROM d LEFT JOIN b USING (rid) LEFT JOIN s USING (rid) LEFT JOIN l USING (rid)
"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k:
  CASE WHEN k % 2 = 1 THEN CAST(reverse({_DIGITS})[k] AS INT)
       ELSE 2 * CAST(reverse({_DIGITS})[k] AS INT) - 9 * CAST(CAST(reverse({_DIGITS})[k] AS INT) > 4 AS INT) END)) % 10 = 0"""
_WORDS_OF = r"list_filter(regexp_extract_all({}, '[\p{{L}}\p{{N}}]+'), lambda w: regexp_full_match(w, '\p{{L}}{{4,}}'))"

ORACLE_SQL["op6_pii"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED (
  {_matches('email', 0, r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+')}
  UNION ALL SELECT * FROM ({_matches('ip', 1, r'[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)')})
  WHERE regexp_matches(value, {_quoted(P.IP_PARTS)})
  UNION ALL SELECT * FROM ({_matches('card', 2, r'[0-9]([\x20-]?[0-9])+')})
  WHERE length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}
  UNION ALL SELECT * FROM ({_matches('phone', 3, r'\+[0-9][\x20().0-9-]+[0-9]')})
  WHERE length({_DIGITS}) BETWEEN 8 AND 15),
beside AS (
  SELECT t, kind || ':' || value AS entity,
         regexp_replace(substr(t, greatest("start" - {P.CONTEXT}, 0) + 1, least("start", {P.CONTEXT})), '^[\p{{L}}\p{{N}}]+', ' ')
         || ' | ' || regexp_replace(substr(t, "end" + 1, {P.CONTEXT}), '[\p{{L}}\p{{N}}]+$', ' ') AS context
  FROM base JOIN d USING (rid)),
entities AS (SELECT entity, count(DISTINCT t) AS n_e FROM beside GROUP BY entity HAVING count(DISTINCT t) >= {P.SUPPORT}),
pairs AS (
  SELECT entity, term, count(DISTINCT t) AS n_et
  FROM (SELECT t, entity, unnest({_WORDS_OF.format('context')}) AS term FROM beside)
  GROUP BY entity, term HAVING count(DISTINCT t) >= {P.SUPPORT}),
words AS (
  SELECT DISTINCT t, term FROM (SELECT DISTINCT t, unnest({_WORDS_OF.format('t')}) AS term FROM d)
  WHERE term IN (SELECT term FROM pairs)),
counts AS (SELECT term, count(*) AS n_t FROM words GROUP BY term),
strong AS (
  SELECT DISTINCT term FROM pairs JOIN entities USING (entity) JOIN counts USING (term)
  WHERE n_et / n_t >= {P.DISCLOSURE}
    AND log2(n_et / n_t * (SELECT count(DISTINCT t) FROM d) / n_e) >= {P.BITS}),
held AS (SELECT rid, t FROM d WHERE t IN (SELECT t FROM words WHERE term IN (SELECT term FROM strong))),
terms AS (
  SELECT * FROM ({_matches('term', 4, r'[\p{L}\p{N}]+', 0, 'held')}) w
  WHERE value IN (SELECT term FROM strong)
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b."start" < w."end" AND w."start" < b."end")),
b AS (
  SELECT rid, count_if(kind = 'email') AS n_email, count_if(kind = 'ip') AS n_ip, count_if(kind = 'card') AS n_card,
         count_if(kind = 'phone') AS n_phone,
         string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY rank, "start") AS spans FROM base GROUP BY rid),
s AS (
  SELECT rid, count_if(kind = 'term') AS n_term,
         string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY rank, "start") AS spans
  FROM (SELECT * FROM base UNION ALL SELECT * FROM terms) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip,
       CAST(coalesce(n_card, 0) AS BIGINT) AS n_card, CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone,
       sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(s.spans, '') AS spans,
       CAST(coalesce(n_term, 0) AS BIGINT) AS n_term
FROM d LEFT JOIN b USING (rid) LEFT JOIN s USING (rid)
"""

ORACLE_SQL["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10
"""

ORACLE_SQL["op12_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS ts FROM t GROUP BY conv_id),
-- crc32 (polynomial edb88320) of the decimal id, bit by bit
digits AS (
  SELECT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bs FROM c),
hashed AS (
  SELECT conv_id, xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(bs, lambda b: list_concat([b + 4294967296], [-1, -1, -1, -1, -1, -1, -1, -1])))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x - 4294967296)
                             WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 9 AS h
  FROM digits),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts[1:h], []), c.ts[h + 1:]) AS ts
  FROM c JOIN hashed USING (conv_id) LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5),
m AS (
  SELECT conv_id, ts[1:d] AS path, d, len(ts) = d AS ends
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN d = 0 THEN 0 ELSE strlen(path[-1].text) END * (count(*) - 1) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY path, d),
k AS (SELECT path[1:-2] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, depth)),
up AS (
  SELECT path[1:d] AS path, d AS depth, sum(saved) AS saved_tokens, sum(CAST(n_children = 0 AS INT)) AS n_leaves
  FROM (SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS d FROM v) GROUP BY ALL)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN up USING (path, depth) LEFT JOIN n p ON p.path = v.path[1:-2] AND p.depth = v.depth - 1
"""
