"""DuckDB SQL for the corpus queries, computed from the tables alone."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x20\x09-\x0D]+"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[]
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON e.a = r.other)
SELECT r.doc_id, any_value(n) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reached r JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""

BENCH_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWERED}, '{BENCH_WORDS}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ')
    FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{BENCH_WORDS}') AS w FROM documents),
runs AS (
  SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS pos,
         unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS win
  FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m),
hits AS (SELECT doc_id, pos, r.m, item FROM runs r JOIN windows USING (win, m)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS p FROM hits) GROUP BY ALL),
found AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY ALL)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# the same plain rule settings as the operator's
LINE_QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT r, unnest(range(1, len(w) - 1)) AS pos,
         unnest([[w[i], w[i + 1], w[i + 2]] FOR i IN range(1, len(w) - 1)]) AS win FROM docs WHERE len(w) >= 3),
twice AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, win) AS c FROM wins) WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([pos, pos + 1, pos + 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs),
counted AS (
  SELECT r, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(l, '[!?]')) AS bangs,
         len(regexp_extract_all(l, '[|»›•·]')) AS seps,
         length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS chars FROM lines),
judged AS (
  SELECT *, n > 0 AND ((n >= 12 AND NOT regexp_matches(l, '[.!?,;:…。！？、，；：؟،।]'))
    OR 100 * symbols > 50 * n OR (100 * bangs > 50 * n AND n >= 3)
    OR (seps >= 3 AND 100 * seps >= 25 * n)
    OR (n <= 40 AND regexp_matches(l, '(?i)(all rights reserved|copyright \d|\(c\) \d|©|licensed under|released under the|terms of (use|service)|privacy policy|cookie policy|use of cookies|accept (all )?cookies|enable javascript|sign in|log in|subscribe (to|now)|share this|click here|read more)'))) AS bad
  FROM counted),
per AS (SELECT r, coalesce(sum(chars) FILTER (bad), 0) AS lost, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS dups
        FROM judged GROUP BY r),
base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost_chars
  FROM docs LEFT JOIN per USING (r) LEFT JOIN repeats USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept,
       lost_chars::BIGINT AS lost_chars
FROM base
"""

MIXING = """
WITH sizes AS (
  SELECT source AS src, coalesce(sum(length(text)), 0)::DOUBLE AS c FROM documents GROUP BY source),
weighted AS (SELECT src, c, CASE WHEN c > 0 THEN pow(c, 0.5) ELSE 0.0 END AS w FROM sizes),
rates AS (
  SELECT src, CASE WHEN c > 0 THEN (SELECT sum(c) FROM weighted) * (w / (SELECT sum(w) FROM weighted)) / c
              ELSE 1.0 END AS rate FROM weighted),
draws AS (SELECT src, greatest(ceil(rate / 32), 1)::INT AS m, rate / greatest(ceil(rate / 32), 1) AS mean FROM rates),
steps AS (
  SELECT src, m, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p FROM draws, range(0, 161) AS t(k)),
cdf AS (SELECT src, m, k, sum(p) OVER (PARTITION BY src ORDER BY k) AS c FROM steps),
keyed AS (SELECT d.*, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key, row_number() OVER () AS r FROM documents d),
tried AS (
  SELECT r, k.key, c, ('0x' || substr(md5(k.key || '|42|times|' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM keyed k JOIN cdf ON k.source IS NOT DISTINCT FROM cdf.src, range(1, m + 1) AS t(j)),
counted AS (SELECT r, count(*) FILTER (c <= u) AS times FROM tried GROUP BY r),
copies AS (SELECT k.*, unnest(range(1, times + 1))::INT AS copy FROM keyed k JOIN counted USING (r))
SELECT doc_id, text, lang, source, n_chars, copy,
       ('0x' || substr(md5(key || '|42|order|' || copy), 1, 13))::BIGINT / 4503599627370496.0 AS mix_key
FROM copies
"""

# fixed control strings of the chat template, in the order in which they are escaped
CONTROL = ("<|", "|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    return out


# "<|" + role + "|>" + break + text + "<|end|>" + break: 13 characters besides role and text
CHAT = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, length({_escaped("role")}) + length({_escaped("said")}) + 13 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, said) AS i FROM given),
prefixes AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto, max(i) OVER (PARTITION BY conv_id) AS n FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(said)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(said, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM prefixes GROUP BY conv_id
"""

# the given pages mark their article, whose blocks are paragraphs, a heading and line breaks
HTML = """
WITH bodies AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?b>', '', 'g') AS body
  FROM pages),
plain AS (
  SELECT page_id, url, [trim(regexp_replace(regexp_replace(
    replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))
    FOR x IN string_split_regex(body, '</?(p|h1|br)>')] AS blocks FROM bodies),
texts AS (SELECT page_id, url, array_to_string([x FOR x IN blocks IF x <> ''], chr(10)) AS text FROM plain)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""

# crc32 by its table, byte by byte; words of at most 64 code points
SPELLING = """
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n::BIGINT)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, LOWERED AS t FROM documents),
found AS (
  SELECT id, w, count(*) AS c FROM (SELECT id, unnest(regexp_extract_all(t, '[a-z\u00C0-\u00FF]+')) AS w FROM runs)
  WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (
  SELECT w, c, xor(list_reduce(list_transform(range(0, octet_length(encode(id || ':' || w))),
           lambda i: ('0x' || substr(hex(encode(id || ':' || w)), 2 * i::INT + 1, 2))::BIGINT),
           lambda s, b: xor(t[xor(s % 256, b) + 1], s // 256), 4294967295::BIGINT), 4294967295) AS h
  FROM found, crc_table),
said AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, c
  FROM hashed),
vocab AS (SELECT word, sum(c)::BIGINT AS n FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i::INT) || '$' || substr(word, i::INT + 2) AS pattern,
         substr(word, 1, i::INT) || substr(word, i::INT + 2) AS shorter
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n FROM cuts x JOIN cuts y ON x.pattern = y.pattern AND x.word <> y.word
  UNION SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON c.shorter = v.word
  UNION SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON c.shorter = v.word),
ranked AS (
  SELECT a, b, n, count(*) OVER (PARTITION BY a) AS near,
         row_number() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS r FROM pairs),
formed AS (
  SELECT word, v.n, coalesce(near, 0)::BIGINT AS n_near,
         CASE WHEN r.n >= 5 * v.n THEN b END AS form, CASE WHEN r.n >= 5 * v.n THEN r.n END AS form_n
  FROM vocab v LEFT JOIN ranked r ON r.a = word AND r.r = 1),
chain(word, link) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.link WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, link AS root FROM chain c JOIN formed f ON f.word = c.link WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
""".replace("LOWERED", LOWERED)

HARD_NEGATIVES = """
WITH good AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.id AS anchor, b.id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS s
  FROM good a JOIN good b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor, id, s FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY s DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.s DESC, n.id))::INTEGER AS rank,
       n.id AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.s DESC, n.id) <= 10
"""

# the query's rules, longest first, and its list's words
URL_FILTER = """
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (
  SELECT *, '.' || host AS h, CASE
    WHEN h LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN h LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN h LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN h LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN h LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    list_has_any(string_split_regex(host, '[.-]'), ['ads', 'adult', 'bets', 'betting', 'casino', 'gambling', 'pills', 'poker',
      'porn', 'spam', 'viagra', 'xxx']) AS listed
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict,
       listed
FROM ruled
"""

ORACLE: dict[str, str] = {
    "op3_mixing": MIXING,
    "op4_chat": CHAT,
    "op5_html": HTML,
    "op7_decontamination": DECONTAMINATION,
    "op9_line_quality": LINE_QUALITY,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op11_spelling_variants": SPELLING,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_url_filter": URL_FILTER,
}
