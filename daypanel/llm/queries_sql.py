"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from daypanel.llm.quality_rules import BOILERPLATE, INNER_END, SENTENCE_END
from daypanel.llm.url_lists import DAYS, FIRST_DAY

_W = r"[^\x20\x09-\x0D]+"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP6 = rf"""
WITH hosts AS (SELECT DISTINCT lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) AS part FROM pages),
keys AS (SELECT DISTINCT host AS key, false AS deep FROM hosts WHERE host <> '' UNION ALL SELECT DISTINCT host || '/' || part, true FROM hosts WHERE host <> '' AND part <> ''),
steps AS (
  SELECT key, DATE '{FIRST_DAY}' + CAST(CAST('0x' || substr(md5(key), s.k, 4) AS INTEGER) % {DAYS} AS INTEGER) AS since, CASE WHEN deep THEN s.deep_action ELSE s.flat_action END AS action
  FROM keys, (VALUES (1, 'block', 'allow'), (5, 'remove', 'remove'), (9, 'block', 'block')) AS s(k, flat_action, deep_action)
),
listed AS (SELECT regexp_replace(key, '^www\.', '') AS key, since, max(action) AS action FROM steps GROUP BY 1, 2),
spans AS (SELECT key, action, since AS valid_from, lead(since) OVER (PARTITION BY key ORDER BY since) AS valid_to FROM listed),
captures AS (
  SELECT page_id, DATE '{FIRST_DAY}' + CAST((page_id * 7919) % {DAYS} AS INTEGER) AS fetched,
    regexp_replace(regexp_replace(url, '^[a-z]+://(www\.)?', ''), '[?#].*$', '') AS rest
  FROM pages
),
parts AS (SELECT page_id, fetched, lower(split_part(rest, '/', 1)) AS host, list_filter(list_slice(string_split(rest, '/'), 2, 10000), lambda x: x <> '') AS path FROM captures),
named AS (
  SELECT page_id, fetched, array_to_string(list_slice(string_split(host, '.'), k, 10000), '.') AS key FROM parts, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')))) AS k)
  UNION
  SELECT page_id, fetched, host || '/' || array_to_string(list_slice(path, 1, k), '/') FROM parts, LATERAL (SELECT unnest(range(1, len(path) + 1)) AS k)
),
active AS (SELECT n.page_id, s.key, s.action FROM named n JOIN spans s ON n.key = s.key AND s.action <> 'remove' AND n.fetched >= s.valid_from AND (s.valid_to IS NULL OR n.fetched < s.valid_to)),
best AS (SELECT page_id, count(*) AS n_active, max(struct_pack(a := length(key), b := key, c := action)) AS best FROM active GROUP BY page_id)
SELECT c.page_id, c.fetched, b.best.b AS matched, coalesce(b.n_active, 0) AS n_active, coalesce(b.best.c = 'block', false) AS blocked
FROM captures c LEFT JOIN best b ON c.page_id = b.page_id
"""

OP8 = rf"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_W}') AS words, list_filter(string_split(text, chr(10)), lambda x: length(translate(x, {_SPACES}, '')) > 0) AS lines FROM base
),
windows AS (SELECT doc_id, k, list_slice(words, k, k + 7) AS w FROM split, LATERAL (SELECT unnest(range(1, len(words) - 6)) AS k)),
twice AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT k + d) AS n FROM twice, range(8) AS r(d) GROUP BY doc_id),
rules AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(translate(text, {_SPACES}, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    list_filter(lines, lambda x: NOT (
      (NOT regexp_matches(x, {_text(SENTENCE_END)}) AND (len(regexp_extract_all(x, '{_W}')) < 10 OR NOT regexp_matches(x, {_text(INNER_END)})))
      OR (length(x) - length(translate(x, '#*$%&|<>', ''))) * 5 > len(regexp_extract_all(x, '{_W}'))
      OR len(regexp_extract_all(x, '!!+([\x20\x09-\x0D]|$)')) * 2 > len(regexp_extract_all(x, '{_W}'))
      OR regexp_matches(x, {_text(BOILERPLATE)})
    )) AS passing
  FROM split
),
counted AS (
  SELECT r.*, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(list_sum(list_transform(passing, lambda x: len(regexp_extract_all(x, '{_W}')))), 0) AS BIGINT) AS n_kept_words
  FROM rules r LEFT JOIN covered c ON r.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_kept_words >= 0.5 * n_words AS kept, n_kept_words, array_to_string(passing, chr(10)) AS cleaned
FROM counted
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, bit by bit (reflected polynomial EDB88320)."""
    data = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: {byte}), 4294967295)"


def _words11(table: str) -> str:
    return rf"SELECT * EXCLUDE (text), regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM (SELECT {table})"


OP11 = rf"""
WITH docs AS ({_words11("doc_id, text FROM documents")}),
target AS ({_words11("text FROM benchmark")}),
held AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM docs) GROUP BY 1, 2),
wanted AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM target) GROUP BY 1),
hashed AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM (SELECT w FROM held UNION SELECT w FROM wanted)),
s AS (SELECT bucket, sum(n) AS n FROM held JOIN hashed USING (w) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS n FROM wanted JOIN hashed USING (w) GROUP BY 1),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t),
gains AS (
  SELECT h.bucket, floor(1000 * ln(((coalesce(t.n, 0)::DOUBLE + 1) * (totals.s + 10000)) / ((coalesce(s.n, 0)::DOUBLE + 1) * (totals.t + 10000)))) AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) h LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals
),
weights AS (SELECT doc_id, floor(sum(gain * n) / sum(n)) AS weight FROM held JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id)
),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN place <= (10 * n) // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""


def _levels(name: str, key: str, n: int) -> str:
    """Tables ``name``0 to ``name``n: the nodes of each tree, level by level; a tree with one node stays as it is."""
    return ",\n".join(
        f"{name}{k + 1} AS (SELECT {key}, pos // 16 AS pos, CASE WHEN any_value(n) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d, (any_value(n) + 15) // 16 AS n FROM {name}{k} GROUP BY {key}, pos // 16)"
        for k in range(n)
    )


def _folds(name: str, key: str, n: int) -> str:
    """Tables f_``name``0 to n: each leaf's replaced node and its siblings so far."""
    return ",\n".join(
        f"""f_{name}{k + 1} AS (
  SELECT f.* EXCLUDE (pos, node, proof), f.pos // 16 AS pos,
    CASE WHEN r.n = 1 THEN node ELSE sha256(array_to_string(list_slice(ds, 1, f.pos % 16) || [node] || list_slice(ds, f.pos % 16 + 2, 16), '')) END AS node,
    CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(list_slice(ds, 1, f.pos % 16) || list_slice(ds, f.pos % 16 + 2, 16), '') END AS proof
  FROM f_{name}{k} f JOIN (SELECT {key}, pos // 16 AS up, list(d ORDER BY pos) AS ds, any_value(n) AS n FROM {name}{k} GROUP BY {key}, pos // 16) r ON f.{key} IS NOT DISTINCT FROM r.{key} AND f.pos // 16 = r.up
)"""
        for k in range(n)
    )


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Trees of up to 16 to the 7th leaves and 16 to the 5th sources.
OP12 = f"""
WITH hashed AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {_leaf(f"translate(text, {_AZ})")} ELSE {_leaf("text")} END AS shown FROM documents
),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM hashed),
a0 AS (SELECT source, pos, leaf AS d, n FROM leaves),
{_levels("a", "source", 7)},
b0 AS (SELECT 0 AS tree, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, d, count(*) OVER () AS n FROM a7),
{_levels("b", "tree", 5)},
f_a0 AS (SELECT doc_id, source, leaf, pos, shown AS node, '' AS proof FROM leaves),
{_folds("a", "source", 7)},
f_b0 AS (SELECT f.doc_id, f.leaf, s.d AS subroot, s.tree, s.pos, f.node, f.proof FROM f_a7 f JOIN b0 s ON f.source IS NOT DISTINCT FROM s.source),
{_folds("b", "tree", 5)}
SELECT f.doc_id, f.leaf, f.subroot, b5.d AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = b5.d AS verified FROM f_b5 f, b5
"""
