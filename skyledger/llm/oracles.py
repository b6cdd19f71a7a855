"""Operators as SQL over the same tables, where SQL can express them."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
       LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
),
doc_windows AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n FROM d, (SELECT DISTINCT n FROM item_windows)),
       LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
),
found AS (SELECT r, i, doc_windows.n, item_id FROM doc_windows JOIN item_windows USING (n, g)),
hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

_RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
_SUMS = ", ".join(f"sum(({c})::INT)::DOUBLE AS {n}" for n, c in _RULES.items())
_MEANS = ", ".join(
    f"sum({n}) / sum(n) AS {n}_m, sum({n} * {n} / n) / sum(n) - (sum({n}) / sum(n)) ** 2 AS {n}_v"
    for n in _RULES
)
_WEIGHT = "CASE WHEN {0}_v > 0 THEN least(1000, greatest(2, {0}_m * (1 - {0}_m) / {0}_v - 1)) ELSE 1000 END"
_ABOVE = " OR ".join(
    f"({n} + {n}_m * ({_WEIGHT.format(n)})) / (n + ({_WEIGHT.format(n)})) > 0.5" for n in _RULES
)
QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
),
runs AS (
  SELECT r, i, array_to_string(w[i : i + 4], ' ') AS g
  FROM (FROM d WHERE len(w) >= 5), LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM runs) WHERE c > 1),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
),
m AS (
  SELECT r, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l) AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeats USING (r)
),
hosts AS (SELECT source, count(*) AS n, {_SUMS} FROM m WHERE source IS NOT NULL GROUP BY source),
bad AS (SELECT source, true AS bad FROM hosts, (SELECT {_MEANS} FROM hosts) WHERE {_ABOVE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {_RULES["few_words"]} OR {_RULES["repeats"]} AS base_failed,
  NOT ({_RULES["few_words"]} OR {_RULES["repeats"]}) AND bad IS NULL AS kept
FROM m LEFT JOIN bad USING (source)
"""

FILTER_AUDIT = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS mask
  FROM d JOIN firsts USING (t) LEFT JOIN l USING (doc_id)
),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masks GROUP BY part, mask
),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, left(filter_order, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
),
states AS (
  SELECT part, filter_order, step, letter, mask, n, good, toxic, contains(mask, letter) AS fails,
    before <> '' AND regexp_matches(mask, '[' || before || '.]') AS gone
  FROM steps, cells
),
counted AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM states GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION,
    "op10_quality_rules": QUALITY_RULES,
    "op13_filter_audit": FILTER_AUDIT,
}
