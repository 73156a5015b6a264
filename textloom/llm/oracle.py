"""DuckDB SQL of the queries of this folder that SQL can express."""

from __future__ import annotations

from textloom.llm.chat import END, PART_TURNS, START
from textloom.llm.common import LOWER, UPPER
from textloom.llm.line_quality import BOILERPLATE, LINE_ENDS, MOST_LOST, NAVIGATION, PROSE_WORDS, WORDS_PER_SYMBOL
from textloom.llm.lines import MIN_CHARS


def folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


ORACLES = {
    "op2_perspective_rotation": f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) - 1 AS position
  FROM turns),
people AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'),
seen AS (
  SELECT conv_id, perspective, position, position // {PART_TURNS} AS part, coalesce(role = perspective, false) AS own,
    '{START}' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
      ELSE 'user name=' || regexp_replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '\\s', '_', 'g') END || chr(10) AS header,
    replace(coalesce(text, ''), '<|', '< |') || '{END}' AS body
  FROM placed JOIN people USING (conv_id)),
spans AS (
  SELECT *, sum(length(header) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY position) AS last
  FROM seen)
SELECT conv_id, perspective, part, count(*) AS n_turns,
  string_agg(header || body || chr(10), '' ORDER BY position) AS text,
  coalesce(string_agg((last - 1 - length(body)) || '-' || (last - 1), ',' ORDER BY position) FILTER (WHERE own), '') AS mask
FROM spans GROUP BY conv_id, perspective, part""",
    "op3_line_dedup": f"""
WITH pieces AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS piece, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents),
lines AS (SELECT doc_id, line_no, trim(piece, ' ' || chr(9) || chr(13)) AS line, piece FROM pieces),
firsts AS (
  SELECT line, min((doc_id, line_no)) AS place, length(line) AS n FROM lines WHERE line <> '' GROUP BY line),
long_lines AS (SELECT * FROM firsts WHERE n >= {MIN_CHARS}),
near AS (
  SELECT DISTINCT a.line
  FROM (SELECT *, unnest([n - 1, n, n + 1]) AS other_n FROM long_lines) a
  JOIN long_lines b ON b.n = a.other_n AND b.place < a.place
  WHERE levenshtein(a.line, b.line) = 1),
judged AS (
  SELECT l.doc_id, l.line_no, l.piece, l.line <> '' AS counted, n.line IS NOT NULL AS near,
    l.line <> '' AND (n.line IS NOT NULL OR (l.doc_id, l.line_no) <> f.place) AS gone
  FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near n ON l.line = n.line),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE counted)::INT AS n_lines, count(*) FILTER (WHERE gone)::INT AS n_dropped,
    count(*) FILTER (WHERE near)::INT AS n_near,
    coalesce(string_agg(piece, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS text
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::INT AS n_lines, coalesce(n_dropped, 0)::INT AS n_dropped,
  coalesce(n_near, 0)::INT AS n_near, CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op5_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(folded) AS text_sha256
FROM (SELECT doc_id, {folded('text')} AS folded FROM documents)
WINDOW same AS (PARTITION BY folded)""",
    "op6_decontaminate": rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({folded('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({folded('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
grams AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM sized))),
hits AS MATERIALIZED (SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, gram)),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op9_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({folded('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + k - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, least(4, len(w)) AS k, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i
        FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT a, a FROM edges UNION SELECT doc_id, b FROM reached JOIN edges ON other = a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)""",
    "op11_hard_negatives": """
WITH vectors AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.c, b.c)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.c) = len(b.c)),
positives AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.own
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3""",
    "op12_line_quality": rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM windows) WHERE times > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS copy
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM texts)),
judged AS (
  SELECT *, translate(line, '{UPPER}', '{LOWER}') AS low, right(rtrim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 1) AS mark
  FROM lines WHERE n > 0),
failing AS (
  SELECT *, n >= {PROSE_WORDS} AND {WORDS_PER_SYMBOL} * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > n
    OR n >= {PROSE_WORDS} AND mark NOT IN ({', '.join("'" + mark.replace("'", "''") + "'" for mark in LINE_ENDS)})
    OR regexp_matches(low, '{NAVIGATION}') OR regexp_matches(low, '{BOILERPLATE}') AS fails FROM judged),
of_lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE copy > 1) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_failed_lines,
    coalesce(sum(n) FILTER (WHERE fails), 0)::BIGINT AS lost_words
  FROM failing GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_failed_lines, 0) AS n_failed_lines,
    coalesce(lost_words, 0) AS lost_words
  FROM words LEFT JOIN repeated USING (doc_id) LEFT JOIN of_lines USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_words <= {MOST_LOST} * n_words AS kept
FROM counts""",
    "op13_collocations": rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex({folded('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS sizes(k))),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, f AS a FROM counts WHERE k > 1 AND f >= 100),
dropped AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN candidates longer ON longer.lang = c.lang AND longer.k > c.k
    AND 100 * longer.a >= 100 * c.a AND contains(' ' || longer.phrase || ' ', ' ' || c.phrase || ' ')),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM candidates)),
valued AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = first JOIN counts y ON y.lang = c.lang AND y.phrase = rest
    JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM valued ANTI JOIN dropped USING (lang, phrase))
SELECT lang, rank::INT AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
