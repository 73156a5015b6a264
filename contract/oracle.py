"""SQL for the registered queries, written for DuckDB without use of the library."""

from __future__ import annotations

import textwrap

# The English stop list Spark ships.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

ORACLES: dict[str, str] = {}


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOPS = _list(STOP_WORDS)
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = textwrap.dedent(sql).strip()


# --- shared table expressions ------------------------------------------------------------------


def words(where: str = "true", source: str = "documents") -> str:
    """``pw(doc_id, word, pos)``: words kept, numbered from 1 per document."""
    return f"""
    raw AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda w: w <> '') AS l
        FROM {source}
    ),
    pw AS (
        SELECT doc_id, unnest(k) AS word, generate_subscripts(k, 1) AS pos
        FROM (SELECT doc_id, list_filter(l, lambda word: {where}) AS k FROM raw)
    )"""


NO_STOPS = f"word NOT IN ({STOPS})"
PAIRS = """
    pairs AS (
        SELECT * FROM (
            SELECT doc_id, pos, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS word
            FROM pw
        ) WHERE word IS NOT NULL
    )"""


def counts(stem: str = "word", source: str = "pw") -> str:
    return f"""
    counts AS (SELECT doc_id, {stem} AS term, count(*) AS n FROM {source} GROUP BY ALL)"""


VOCABULARY = """
    vocab AS (
        SELECT row_number() OVER (ORDER BY cf DESC, term) - 1 AS index, term, cf, df
        FROM (
            SELECT term, sum(n)::BIGINT AS cf, count(*) AS df FROM counts GROUP BY term
            HAVING count(*) >= 2
        )
    )"""

FEATURES = """
    SELECT c.doc_id AS d,
           coalesce(list(v.index::INT ORDER BY v.index) FILTER (v.index IS NOT NULL), []) AS indexes,
           coalesce(list(c.n::INT ORDER BY v.index) FILTER (v.index IS NOT NULL), []) AS counts,
           'c1' AS "cId"
    FROM counts c LEFT JOIN vocab v USING (term) GROUP BY c.doc_id"""

DICTIONARY = """
    SELECT t.stem, list_sort(list(DISTINCT t.word)) AS unstemmed, count(*) AS count,
           any_value(v.index)::BIGINT AS index, min(t.word) AS word
    FROM stemmed t JOIN vocab v ON v.term = t.stem GROUP BY t.stem"""

CUT_STEMS = """
    stemmed AS (
        SELECT doc_id, word, substr(word, 1, 5) AS stem FROM pw
        UNION ALL SELECT doc_id, word, word AS stem FROM pairs
    )"""

SENTENCES = """
    pieces AS (
        SELECT doc_id, unnest(l) AS piece, generate_subscripts(l, 1) AS i
        FROM (
            SELECT doc_id, string_split(
                regexp_replace(text, '([.!?])(\\s)', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS l
            FROM documents
        )
    ),
    placed AS (
        SELECT doc_id, i, piece, regexp_replace(piece, '^\\s+', '') AS body,
               coalesce(sum(length(piece)) OVER (
                   PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
        FROM pieces
    ),
    sentences AS (
        SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS sentence,
               (off + length(piece) - length(body))::INT AS begin,
               regexp_replace(body, '\\s+$', '') AS result
        FROM placed WHERE body <> ''
    )"""

TOKENS = """
    parts AS (
        SELECT doc_id, sentence, begin AS base, unnest(l) AS part, generate_subscripts(l, 1) AS i
        FROM (
            SELECT doc_id, sentence, begin, regexp_extract_all(result, '\\w+|[^\\w\\s]|\\s') AS l FROM sentences
        )
    ),
    tokens AS MATERIALIZED (
        SELECT doc_id, sentence, (row_number() OVER (PARTITION BY doc_id, sentence ORDER BY i) - 1)::INT AS token,
               part AS word, (base + off)::INT AS begin, (base + off + length(part) - 1)::INT AS end_
        FROM (
            SELECT *, coalesce(sum(length(part)) OVER (
                PARTITION BY doc_id, sentence ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
            FROM parts
        ) WHERE NOT regexp_full_match(part, '\\s')
    )"""

LEXICON = """
    bw AS (
        SELECT item_id, unnest(l) AS word, generate_subscripts(l, 1) AS pos
        FROM (
            SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda w: w <> '') AS l
            FROM benchmark
        )
    ),
    lexicon AS MATERIALIZED (
        SELECT DISTINCT term, tag FROM (
            SELECT word || ' ' || lead(word) OVER (PARTITION BY item_id ORDER BY pos) AS term, 'PAIR' AS tag FROM bw
            UNION ALL SELECT word, 'LONG' FROM bw WHERE length(word) >= 9
        ) WHERE term IS NOT NULL
    )"""

LABELLED = f"""
    {SENTENCES.strip()}, {TOKENS.strip()}, {LEXICON.strip()},
    grams AS MATERIALIZED (
        SELECT doc_id, sentence, token, 1 AS size, lower(word) AS phrase FROM tokens
        UNION ALL
        SELECT doc_id, sentence, token, 2, lower(word) || ' ' || lead(lower(word)) OVER (
            PARTITION BY doc_id, sentence ORDER BY token) FROM tokens
    ),
    matches AS MATERIALIZED (SELECT g.*, l.tag FROM grams g JOIN lexicon l ON l.term = g.phrase),
    covered AS (
        SELECT doc_id, sentence, token + k AS token, size, token AS start, tag
        FROM matches, (VALUES (0), (1)) AS t(k) WHERE k < size
    ),
    best AS (
        SELECT * FROM covered QUALIFY row_number() OVER (
            PARTITION BY doc_id, sentence, token ORDER BY size DESC, start, tag) = 1
    ),
    labelled AS (
        SELECT t.*, coalesce(b.tag, 'O') AS ner FROM tokens t LEFT JOIN best b USING (doc_id, sentence, token)
    )"""

SPANS = f"""
    {LABELLED.strip()},
    spans AS (
        SELECT doc_id, sentence, ner, min(token) AS first, max(token) AS last,
               string_agg(word, ' ' ORDER BY token) AS entity
        FROM (
            SELECT *, token - row_number() OVER (PARTITION BY doc_id, sentence, ner ORDER BY token) AS run
            FROM labelled WHERE ner <> 'O'
        ) GROUP BY doc_id, sentence, ner, run
    )"""

POS = """
    said AS (
        SELECT unnest(list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda w: w <> '')) AS word,
               CASE WHEN role = 'user' THEN 'VB' ELSE 'NN' END AS pos
        FROM conversations
    ),
    fitted AS (
        SELECT word, pos FROM (SELECT word, pos, count(*) AS n FROM said GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, pos) = 1
    )"""

TAGGED = f"""
    {SENTENCES.strip()}, {TOKENS.strip()}, {POS.strip()},
    tagged AS (
        SELECT t.*, coalesce(f.pos, CASE
            WHEN regexp_full_match(lower(t.word), '[^\\w\\s]+') THEN 'SYM'
            WHEN regexp_full_match(lower(t.word), '[0-9]+') THEN 'CD'
            WHEN lower(t.word) LIKE '%ing' THEN 'VBG'
            WHEN lower(t.word) LIKE '%ed' THEN 'VBD'
            WHEN lower(t.word) LIKE '%ly' THEN 'RB'
            WHEN regexp_matches(lower(t.word), '(able|ible|ful|ous|ive|al|ic)$') THEN 'JJ'
            WHEN regexp_matches(lower(t.word), '[^s]s$') THEN 'NNS'
            ELSE 'NN' END) AS pos
        FROM tokens t LEFT JOIN fitted f ON f.word = lower(t.word)
    ),
    coarse AS (
        SELECT doc_id, sentence, token, word, pos AS fine, CASE
            WHEN pos LIKE 'V%' THEN 'VERB' WHEN pos LIKE 'N%' THEN 'NOUN'
            WHEN pos LIKE 'RB%' THEN 'ADVERB' WHEN pos LIKE 'J%' THEN 'ADJECTIVE' ELSE pos END AS pos
        FROM tagged
    ),
    pos_counts AS (
        SELECT word, pos, count(*) AS count FROM coarse
        WHERE pos IN ('VERB', 'NOUN', 'ADVERB', 'ADJECTIVE') AND word NOT IN ({STOPS})
        GROUP BY word, pos
    )"""

RECORDS = """
    records AS (
        SELECT value AS prediction, event_type || ' #' || event_type || ' #u' || user_id AS status, ts AS created
        FROM events
    )"""
STAMP = """CASE WHEN contains(created::VARCHAR, '.') THEN created::VARCHAR ELSE created::VARCHAR || '.0' END"""

TREND = """
    trend AS (
        SELECT start, start + INTERVAL 10 MINUTE AS "end", hashtag, count(*) AS count, avg(prediction) AS avg
        FROM (
            SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts),
                           time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS start,
                   event_type AS hashtag, value AS prediction
            FROM events
        ) GROUP BY start, hashtag
    )"""

TRAINING = """
    train AS (
        SELECT d.doc_id, l.quality AS label, d.text FROM documents d JOIN labels l USING (doc_id)
    )"""

# --- sources and sinks -------------------------------------------------------------------------

oracle("read_csv_documents", 'SELECT doc_id AS "docIndex", text FROM documents WHERE text IS NOT NULL')
oracle(
    "read_labelled_csv",
    f"""WITH {TRAINING}
    SELECT label::INT AS label, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS status FROM train""",
)
oracle("read_collection", 'SELECT doc_id AS "docIndex", text, source AS oid FROM documents')
oracle("read_lexicon", f"WITH {LEXICON} SELECT term, tag FROM lexicon")
oracle("message_stream_source", "SELECT lang, text, 1704067200 + doc_id AS created FROM documents")
oracle(
    "queue_sink_csv",
    f"""WITH {RECORDS}
    SELECT '"' || prediction::VARCHAR || '","' || status || '","' || {STAMP} || '"' AS value FROM records""",
)
oracle(
    "queue_sink_text",
    f"WITH {RECORDS} SELECT prediction::VARCHAR || ' -- ' || status AS value FROM records",
)
oracle("temp_view_sql", "SELECT doc_id, source FROM documents WHERE source = 'src1'")

# --- filters and projections -------------------------------------------------------------------

oracle("filter_null_text", "SELECT doc_id, text FROM documents WHERE lang <> 'fr' AND text IS NOT NULL")
oracle("filter_lang_hashtag", "SELECT doc_id, text FROM documents WHERE lang = 'en' AND contains(text, '#')")
oracle(
    "filter_any_keyword",
    """SELECT doc_id, text FROM documents WHERE lang = 'en' AND (contains(text, 'happy')
    OR contains(text, 'sad') OR contains(text, 'love') OR contains(text, 'hate')
    OR contains(text, 'good') OR contains(text, 'bad'))""",
)
oracle("filter_like", "SELECT doc_id FROM documents WHERE text LIKE '%tion%'")
oracle("filter_nested_field", "SELECT doc_id, source AS oid FROM documents WHERE source = 'src1'")
oracle("filter_not_null_key", "SELECT doc_id, 'c1' AS \"cId\" FROM documents WHERE lang = 'en'")
oracle("having_min_count", f"WITH {TREND} SELECT start, hashtag, count FROM trend WHERE count > 1")
oracle(
    "filter_in_vocabulary",
    f"""WITH {words()}, {counts()}, {VOCABULARY}
    SELECT term AS stem, cf AS count FROM vocab""",
)
oracle(
    "filter_pos_prefix",
    f"""WITH {TAGGED} SELECT doc_id, sentence, token, word, pos FROM tagged
    WHERE pos LIKE 'V%' OR pos LIKE 'N%' OR pos LIKE 'RB%' OR pos LIKE 'J%'""",
)
oracle("map_pos_coarse", f"WITH {TAGGED} SELECT doc_id, sentence, token, pos FROM coarse")
oracle("filter_pos_eq", f"WITH {TAGGED} SELECT doc_id, sentence, token, word FROM coarse WHERE pos = 'VERB'")
oracle(
    "filter_non_entity",
    f"WITH {LABELLED} SELECT doc_id, sentence, token, word, ner FROM labelled WHERE ner <> 'O'",
)
oracle(
    "filter_stopword_rows",
    f"WITH {SENTENCES}, {TOKENS} SELECT doc_id, word FROM tokens WHERE word NOT IN ({STOPS})",
)
oracle("project_columns", "SELECT doc_id, n_chars FROM documents")
oracle("project_window_bounds", f'WITH {TREND} SELECT start, "end", hashtag, count FROM trend')
oracle("rename_positional", 'SELECT quality AS label, doc_id AS "docIndex" FROM labels')
oracle("with_constant", "SELECT doc_id, 'c1' AS \"cId\", 'c1' AS oid FROM documents")

# --- joins and aggregations --------------------------------------------------------------------

oracle("stopword_anti_join", f"WITH {words(NO_STOPS)} SELECT doc_id, word FROM pw")
oracle(
    "ngram_index",
    f"WITH {words()}, {counts()}, {VOCABULARY} SELECT term AS stem, index::BIGINT AS index FROM vocab",
)
oracle(
    "collect_doc_terms", f"WITH {words()} SELECT doc_id, list(word ORDER BY word) AS terms FROM pw GROUP BY doc_id"
)
oracle("doc_term_counts", f"WITH {words()}, {counts()} SELECT doc_id, term, n FROM counts")
oracle("word_counts_in_place", ORACLES["doc_term_counts"])
oracle(
    "vocabulary_fit",
    f"WITH {words()}, {counts()}, {VOCABULARY} SELECT index::INT AS index, term, cf, df FROM vocab",
)
oracle("doc_features", f"WITH {words()}, {counts()}, {VOCABULARY} {FEATURES}")
oracle("save_doc_features", ORACLES["doc_features"])
_FOUR = "stemmed AS (SELECT doc_id, word, substr(word, 1, 4) AS stem FROM pw)"
oracle(
    "ngram_dictionary",
    f"WITH {words()}, {_FOUR}, {counts('stem', 'stemmed')}, {VOCABULARY} {DICTIONARY}",
)
oracle(
    "save_ngrams",
    f"""WITH {words()}, {_FOUR}, {counts('stem', 'stemmed')}, {VOCABULARY}
    SELECT *, 'c1' AS oid FROM ({DICTIONARY})""",
)
oracle("pos_word_counts", f"WITH {TAGGED} SELECT word, pos, count FROM pos_counts")
oracle("pos_words_by_vocabulary", ORACLES["pos_word_counts"])
oracle(
    "windowed_trend", f'WITH {TREND} SELECT start, "end", hashtag, count, round(avg, 6) AS avg FROM trend'
)
oracle(
    "entity_counts", f"WITH {SPANS} SELECT entity, ner, count(*) AS count FROM spans GROUP BY entity, ner"
)

# --- sorts, limits, set operations -------------------------------------------------------------

oracle(
    "sort_trends",
    f"""WITH {TREND} SELECT start, "end", hashtag, count, round(avg, 6) AS avg FROM trend
    WHERE count > 2 ORDER BY start, count DESC, hashtag""",
)
oracle(
    "topk_pos_words",
    f"""WITH {TAGGED} SELECT word, pos, count FROM pos_counts WHERE pos = 'VERB'
    ORDER BY count DESC, word LIMIT 50""",
)
oracle(
    "sort_doc",
    f"WITH {words()} SELECT doc_id, count(*) AS terms FROM pw GROUP BY doc_id ORDER BY doc_id LIMIT 200",
)
oracle(
    "union_stems_bigrams",
    f"""WITH {words()}, {PAIRS}
    SELECT word, doc_id, word AS stem FROM pw UNION ALL SELECT word, doc_id, word FROM pairs""",
)

# --- text --------------------------------------------------------------------------------------

oracle(
    "tokenize_whitespace",
    f"""SELECT doc_id, unnest(l) AS word, (generate_subscripts(l, 1) - 1)::INT AS pos
    FROM (SELECT doc_id, regexp_split_to_array(rtrim(lower(text), {BLANKS}), '\\s') AS l FROM documents)""",
)
oracle("tokenize_regex", f"WITH {words()} SELECT doc_id, word, (pos - 1)::INT AS pos FROM pw")
oracle("remove_stopwords", f"WITH {words(NO_STOPS)} SELECT doc_id, word, (pos - 1)::INT AS pos FROM pw")
oracle("bigrams", f"WITH {words()}, {PAIRS} SELECT doc_id, (pos - 1)::INT AS pos, word AS bigram FROM pairs")
oracle(
    "explode_bigrams",
    f"WITH {words(NO_STOPS)}, {PAIRS} SELECT word, doc_id, word AS stem FROM pairs",
)
oracle("explode_words", f"WITH {words(NO_STOPS)} SELECT word, doc_id FROM pw")
oracle(
    "stem_words_table",
    f"""WITH {words(source="(SELECT * FROM documents WHERE lang = 'fr')")}
    SELECT doc_id, word, CASE WHEN length(word) > 5 THEN substr(word, 1, 5) ELSE word END AS stem FROM pw""",
)
oracle(
    "extract_hashtags",
    f"""WITH {RECORDS}
    SELECT hashtag, prediction, created AS timestamp
    FROM (SELECT unnest(string_split(status, ' ')) AS hashtag, prediction, created FROM records)
    WHERE starts_with(hashtag, '#')""",
)
oracle("parse_scored_csv", f'WITH {RECORDS} SELECT prediction, status, created AS "createdAt" FROM records')
oracle(
    "format_scored_csv",
    """SELECT doc_id, '"1.0","' || replace(text, '"', '""') || '","2024-01-01 00:00:00.0"' AS value
    FROM documents""",
)
oracle("cast_bytes_to_string", "SELECT text AS value FROM documents")
oracle(
    "document_assemble",
    """SELECT doc_id, 'document' AS "annotatorType", 0 AS begin, (length(text) - 1)::INT AS "end",
    text AS result FROM documents""",
)
oracle(
    "detect_sentences",
    f"""WITH {SENTENCES} SELECT doc_id, 'sentence' AS "annotatorType", begin,
    (begin + length(result) - 1)::INT AS "end", result, sentence FROM sentences""",
)
oracle(
    "tokenize_annotations",
    f"""WITH {SENTENCES}, {TOKENS} SELECT doc_id, 'token' AS "annotatorType", begin, end_ AS "end",
    word AS result, sentence FROM tokens""",
)
oracle(
    "annotate_documents",
    f"""WITH {SENTENCES}, {TOKENS}
    SELECT d.doc_id, d.lang, 1::INT AS documents, coalesce(s.n, 0)::INT AS sentences, coalesce(t.n, 0)::INT AS tokens
    FROM documents d
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM sentences GROUP BY doc_id) s USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id) t USING (doc_id)""",
)
oracle("tag_entities_dict", f"WITH {LABELLED} SELECT doc_id, sentence, token, word, ner FROM labelled")
oracle("fit_pos_lexicon", f"WITH {POS} SELECT word, pos FROM fitted")
oracle(
    "tag_pos",
    f"WITH {TAGGED} SELECT doc_id, sentence, token, word, pos FROM tagged",
)
oracle("merge_entity_spans", f"WITH {SPANS} SELECT doc_id, sentence, ner, first, last, entity FROM spans")

# --- machine learning --------------------------------------------------------------------------

oracle(
    "hashing_tf",
    f"""WITH {words()} SELECT d.doc_id, count(pw.word) AS words
    FROM documents d LEFT JOIN pw USING (doc_id) GROUP BY d.doc_id""",
)
oracle(
    "count_vectorize",
    f"""WITH {words()}, {counts()}, {VOCABULARY}
    SELECT doc_id, index::INT AS index, n::INT AS n FROM counts JOIN vocab USING (term)""",
)
oracle(
    "nb_log_prior",
    f"""WITH {TRAINING}, per AS (SELECT label, count(*) AS n FROM train GROUP BY label)
    SELECT label, round(ln(n + 1.0) - ln((SELECT sum(n) + count(*) FROM per)), 9) AS log_prior FROM per""",
)
oracle(
    "nb_log_theta",
    f"""WITH {TRAINING}, {words(source='train')}, {counts()}, {VOCABULARY},
    per AS (SELECT label, term, sum(n) AS n FROM counts JOIN vocab USING (term) JOIN train USING (doc_id) GROUP BY ALL),
    totals AS (SELECT label, sum(n) AS t FROM per GROUP BY label)
    SELECT totals.label, vocab.term,
           round(ln(coalesce(per.n, 0) + 1.0) - ln(t + (SELECT count(*) FROM vocab)), 9) AS log_theta
    FROM totals CROSS JOIN vocab LEFT JOIN per ON per.label = totals.label AND per.term = vocab.term""",
)

# --- streams -----------------------------------------------------------------------------------

oracle(
    "stateful_trend_query",
    f"""WITH {RECORDS}, tags AS (
        SELECT hashtag, prediction, created FROM (
            SELECT unnest(string_split(status, ' ')) AS hashtag, prediction, created FROM records
        ) WHERE starts_with(hashtag, '#')
    ),
    grouped AS (
        SELECT start, start + INTERVAL 10 MINUTE AS "end", hashtag, count(*) AS count, avg(prediction) AS avg
        FROM (
            SELECT unnest([time_bucket(INTERVAL 5 MINUTE, created),
                           time_bucket(INTERVAL 5 MINUTE, created) - INTERVAL 5 MINUTE]) AS start,
                   hashtag, prediction
            FROM tags
        ) GROUP BY start, hashtag
    )
    SELECT start, "end", hashtag, count, round(avg, 6) AS avg FROM grouped
    WHERE count > 1 AND "end" <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
oracle(
    "streaming_filter_query",
    f"""WITH {RECORDS} SELECT prediction, status, created AS "createdAt" FROM records
    WHERE status LIKE '%click%'""",
)
oracle(
    "queue_round_trip",
    f"""WITH {RECORDS}
    SELECT hashtag, count(*) AS n, round(avg(prediction), 6) AS avg
    FROM (SELECT unnest(string_split(status, ' ')) AS hashtag, prediction FROM records)
    WHERE starts_with(hashtag, '#') GROUP BY hashtag""",
)

# --- analysis with a given stem table ----------------------------------------------------------

_ANALYSIS = f"{words(NO_STOPS)}, {PAIRS}, {CUT_STEMS}, {counts('stem', 'stemmed')}, {VOCABULARY}"
oracle("analyze_table_features", f"WITH {_ANALYSIS} {FEATURES}")
oracle("analyze_table_ngrams", f"WITH {_ANALYSIS} {DICTIONARY}")
oracle("doc_stems_table", f"WITH {words(NO_STOPS)}, {PAIRS}, {CUT_STEMS} SELECT word, doc_id, stem FROM stemmed")
_SET = words(NO_STOPS, "(SELECT * FROM documents WHERE source = 'src1')")
_SET_ANALYSIS = f"{_SET}, {PAIRS}, {CUT_STEMS}, {counts('stem', 'stemmed')}, {VOCABULARY}"
oracle("process_documents", f"WITH {_SET_ANALYSIS} {FEATURES}")
oracle("process_documents_ngrams", f"WITH {_SET_ANALYSIS} SELECT *, 'c1' AS oid FROM ({DICTIONARY})")

# --- scored streams: which messages come out, and that scores agree -----------------------------

oracle("model_save_load", "SELECT doc_id, true AS agrees FROM documents")
oracle("micro_batch_score", "SELECT doc_id, true AS agrees FROM documents")
oracle(
    "hashtag_scoring_stream",
    """SELECT text || ' #' || source AS status, 1704067200 + doc_id AS created, true AS scored
    FROM documents WHERE lang = 'en'""",
)
oracle(
    "sentiment_scoring_stream",
    "SELECT text AS status, true AS scored FROM (" + ORACLES["filter_any_keyword"] + ")",
)
oracle("naive_bayes_fit", ORACLES["nb_log_theta"])

# --- English stems by the published rules, one step per table expression ------------------------

_REGION = "^.*?[aeiouy][^aeiouy]"
_SHORT = "^[aeiouy][^aeiouy]$|[^aeiouy][aeiouy][^aeiouywxY]$"
ENGLISH_STEMS = f"""
    marked AS (
        SELECT word, regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w
        FROM (SELECT DISTINCT word FROM pw)
    ),
    first_region AS (
        SELECT *, CASE WHEN starts_with(w, 'gener') OR starts_with(w, 'arsen') THEN 5
                       WHEN starts_with(w, 'commun') THEN 6
                       ELSE coalesce(nullif(length(regexp_extract(w, '{_REGION}')), 0), length(w)) END AS r1
        FROM marked
    ),
    regions AS (
        SELECT *, r1 + coalesce(nullif(length(regexp_extract(substr(w, r1 + 1), '{_REGION}')), 0), length(w) - r1) AS r2
        FROM first_region
    ),
    singular AS (
        SELECT word, r1, r2, CASE
            WHEN w LIKE '%sses' THEN left(w, -2)
            WHEN w LIKE '%ied' OR w LIKE '%ies' THEN left(w, CASE WHEN length(w) > 4 THEN -2 ELSE -1 END)
            WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
            WHEN w LIKE '%s' AND regexp_matches(left(w, -2), '[aeiouy]') THEN left(w, -1)
            ELSE w END AS w
        FROM regions
    ),
    tense AS (
        SELECT *, left(w, length(w) - length(suffix)) AS base
        FROM (SELECT *, regexp_extract(w, '(eedly|eed|ingly|edly|ing|ed)$') AS suffix FROM singular)
    ),
    plain AS (
        SELECT word, r1, r2, w AS one, CASE
            WHEN suffix = '' THEN w
            WHEN suffix LIKE 'eed%' THEN CASE WHEN length(base) >= r1 THEN base || 'ee' ELSE w END
            WHEN NOT regexp_matches(base, '[aeiouy]') THEN w
            WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
            WHEN regexp_matches(base, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(base, -1)
            WHEN length(base) <= r1 AND regexp_matches(base, '{_SHORT}') THEN base || 'e'
            ELSE base END AS w
        FROM tense
    ),
    ended_y AS (
        SELECT word, r1, r2, one,
               CASE WHEN length(w) > 2 THEN regexp_replace(w, '([^aeiouy])[yY]$', '\\1i') ELSE w END AS w
        FROM plain
    ),
    derived AS (
        SELECT *, left(w, length(w) - length(suffix)) AS base FROM (
            SELECT *, regexp_extract(w, '(tional|enci|anci|abli|entli|izer|ization|ational|ation|ator|alism|aliti|alli|fulness|ousli|ousness|iveness|iviti|biliti|bli|ogi|fulli|lessli|li)$') AS suffix
            FROM ended_y)
    ),
    step_two AS (
        SELECT word, r1, r2, one, CASE
            WHEN suffix = '' OR length(base) < r1 THEN w
            WHEN suffix = 'li' THEN CASE WHEN regexp_matches(base, '[cdeghkmnrt]$') THEN base ELSE w END
            WHEN suffix = 'ogi' THEN CASE WHEN base LIKE '%l' THEN base || 'og' ELSE w END
            ELSE base || CASE suffix
                WHEN 'tional' THEN 'tion' WHEN 'enci' THEN 'ence' WHEN 'anci' THEN 'ance'
                WHEN 'abli' THEN 'able' WHEN 'entli' THEN 'ent' WHEN 'izer' THEN 'ize'
                WHEN 'ization' THEN 'ize' WHEN 'ational' THEN 'ate' WHEN 'ation' THEN 'ate'
                WHEN 'ator' THEN 'ate' WHEN 'alism' THEN 'al' WHEN 'aliti' THEN 'al' WHEN 'alli' THEN 'al'
                WHEN 'fulness' THEN 'ful' WHEN 'ousli' THEN 'ous' WHEN 'ousness' THEN 'ous'
                WHEN 'iveness' THEN 'ive' WHEN 'iviti' THEN 'ive' WHEN 'biliti' THEN 'ble'
                WHEN 'bli' THEN 'ble' WHEN 'fulli' THEN 'ful' WHEN 'lessli' THEN 'less' END
            END AS w
        FROM derived
    ),
    step_three AS (
        SELECT word, r1, r2, one, CASE
            WHEN suffix = '' OR length(base) < CASE suffix WHEN 'ative' THEN r2 ELSE r1 END THEN w
            ELSE base || CASE suffix
                WHEN 'tional' THEN 'tion' WHEN 'ational' THEN 'ate' WHEN 'alize' THEN 'al' WHEN 'icate' THEN 'ic'
                WHEN 'iciti' THEN 'ic' WHEN 'ical' THEN 'ic' ELSE '' END
            END AS w
        FROM (
            SELECT *, left(w, length(w) - length(suffix)) AS base
            FROM (SELECT *, regexp_extract(w, '(tional|ational|alize|icate|iciti|ical|ful|ness|ative)$') AS suffix FROM step_two)
        )
    ),
    step_four AS (
        SELECT word, r1, r2, one,
               CASE WHEN suffix <> '' AND length(base) >= r2 AND (suffix <> 'ion' OR regexp_matches(base, '[st]$'))
                    THEN base ELSE w END AS w
        FROM (
            SELECT *, left(w, length(w) - length(suffix)) AS base FROM (
                SELECT *, regexp_extract(w, '(al|ance|ence|er|ic|able|ible|ant|ement|ment|ent|ism|ate|iti|ous|ive|ize|ion)$') AS suffix
                FROM step_three)
        )
    ),
    step_five AS (
        SELECT word, one, CASE
            WHEN w LIKE '%e' AND (length(w) > r2
                 OR (length(w) > r1 AND NOT regexp_matches(left(w, -1), '{_SHORT}'))) THEN left(w, -1)
            WHEN w LIKE '%ll' AND length(w) > r2 THEN left(w, -1)
            ELSE w END AS w
        FROM step_four
    ),
    english AS (
        SELECT word, CASE
            WHEN word = 'skis' THEN 'ski' WHEN word = 'skies' THEN 'sky' WHEN word = 'dying' THEN 'die'
            WHEN word = 'lying' THEN 'lie' WHEN word = 'tying' THEN 'tie' WHEN word = 'idly' THEN 'idl'
            WHEN word = 'gently' THEN 'gentl' WHEN word = 'ugly' THEN 'ugli' WHEN word = 'early' THEN 'earli'
            WHEN word = 'only' THEN 'onli' WHEN word = 'singly' THEN 'singl'
            WHEN word IN ('sky', 'news', 'howe', 'atlas', 'cosmos', 'bias', 'andes') OR length(word) <= 2 THEN word
            WHEN one IN ('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed') THEN one
            ELSE replace(w, 'Y', 'y') END AS stem
        FROM step_five
    )"""
_UNIGRAMS = "stemmed AS (SELECT pw.doc_id, pw.word, english.stem FROM pw JOIN english USING (word))"
_WITH_PAIRS = """
    stemmed AS (
        SELECT pw.doc_id, pw.word, english.stem FROM pw JOIN english USING (word)
        UNION ALL SELECT doc_id, word, word AS stem FROM pairs
    )"""
oracle(
    "stem_words",
    f"""WITH {words()}, {ENGLISH_STEMS}, {_UNIGRAMS}
    SELECT stem, word, count(*) AS n FROM stemmed GROUP BY stem, word""",
)
_STOPPED = f"{words(NO_STOPS)}, {ENGLISH_STEMS}"
oracle("doc_stems", f"WITH {_STOPPED}, {PAIRS}, {_WITH_PAIRS} SELECT word, doc_id, stem FROM stemmed")
oracle(
    "analyze_text_features",
    f"WITH {_STOPPED}, {PAIRS}, {_WITH_PAIRS}, {counts('stem', 'stemmed')}, {VOCABULARY} {FEATURES}",
)
oracle(
    "analyze_text_ngrams",
    f"WITH {_STOPPED}, {_UNIGRAMS}, {counts('stem', 'stemmed')}, {VOCABULARY} {DICTIONARY}",
)

# German stems by patterns: marks, regions and the three steps of the published rules.
oracle(
    "stem_words_german",
    r"""
WITH words AS (
    SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')) AS word FROM documents WHERE lang = 'de')
    GROUP BY word),
marked AS (
    SELECT word, n, regexp_replace(regexp_replace(replace(word, 'ß', 'ss'),
        '([aeiouyäöü])u([aeiouyäöü])', '\1U\2', 'g'), '([aeiouyäöü])y([aeiouyäöü])', '\1Y\2', 'g') AS w
    FROM words),
regions AS (
    SELECT *, CASE WHEN head = '' THEN length(w) ELSE length(head) END AS p1,
        CASE WHEN head = '' OR tail = '' THEN length(w) ELSE length(head) + length(tail) END AS r2
    FROM (
        SELECT *, regexp_extract(substr(w, length(head) + 1), '^[^aeiouyäöü]*[aeiouyäöü]+[^aeiouyäöü]') AS tail
        FROM (SELECT *, regexp_extract(w, '^[^aeiouyäöü]*[aeiouyäöü]+[^aeiouyäöü]') AS head FROM marked))),
first AS (
    SELECT *, greatest(p1, 3) AS r1, regexp_extract(w, '(?:ern|em|er|en|es|e|s)$') AS e FROM regions),
one AS (
    SELECT word, n, r1, r2, CASE
        WHEN e = '' OR length(w) - length(e) < r1 THEN w
        WHEN e = 's' THEN regexp_replace(w, '([bdfghklmnrt])s$', '\1')
        WHEN e IN ('e', 'en', 'es') THEN regexp_replace(left(w, length(w) - length(e)), 'niss$', 'nis')
        ELSE left(w, length(w) - length(e)) END AS w
    FROM first),
second AS (SELECT *, regexp_extract(w, '(?:est|en|er|st)$') AS e FROM one),
two AS (
    SELECT word, n, r1, r2, CASE
        WHEN e = '' OR length(w) - length(e) < r1 THEN w
        WHEN e = 'st' THEN regexp_replace(w, '^(.{3,}[bdfghklmnt])st$', '\1')
        ELSE left(w, length(w) - length(e)) END AS w
    FROM second),
third AS (SELECT *, regexp_extract(w, '(?:isch|lich|heit|keit|end|ung|ig|ik)$') AS d FROM two),
three AS (
    SELECT word, n, r1, r2, d, CASE
        WHEN d = '' OR length(w) - length(d) < r2 THEN NULL
        WHEN d IN ('ig', 'ik', 'isch') AND w LIKE '%e' || d THEN NULL
        ELSE left(w, length(w) - length(d)) END AS left_part, w
    FROM third),
four AS (
    SELECT word, n, CASE
        WHEN left_part IS NULL THEN w
        WHEN d IN ('end', 'ung') AND left_part LIKE '%ig' AND left_part NOT LIKE '%eig' AND length(left_part) - 2 >= r2
            THEN left(left_part, length(left_part) - 2)
        WHEN d IN ('lich', 'heit') AND (left_part LIKE '%er' OR left_part LIKE '%en') AND length(left_part) - 2 >= r1
            THEN left(left_part, length(left_part) - 2)
        WHEN d = 'keit' AND left_part LIKE '%lich' THEN
            CASE WHEN length(left_part) - 4 >= r2 THEN left(left_part, length(left_part) - 4) ELSE left_part END
        WHEN d = 'keit' AND left_part LIKE '%ig' AND length(left_part) - 2 >= r2 THEN left(left_part, length(left_part) - 2)
        ELSE left_part END AS stem
    FROM three)
SELECT 'de' AS lang, word, translate(stem, 'UYäöü', 'uyaou') AS stem, n FROM four""",
)

# --- several batches, several streams ----------------------------------------------------------

def _replayed(kept: str) -> str:
    return f"""WITH {_TAGS} SELECT start, start + INTERVAL 10 MINUTE AS "end", hashtag, count(*) AS count, round(avg(value), 6) AS avg
    FROM spread WHERE {kept} GROUP BY start, hashtag HAVING count(*) > 1"""


_TAGS = """
    bounds AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi, max(ts) AS last FROM events),
    tags AS (
        SELECT ts, unnest(['#' || event_type, '#u' || user_id]) AS hashtag, value,
               event_id % 10 = 0 AND epoch_us(ts) < (SELECT lo + (hi - lo) // 4 FROM bounds) AS late
        FROM events
    ),
    spread AS (
        SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS start,
               hashtag, value, late
        FROM tags
    )"""
oracle("late_data_complete", _replayed("true"))
oracle("late_data_append", _replayed("NOT late AND start + INTERVAL 20 MINUTE <= (SELECT last FROM bounds)"))
oracle(
    "multi_query",
    f"""WITH {_TAGS}, {RECORDS.strip()},
    trend AS (SELECT hashtag, count(*) AS n FROM spread GROUP BY start, hashtag HAVING count(*) > 1)
    SELECT 'trend' AS report, hashtag AS item, sum(n)::BIGINT AS n FROM trend GROUP BY hashtag
    UNION ALL SELECT 'status', status, count(*) FROM records WHERE status LIKE '%click%' GROUP BY status
    UNION ALL SELECT 'broken', 'failed', 1""",
)
oracle("micro_batch_publish", "SELECT doc_id, count(*) AS published FROM documents GROUP BY doc_id")
