"""One query per operator, each over whole tables. Keys follow the operator names of the survey."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import messages as msg
from textloom.functions import text as tx
from textloom.operators import annotate as an
from textloom.operators import corpus, filters, sentiment, tokens, trends
from textloom.operators.joins import lookup_join
from textloom.plans import analyze, tagging
from textloom.session import scratch_path, spread, stored
from textloom.sources import readers, writers
from textloom.streaming import queries as streams
from textloom.streaming import sources as stream_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN_DF = 2
LAMBDA = 1.0
SET_ID = "src1"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs ------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_documents(spark, sf_dir, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def documents(spark, sf_dir, *columns: str) -> DataFrame:
    """Documents for work that costs more than moving a small table to all cores."""
    return spread(plain_documents(spark, sf_dir, *columns))


def word_table(spark, sf_dir, stop_words=()) -> DataFrame:
    """Token rows whose stem is the word itself."""
    return tokens.word_rows(documents(spark, sf_dir), stop_words).withColumn("stem", F.col("word"))


def word_counts(spark, sf_dir) -> DataFrame:
    return tokens.word_counts(documents(spark, sf_dir)).withColumnRenamed("word", "term")


def status_text() -> F.Column:
    return F.concat_ws(
        " ", "event_type", F.concat(F.lit("#"), "event_type"), F.concat(F.lit("#u"), F.col("user_id"))
    )


def event_records(spark, sf_dir) -> DataFrame:
    """``prediction, status, createdAt`` from the event table."""
    return as_records(table(spark, sf_dir, "events"))


def as_records(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("value").alias("prediction"), status_text().alias("status"), F.col("ts").alias("createdAt")
    )


def event_tags(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("hashtag"), F.col("value").alias("prediction"), F.col("ts").alias("timestamp")
    )


def stream_of(spark, sf_dir, name: str) -> DataFrame:
    """One table, a file or a folder of files, as a stream of files.

    The brackets make the path a pattern: a stream takes a single file only from a pattern, and a filter of file
    names would find no file inside a folder.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}[.]parquet")


def drained(df: DataFrame, label: str) -> DataFrame:
    """Everything a stream writes until its source is used up."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    streams.until_drained(streams.file_sink(df, path, scratch_path(spark, f"{label}-state")))
    return spark.read.schema(df.schema).parquet(path)


def live_messages(docs: DataFrame) -> DataFrame:
    """``lang, text, createdAt``: documents as messages, one a second."""
    return docs.select("lang", "text", F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("createdAt"))


def tagged_messages(docs: DataFrame) -> DataFrame:
    """Live messages that name their source as a hashtag."""
    tagged = F.concat(F.col("text"), F.lit(" #"), F.col("source"))
    return live_messages(docs.withColumn("text", tagged))


def training(spark, sf_dir) -> DataFrame:
    """``doc_id, label, status`` from labelled documents."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return documents(spark, sf_dir).join(labels, "doc_id").select("doc_id", "label", F.col("text").alias("status"))


def fitted(spark, sf_dir):
    return sentiment.fit_sentiment(training(spark, sf_dir))


def entity_lexicon(spark, sf_dir) -> DataFrame:
    """``term, tag``: neighbouring word pairs and long words of the benchmark texts."""
    words = table(spark, sf_dir, "benchmark").select(tx.tokenize_regex(F.col("text")).alias("w"))
    pairs = words.select(F.explode(tx.ngrams(F.col("w"), 2)).alias("term"), F.lit("PAIR").alias("tag"))
    long = words.select(F.explode(F.filter("w", lambda x: F.length(x) >= 9)).alias("term"), F.lit("LONG").alias("tag"))
    return pairs.unionByName(long).distinct()


def role_tags(spark, sf_dir) -> DataFrame:
    """``word, pos`` training rows: the speaker's role stands for the tag of each spoken word."""
    said = table(spark, sf_dir, "conversations").select("role", F.explode(tx.tokenize_regex(F.col("text"))).alias("word"))
    return said.select("word", F.when(F.col("role") == "user", "VB").otherwise("NN").alias("pos"))


def pos_lexicon(spark, sf_dir) -> DataFrame:
    return stored(an.fit_pos_lexicon(role_tags(spark, sf_dir)), "pos-lexicon")


def tagged_tokens(spark, sf_dir) -> DataFrame:
    return an.tag_pos(an.token_rows(documents(spark, sf_dir)), pos_lexicon(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------------------------


@query
def read_csv_documents(spark, sf_dir):
    path = scratch_path(spark, "documents-csv")
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("docIndex"), "text")
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return readers.read_csv_documents(spark, path, "docIndex long, text string", multi_line=True)


@query
def read_labelled_csv(spark, sf_dir):
    path = scratch_path(spark, "labelled-csv")
    flat = F.regexp_replace("status", r"[\r\n]", " ")
    training(spark, sf_dir).select(
        "label", "doc_id", F.lit("day").alias("date"), F.lit("none").alias("query"), F.lit("user").alias("user"),
        flat.alias("status"),
    ).write.option("quoteAll", True).option("escape", '"').csv(path)
    return readers.read_labelled_csv(spark, path).select(F.col("label").cast("int").alias("label"), "status")


def document_collection(spark, sf_dir) -> str:
    path = scratch_path(spark, "collection")
    documents(spark, sf_dir, "source").select(
        F.col("doc_id").alias("docIndex"), "text", filters.object_id(F.col("source")).alias("mongoSetId")
    ).write.json(path)
    return path


COLLECTION_SCHEMA = "docIndex long, text string, mongoSetId struct<oid: string>"


@query
def read_collection(spark, sf_dir):
    docs = readers.read_collection(spark, "json", document_collection(spark, sf_dir), COLLECTION_SCHEMA)
    return docs.select("docIndex", "text", F.col("mongoSetId.oid").alias("oid"))


@query
def read_lexicon(spark, sf_dir):
    path = scratch_path(spark, "lexicon-csv")
    entity_lexicon(spark, sf_dir).write.csv(path)
    return readers.read_lexicon(spark, path)


@query
def message_stream_source(spark, sf_dir):
    path = scratch_path(spark, "messages-json")
    live_messages(documents(spark, sf_dir, "lang")).write.json(path)
    got = drained(stream_sources.message_stream(spark, path), "messages")
    return got.select("lang", "text", F.unix_timestamp("createdAt").alias("created"))


@query
def queue_sink_csv(spark, sf_dir):
    return event_records(spark, sf_dir).select(
        msg.scored_csv(F.col("prediction"), F.col("status"), F.col("createdAt")).alias("value")
    )


@query
def queue_sink_text(spark, sf_dir):
    return event_records(spark, sf_dir).select(
        msg.scored_text(F.col("prediction"), F.col("status")).alias("value")
    )


@query
def save_ngrams(spark, sf_dir):
    base = scratch_path(spark, "saved")
    writers.save_ngrams(ngram_dictionary(spark, sf_dir), "c1", "parquet", base)
    saved = spark.read.parquet(f"{base}/{writers.NGRAM_COLLECTION}")
    return saved.withColumn("oid", F.col("classifierId.oid")).drop("classifierId")


@query
def save_doc_features(spark, sf_dir):
    base = scratch_path(spark, "saved")
    writers.save_doc_features(doc_features(spark, sf_dir), "parquet", base)
    return spark.read.parquet(f"{base}/{writers.FEATURE_COLLECTION}")


def _agreement(scored: DataFrame, rows: DataFrame, model, key: str) -> DataFrame:
    """Each scored row with whether a plain table scored by the same model has the same prediction."""
    table_scores = sentiment.score(rows, model).select(key, F.col("prediction").alias("expected"))
    return scored.join(table_scores, key).select(key, (F.col("prediction") == F.col("expected")).alias("agrees"))


@query
def model_save_load(spark, sf_dir):
    """The loaded model predicts what the fitted one does, for every document."""
    model, path = fitted(spark, sf_dir), scratch_path(spark, "model")
    sentiment.save_model(model, path)
    rows = documents(spark, sf_dir).withColumnRenamed("text", "status")
    loaded = sentiment.score(rows, sentiment.load_model(path)).select("doc_id", "prediction")
    return _agreement(loaded, rows, model, "doc_id")


@query
def temp_view_sql(spark, sf_dir):
    docs = plain_documents(spark, sf_dir, "source")
    return filters.query_view(docs, "corpus", "SELECT doc_id, source FROM corpus WHERE source = :s", s=SET_ID)


# --- filters and projections -------------------------------------------------------------------


@query
def filter_null_text(spark, sf_dir):
    nulled = plain_documents(spark, sf_dir, "lang").withColumn("text", F.when(F.col("lang") != "fr", F.col("text")))
    return filters.with_text(nulled).select("doc_id", "text")


@query
def filter_lang_hashtag(spark, sf_dir):
    return filters.with_hashtag(plain_documents(spark, sf_dir, "lang")).select("doc_id", "text")


@query
def filter_any_keyword(spark, sf_dir):
    return filters.with_any_keyword(plain_documents(spark, sf_dir, "lang")).select("doc_id", "text")


@query
def filter_like(spark, sf_dir):
    return filters.status_like(plain_documents(spark, sf_dir), "%tion%", "text").select("doc_id")


@query
def filter_nested_field(spark, sf_dir):
    docs = plain_documents(spark, sf_dir, "source").withColumn("mongoSetId", filters.object_id(F.col("source")))
    return filters.in_set(docs, SET_ID).select("doc_id", F.col("mongoSetId.oid").alias("oid"))


@query
def filter_not_null_key(spark, sf_dir):
    keyed = plain_documents(spark, sf_dir, "lang").withColumn("cId", F.when(F.col("lang") == "en", "c1"))
    return filters.key_not_null(keyed, "cId").select("doc_id", "cId")


@query
def having_min_count(spark, sf_dir):
    return trends.window_bounds(filters.having_min_count(_trend(spark, sf_dir), 1)).select(
        "start", "hashtag", "count"
    )


@query
def filter_in_vocabulary(spark, sf_dir):
    vocab = stored(vocabulary_fit(spark, sf_dir), "vocabulary")
    totals = word_counts(spark, sf_dir).withColumnRenamed("term", "word").withColumn("stem", F.col("word"))
    forms = corpus.stem_forms(corpus.word_totals(totals))
    return corpus.ngram_index(forms, vocab).select("stem", "count")


@query
def filter_pos_prefix(spark, sf_dir):
    return an.counted_pos(tagged_tokens(spark, sf_dir)).select("doc_id", "sentence", "token", "word", "pos")


@query
def map_pos_coarse(spark, sf_dir):
    tagged = tagged_tokens(spark, sf_dir)
    return tagged.select("doc_id", "sentence", "token", an.coarse_pos(F.col("pos")).alias("pos"))


@query
def filter_pos_eq(spark, sf_dir):
    coarse = tagged_tokens(spark, sf_dir).withColumn("pos", an.coarse_pos(F.col("pos")))
    return coarse.where(F.col("pos") == "VERB").select("doc_id", "sentence", "token", "word")


@query
def filter_non_entity(spark, sf_dir):
    labelled = an.tag_entities(documents(spark, sf_dir), entity_lexicon(spark, sf_dir))
    return an.entity_tokens(labelled).select("doc_id", "sentence", "token", "word", "ner")


@query
def filter_stopword_rows(spark, sf_dir):
    rows = an.token_rows(documents(spark, sf_dir)).select("doc_id", "word")
    return filters.without_stopword_rows(rows, tx.default_stop_words())


@query
def project_columns(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars")


@query
def project_window_bounds(spark, sf_dir):
    return trends.window_bounds(_trend(spark, sf_dir)).select("start", "end", "hashtag", "count")


@query
def rename_positional(spark, sf_dir):
    return filters.renamed(table(spark, sf_dir, "labels"), {"quality": "label", "doc_id": "docIndex"})


@query
def with_constant(spark, sf_dir):
    rows = filters.with_constant(table(spark, sf_dir, "documents").select("doc_id"), "cId", "c1")
    return rows.withColumn("oid", filters.object_id("c1")["oid"])


# --- joins and aggregations --------------------------------------------------------------------


@query
def stopword_anti_join(spark, sf_dir):
    stops = spark.createDataFrame([(w,) for w in tx.default_stop_words()], "word string")
    return filters.stopword_anti_join(word_table(spark, sf_dir).select("doc_id", "word"), stops)


@query
def ngram_index(spark, sf_dir):
    vocab = stored(vocabulary_fit(spark, sf_dir), "vocabulary")
    stems = word_counts(spark, sf_dir).select(F.col("term").alias("stem")).distinct()
    return corpus.ngram_index(stems, vocab)


@query
def collect_doc_terms(spark, sf_dir):
    terms = documents(spark, sf_dir).select("doc_id", tx.tokenize_regex(F.col("text")).alias("terms"))
    return terms.where(F.size("terms") > 0).select("doc_id", F.sort_array("terms").alias("terms"))


@query
def doc_term_counts(spark, sf_dir):
    """Counted from a token table, as for tokens of any origin."""
    return corpus.doc_term_counts(word_table(spark, sf_dir))


@query
def word_counts_in_place(spark, sf_dir):
    return word_counts(spark, sf_dir)


@query
def vocabulary_fit(spark, sf_dir):
    return corpus.vocabulary_fit(word_counts(spark, sf_dir), MIN_DF)


@query
def doc_features(spark, sf_dir):
    counts = stored(word_counts(spark, sf_dir), "counts")
    vocab = stored(corpus.vocabulary_fit(counts, MIN_DF), "vocabulary")
    return corpus.doc_features(counts, vocab, "c1")


@query
def ngram_dictionary(spark, sf_dir):
    """Stems are the first four letters here, so that a stem has several surface forms."""
    docs = documents(spark, sf_dir)
    counts = stored(tokens.word_counts(docs).withColumn("stem", F.substring("word", 1, 4)), "counts")
    per_doc = tokens.word_counts(docs, cut=4).withColumnRenamed("word", "term")
    vocab = stored(corpus.vocabulary_fit(per_doc, MIN_DF), "vocabulary")
    return corpus.ngram_dictionary(corpus.word_totals(counts), vocab)


@query
def pos_word_counts(spark, sf_dir):
    """Counted from tagged token rows."""
    rows = an.counted_pos(an.tag_pos(an.token_rows(documents(spark, sf_dir)), pos_lexicon(spark, sf_dir)))
    kept = filters.without_stopword_rows(rows, tx.default_stop_words())
    return an.pos_word_counts(kept.withColumn("pos", an.coarse_pos(F.col("pos"))))


@query
def pos_words_by_vocabulary(spark, sf_dir):
    """The same report from distinct words."""
    return tagging.count_pos_words(documents(spark, sf_dir), pos_lexicon(spark, sf_dir))


def _trend(spark, sf_dir):
    return trends.windowed_trend(event_tags(spark, sf_dir))


@query
def windowed_trend(spark, sf_dir):
    rows = trends.window_bounds(_trend(spark, sf_dir))
    return rows.withColumn("avg", F.round("avg", 6))


@query
def entity_counts(spark, sf_dir):
    return tagging.count_entities(documents(spark, sf_dir), entity_lexicon(spark, sf_dir))


# --- sorts, limits, set operations -------------------------------------------------------------


@query
def sort_trends(spark, sf_dir):
    rows = trends.window_bounds(trends.sorted_trend(filters.having_min_count(_trend(spark, sf_dir), 2)))
    return rows.withColumn("avg", F.round("avg", 6))


@query
def topk_pos_words(spark, sf_dir):
    return tagging.top_words(documents(spark, sf_dir), pos_lexicon(spark, sf_dir), "VERB", 50)


@query
def sort_doc(spark, sf_dir):
    terms = word_counts(spark, sf_dir).groupBy("doc_id").agg(F.sum("n").alias("terms"))
    return terms.orderBy("doc_id").limit(200)


@query
def union_stems_bigrams(spark, sf_dir):
    docs = documents(spark, sf_dir)
    words = tokens.word_rows(docs).withColumn("stem", F.col("word"))
    return tokens.union_stems_bigrams(words, tokens.bigram_rows(docs))


# --- text --------------------------------------------------------------------------------------


@query
def tokenize_whitespace(spark, sf_dir):
    words = tx.tokenize_whitespace(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", F.posexplode(words).alias("pos", "word"))


@query
def tokenize_regex(spark, sf_dir):
    words = tx.tokenize_regex(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", F.posexplode(words).alias("pos", "word"))


@query
def remove_stopwords(spark, sf_dir):
    words = tx.remove_stopwords(tx.tokenize_regex(F.col("text")), tx.default_stop_words())
    return documents(spark, sf_dir).select("doc_id", F.posexplode(words).alias("pos", "word"))


@query
def bigrams(spark, sf_dir):
    pairs = tx.ngrams(tx.tokenize_regex(F.col("text")), 2)
    return documents(spark, sf_dir).select("doc_id", F.posexplode(pairs).alias("pos", "bigram"))


@query
def explode_bigrams(spark, sf_dir):
    return tokens.bigram_rows(documents(spark, sf_dir), tx.default_stop_words())


@query
def explode_words(spark, sf_dir):
    return tokens.word_rows(documents(spark, sf_dir), tx.default_stop_words())


@query
def stem_words(spark, sf_dir):
    words = tokens.word_rows(documents(spark, sf_dir))
    stemmed = tokens.stem_words(words)
    return stemmed.groupBy("stem", "word").agg(F.count(F.lit(1)).alias("n"))


@query
def stem_words_table(spark, sf_dir):
    """Another language: stems come from a table, here the first five letters of long words."""
    docs = documents(spark, sf_dir, "lang").where(F.col("lang") == "fr")
    words = tokens.word_rows(docs)
    given = words.where(F.length("word") > 5).select("word", F.substring("word", 1, 5).alias("stem"))
    return tokens.stem_words(words, "french", given).select("doc_id", "word", "stem")


@query
def stem_words_languages(spark, sf_dir):
    """Every word of the four languages with the stem by the rules of its language."""
    return tokens.stems_by_language(documents(spark, sf_dir, "lang"))


@query
def stem_words_german(spark, sf_dir):
    """The German words among them; SQL follows the same published rules by patterns."""
    return tokens.stems_by_language(documents(spark, sf_dir, "lang").where("lang = 'de'"))


@query
def doc_stems(spark, sf_dir):
    return tokens.doc_stems(documents(spark, sf_dir), tx.default_stop_words(), bigrams=True)


@query
def doc_stems_table(spark, sf_dir):
    """The same with stems given by a table."""
    docs = documents(spark, sf_dir)
    return tokens.doc_stems(docs, tx.default_stop_words(), bigrams=True, stems=_cut_stems(spark, sf_dir))


@query
def analyze_text_features(spark, sf_dir):
    return analyze.analyze_text(documents(spark, sf_dir), "c1", bigrams=True, min_df=MIN_DF)[0]


@query
def analyze_text_ngrams(spark, sf_dir):
    return analyze.analyze_text(documents(spark, sf_dir), "c1", bigrams=False, min_df=MIN_DF)[1]


def _processed(spark, sf_dir) -> str:
    """Folder with the collections of one document set, stems given by a table."""
    source, target = document_collection(spark, sf_dir), scratch_path(spark, "processed")
    analyze.process_documents(
        spark, SET_ID, "c1", "json", source, target, COLLECTION_SCHEMA,
        bigrams=True, min_df=MIN_DF, stems=_cut_stems(spark, sf_dir),
    )
    return target


@query
def process_documents_ngrams(spark, sf_dir):
    schema = "stem string, unstemmed array<string>, count long, index long, word string, classifierId struct<oid: string>"
    ngrams = spark.read.schema(schema).json(f"{_processed(spark, sf_dir)}/{writers.NGRAM_COLLECTION}")
    return ngrams.withColumn("oid", F.col("classifierId.oid")).drop("classifierId")


@query
def process_documents(spark, sf_dir):
    schema = "d long, indexes array<int>, counts array<int>, cId string"
    return spark.read.schema(schema).json(f"{_processed(spark, sf_dir)}/{writers.FEATURE_COLLECTION}")


@query
def extract_hashtags(spark, sf_dir):
    return trends.hashtag_rows(event_records(spark, sf_dir))


@query
def parse_scored_csv(spark, sf_dir):
    lines = queue_sink_csv(spark, sf_dir).select(msg.parse_scored_csv(F.col("value")).alias("r"))
    return lines.select("r.prediction", "r.status", F.col("r.createdAt").cast("timestamp_ntz").alias("createdAt"))


@query
def format_scored_csv(spark, sf_dir):
    docs = plain_documents(spark, sf_dir)
    line = msg.scored_csv(F.lit(1.0), F.col("text"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return docs.select("doc_id", line.alias("value"))


@query
def cast_bytes_to_string(spark, sf_dir):
    body = plain_documents(spark, sf_dir).select(F.encode("text", "UTF-8").alias("value"))
    return stream_sources.cast_value(body)


@query
def document_assemble(spark, sf_dir):
    docs = an.assemble(plain_documents(spark, sf_dir)).select("doc_id", F.explode("document").alias("a"))
    return docs.select("doc_id", "a.annotatorType", "a.begin", "a.end", "a.result")


@query
def detect_sentences(spark, sf_dir):
    docs = an.detect_sentences(an.assemble(documents(spark, sf_dir)))
    return an.annotation_rows(docs, "sentence")


@query
def tokenize_annotations(spark, sf_dir):
    return an.annotation_rows(an.annotate(documents(spark, sf_dir)), "token")


@query
def annotate_documents(spark, sf_dir):
    docs = an.annotate(documents(spark, sf_dir, "lang"))
    return docs.select(
        "doc_id", "lang", F.size("document").alias("documents"), F.size("sentence").alias("sentences"),
        F.size("token").alias("tokens"),
    )


@query
def tag_entities_dict(spark, sf_dir):
    labelled = an.tag_entities(documents(spark, sf_dir), entity_lexicon(spark, sf_dir))
    return labelled.select("doc_id", "sentence", "token", "word", "ner")


@query
def fit_pos_lexicon(spark, sf_dir):
    return an.fit_pos_lexicon(role_tags(spark, sf_dir))


@query
def tag_pos(spark, sf_dir):
    return tagged_tokens(spark, sf_dir)


@query
def merge_entity_spans(spark, sf_dir):
    return an.merge_entity_spans(an.entity_token_rows(documents(spark, sf_dir), entity_lexicon(spark, sf_dir)))


# --- machine learning --------------------------------------------------------------------------


@query
def hashing_tf(spark, sf_dir):
    words = documents(spark, sf_dir).select("doc_id", tx.tokenize_regex(F.col("text")).alias("words"))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return sentiment.hashing_tf(words, "words").select("doc_id", total.cast("long").alias("words"))


@query
def count_vectorize(spark, sf_dir):
    vectors = doc_features(spark, sf_dir)
    return vectors.select(F.col("d").alias("doc_id"), F.explode(F.arrays_zip("indexes", "counts")).alias("e")).select(
        "doc_id", F.col("e.indexes").alias("index"), F.col("e.counts").alias("n")
    )


@query
def nb_log_prior(spark, sf_dir):
    labels = training(spark, sf_dir).select(F.col("label").cast("int").alias("label"))
    return sentiment.nb_log_prior(labels, LAMBDA).select("label", F.round("log_prior", 9).alias("log_prior"))


@query
def nb_log_theta(spark, sf_dir):
    docs = training(spark, sf_dir).withColumnRenamed("status", "text")
    counts = stored(tokens.word_counts(docs).withColumnRenamed("word", "term"), "counts")
    vocab = stored(corpus.vocabulary_fit(counts, MIN_DF).select("term"), "vocabulary")
    labels = docs.select("doc_id", F.col("label").cast("int").alias("label"))
    known = lookup_join(counts, vocab, "term").join(labels, "doc_id")
    theta = sentiment.nb_log_theta(known, LAMBDA)
    return theta.select("label", "term", F.round("log_theta", 9).alias("log_theta"))


@query
def naive_bayes_fit(spark, sf_dir):
    """The fitted estimator's log probability of each term in each class, over an explicit vocabulary."""
    rows = training(spark, sf_dir).select("label", tx.tokenize_regex(F.col("status")).alias("words"))
    # Larger than any vocabulary of these tables: the estimator always has a bound.
    vectorizer = CountVectorizer(inputCol="words", outputCol="features", minDF=MIN_DF, vocabSize=(1 << 31) - 1)
    model = Pipeline(stages=[vectorizer, sentiment.naive_bayes()]).fit(rows)
    terms, theta = model.stages[0].vocabulary, model.stages[1].theta.toArray()
    # The model itself: one number per class and vocabulary term.
    by_class = [pd.DataFrame({"label": k, "term": terms, "log_theta": theta[k]}) for k in range(len(theta))]
    fitted_values = spark.createDataFrame(pd.concat(by_class), "label int, term string, log_theta double")
    return fitted_values.withColumn("log_theta", F.round("log_theta", 9))


@query
def sentiment_fit(spark, sf_dir):
    """How the fitted pipeline classifies its own training rows, by label name."""
    rows = training(spark, sf_dir)
    scored = sentiment.score(rows, sentiment.fit_sentiment(rows, named=True))
    return scored.groupBy("label", "predicted_label").agg(F.count(F.lit(1)).alias("n"))


@query
def sentiment_score(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumnRenamed("text", "status")
    return sentiment.score(rows, fitted(spark, sf_dir)).select("doc_id", "prediction")


# --- streams -----------------------------------------------------------------------------------


@query
def stateful_trend_query(spark, sf_dir):
    """Windows closed by the watermark, written by a stream over the event table."""
    records = as_records(stream_of(spark, sf_dir, "events")).withColumn("createdAt", F.col("createdAt").cast("timestamp"))
    closed = drained(trends.window_bounds(streams.popular_trends(records, 1)), "trend")
    return closed.select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"),
        "hashtag", "count", F.round("avg", 6).alias("avg"),
    )


@query
def streaming_filter_query(spark, sf_dir):
    records = as_records(stream_of(spark, sf_dir, "events"))
    return drained(streams.status_report(records, "%click%"), "status")


@query
def queue_round_trip(spark, sf_dir):
    """Scored CSV lines published by one stream, parsed and counted per hashtag by the next."""
    spark_lines = scratch_path(spark, "lines")
    lines = as_records(stream_of(spark, sf_dir, "events")).select(
        msg.scored_csv(F.col("prediction"), F.col("status"), F.col("createdAt")).alias("value")
    )
    streams.until_drained(streams.file_sink(lines, spark_lines, scratch_path(spark, "lines-state"), "text"))
    records, _ = stream_sources.scored_records(
        stream_sources.file_source(spark, spark_lines, "value string", "text")
    )
    tags = drained(trends.hashtag_rows(records), "tags")
    return tags.groupBy("hashtag").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("avg"))


def is_class(prediction) -> F.Column:
    return prediction.isin(0.0, 1.0)


@query
def hashtag_scoring_stream(spark, sf_dir):
    """Published CSV lines, parsed again: each message once, scored with a class index."""
    messages = tagged_messages(stream_of(spark, sf_dir, "documents"))
    lines = drained(streams.hashtag_lines(messages, fitted(spark, sf_dir)), "hashtag-lines")
    parsed = lines.select(msg.parse_scored_csv(F.col("value")).alias("r"))
    return parsed.select(
        "r.status", F.unix_timestamp("r.createdAt").alias("created"), is_class(F.col("r.prediction")).alias("scored")
    )


@query
def sentiment_scoring_stream(spark, sf_dir):
    """Published text lines, taken apart again: each message once, scored with a class index."""
    messages = live_messages(stream_of(spark, sf_dir, "documents"))
    lines = drained(streams.sentiment_lines(messages, fitted(spark, sf_dir)), "sentiment-lines")
    at = F.locate(msg.SCORE_MARK, F.col("value"))
    return lines.select(
        F.substring("value", at + len(msg.SCORE_MARK), F.length("value")).alias("status"),
        is_class(F.substring("value", F.lit(1), at - 1).try_cast("double")).alias("scored"),
    )


@query
def micro_batch_score(spark, sf_dir):
    """Stream and table give every document the same prediction."""
    model = fitted(spark, sf_dir)
    rows = stream_of(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("status"))
    scored = drained(sentiment.score(rows, model).select("doc_id", "prediction"), "scores")
    table_rows = documents(spark, sf_dir).withColumnRenamed("text", "status")
    return _agreement(scored, table_rows, model, "doc_id")


def _cut_stems(spark, sf_dir) -> DataFrame:
    """A stem table given from outside: the first five letters of each word."""
    words = tokens.word_rows(documents(spark, sf_dir)).select("word").distinct()
    return words.withColumn("stem", F.substring("word", 1, 5))


@query
def analyze_table_features(spark, sf_dir):
    docs, stems = documents(spark, sf_dir), _cut_stems(spark, sf_dir)
    return analyze.analyze_text(docs, "c1", bigrams=True, min_df=MIN_DF, stems=stems)[0]


@query
def analyze_table_ngrams(spark, sf_dir):
    docs, stems = documents(spark, sf_dir), _cut_stems(spark, sf_dir)
    return analyze.analyze_text(docs, "c1", bigrams=True, min_df=MIN_DF, stems=stems)[1]


# --- several batches, several streams ----------------------------------------------------------


def _late_trend(spark, sf_dir, mode: str) -> DataFrame:
    """The trend after three batches: early events, later ones, then early ones that come late."""
    events = table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    late = (F.col("event_id") % 10 == 0) & (at < low + (high - low) // 4)
    early = at < low + (high - low) // 2
    folder, out, state = (scratch_path(spark, f"late-{mode}-{part}") for part in ("in", "out", "state"))
    schema = None

    def make(stream: DataFrame):
        nonlocal schema
        records = as_records(stream).withColumn("createdAt", F.col("createdAt").cast("timestamp"))
        trend = trends.window_bounds(streams.popular_trends(records, 1))
        schema = trend.schema
        return streams.publish_batches(trend, out, state, mode)

    streams.replay([events.where(~late & early), events.where(~late & ~early), events.where(late)], make, folder)
    found = streams.published(spark, out, schema, latest=mode == "complete")
    return found.withColumn("avg", F.round("avg", 6)).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query
def late_data_complete(spark, sf_dir):
    """In complete mode rows behind the watermark are counted."""
    return _late_trend(spark, sf_dir, "complete")


@query
def late_data_append(spark, sf_dir):
    """In append mode they are dropped, and only closed windows are written."""
    return _late_trend(spark, sf_dir, "append")


@query
def multi_query(spark, sf_dir):
    """Trend and status report of one source at once, beside a stream that fails."""
    records = as_records(stream_of(spark, sf_dir, "events")).withColumn("createdAt", F.col("createdAt").cast("timestamp"))
    trend = trends.window_bounds(streams.popular_trends(records, 1))
    status = records.where(F.col("status").like("%click%")).select("status")
    broken = records.select(F.raise_error(F.lit("refused")).cast("string").alias("status"))
    out = {name: scratch_path(spark, f"multi-{name}") for name in ("trend", "status", "broken")}
    writers = {
        "trend": streams.publish_batches(trend, out["trend"], scratch_path(spark, "multi-state"), "complete"),
        "status": streams.file_sink(status, out["status"], scratch_path(spark, "multi-state")),
        "broken": streams.file_sink(broken, out["broken"], scratch_path(spark, "multi-state")),
    }
    ended = streams.run_together(writers)
    hashtags = streams.published(spark, out["trend"], trend.schema, latest=True).groupBy(F.col("hashtag").alias("item"))
    lines = spark.read.schema(status.schema).parquet(out["status"]).groupBy(F.col("status").alias("item"))
    failed = spark.range(1).select(
        F.lit("broken").alias("report"), F.lit("failed" if ended["broken"] else "ended").alias("item"), F.lit(1).cast("long").alias("n")
    )
    return (
        hashtags.agg(F.sum("count").alias("n")).select(F.lit("trend").alias("report"), "item", "n")
        .union(lines.agg(F.count(F.lit(1)).alias("n")).select(F.lit("status").alias("report"), "item", "n"))
        .union(failed)
    )


@query
def micro_batch_publish(spark, sf_dir):
    """Scored documents published by a stream whose last batch runs again after its commit was lost."""
    model = fitted(spark, sf_dir)
    rows = stream_of(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("status"))
    scored = sentiment.score(rows, model).select("doc_id", "prediction")
    out, state = scratch_path(spark, "published"), scratch_path(spark, "published-state")
    streams.until_drained(streams.publish_batches(scored, out, state))
    commit = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/commits/0")
    assert commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    streams.until_drained(streams.publish_batches(scored, out, state))
    return streams.published(spark, out, scored.schema).groupBy("doc_id").agg(F.count(F.lit(1)).alias("published"))
