"""One entry per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions import metrics as mx
from precis.functions import sequences as sq
from precis.functions import text as tx
from precis.operators import alignment, backoff, classifier, decoding, encoding, evaluation, filters, heavy, importance, ranking
from precis.operators import salience, splits, statistics, tfidf
from precis.operators import vocabulary as vb
from precis.operators.rows import unroll
from precis.plans import summaries, training_data
from precis.settings import DEFAULTS, PAD, START, SUMMARY, TEXT
from precis.sources import lines as ln
from precis.sources import pairs as pr
from precis.sources.storage import cut_lineage, scratch_path
from precis.streaming import tables
from registry.tables import documents, joined, pairs, r6, read, turns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Sizes as the operators have them by default.
STEPS, BEAM = DEFAULTS.max_summary_length, DEFAULTS.beam_width
SUMMARY_LENGTH = DEFAULTS.max_summary_length
TEXT_WORDS, SUMMARY_WORDS = DEFAULTS.text_vocabulary, DEFAULTS.summary_vocabulary


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _on_documents(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: build(documents(spark, sf))


def _on_pairs(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: build(pairs(spark, sf))


def _clean_pairs(p: DataFrame) -> DataFrame:
    return p.select("doc_id", tx.clean_text(TEXT).alias(TEXT), tx.clean_text(SUMMARY).alias(SUMMARY))


def _clean_documents(d: DataFrame) -> DataFrame:
    return d.select("doc_id", tx.clean_text("text").alias("clean"))


# --- sources and sinks ------------------------------------------------------


@query("read_pairs")
def _read_pairs(spark, sf):
    path = scratch_path(spark, "pairs-csv")
    pr.write_pairs_csv(pairs(spark, sf), path)
    return pr.read_pairs(spark, path).select(TEXT, SUMMARY)


@query("append_pairs")
def _append_pairs(spark, sf):
    path = scratch_path(spark, "pairs")
    p = splits.split_hash(pairs(spark, sf))
    for part in (splits.TRAIN, splits.VALIDATION):
        pr.append_pairs(p.where(F.col("split") == part).drop("split"), path, source=part)
    return spark.read.parquet(path).select("doc_id", TEXT, SUMMARY, "source")


def _as_stream(table: DataFrame) -> DataFrame:
    """A table as a stream of files, one in each batch."""
    path = scratch_path(table.sparkSession, "stream")
    table.repartition(4).write.parquet(path)
    return table.sparkSession.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("append_stream")
def _append_stream(spark, sf):
    path = scratch_path(spark, "pairs")
    stream = _as_stream(pairs(spark, sf))
    tables.append_stream(stream, path, scratch_path(spark, "state"), "talk").start().awaitTermination()
    logged = spark.read.parquet(path)
    # The batch that a row comes in is chance; its own key follows it.
    return logged.select(F.substring_index("doc_id", "-", -1).cast("long").alias("doc_id"), TEXT, SUMMARY, "source")


@query("word_freq_stream")
def _word_freq_stream(spark, sf):
    path = scratch_path(spark, "counts")
    stream = _as_stream(_clean_documents(documents(spark, sf)))
    tables.word_freq_stream(stream, "clean", path, scratch_path(spark, "state")).start().awaitTermination()
    return tables.read_word_freq(spark, path).drop("first_batch")


@query("write_split")
def _write_split(spark, sf):
    path = scratch_path(spark, "split")
    pr.write_split(splits.split_exact(pairs(spark, sf)), path)
    return spark.read.parquet(path).select("doc_id", TEXT, SUMMARY, "split")


@query("vocab_roundtrip")
def _vocab_roundtrip(spark, sf):
    path = scratch_path(spark, "vocabulary")
    cleaned = _clean_pairs(pairs(spark, sf))
    vb.fit_vocabulary(cleaned, SUMMARY, SUMMARY_WORDS).save(path)
    loaded = vb.Vocabulary.load(spark, path)
    return encoding.encode(cleaned, SUMMARY, loaded).select("doc_id", joined("ids").alias("ids"))


def _lines(d: DataFrame) -> DataFrame:
    """Documents cut at stops and line ends, which leaves blank lines in places."""
    cut = d.select("doc_id", F.split("text", "[.\n]").alias("lines"))
    return unroll(cut, ["doc_id"], "lines", "line_no", "line")


_on_documents("assemble_lines", lambda d: ln.assemble_lines(_lines(d)))


# --- row-local text functions ----------------------------------------------

_on_documents("clean_text", lambda d: d.select(
    "doc_id",
    tx.clean_text("text").alias("clean"),
    tx.clean_text("text", keep_accents=False).alias("bare"),
    tx.clean_text("text", lowercase=False).alias("cased"),
    tx.clean_text("text", emails_first=True).alias("emails_first"),
))
_on_documents("strip_accents", lambda d: d.select("doc_id", tx.strip_accents("text").alias("bare")))
_on_documents("clean_text_light", lambda d: d.select("doc_id", tx.clean_light("text").alias("clean")))
_on_documents("tokenize", lambda d: d.select("doc_id", joined(tx.tokens("text")).alias("words")))
_on_documents("word_count", lambda d: d.select(
    "doc_id", tx.word_count("text").cast("long").alias("n_words")))
_on_documents("split_sentences", lambda d: unroll(
    d.select("doc_id", tx.split_sentences("text").alias("s")), ["doc_id"], "s", "idx", "sentence"))
_on_documents("split_fragments", lambda d: unroll(
    d.select("doc_id", tx.split_fragments(tx.clean_light("text")).alias("s")),
    ["doc_id"], "s", "idx", "fragment"))
_on_documents("content_words", lambda d: d.select(
    "doc_id", joined(tx.content_words(tx.tokens(tx.clean_light("text")))).alias("content")))


@query("encode")
def _encode(spark, sf):
    cleaned = _clean_documents(documents(spark, sf))
    vocab = vb.fit_vocabulary(cleaned, "clean", TEXT_WORDS)
    return encoding.encode(cleaned, "clean", vocab).select("doc_id", joined("ids").alias("ids"))


def _encoded_summaries(spark, sf):
    cleaned = _clean_pairs(pairs(spark, sf))
    vocab = vb.fit_vocabulary(cleaned, SUMMARY, SUMMARY_WORDS)
    return encoding.encode(cleaned, SUMMARY, vocab, markers=True), vocab


@query("encode_with_markers")
def _encode_with_markers(spark, sf):
    return _encoded_summaries(spark, sf)[0].select("doc_id", joined("ids").alias("ids"))


@query("decode")
def _decode(spark, sf):
    ids, vocab = _encoded_summaries(spark, sf)
    plain = encoding.decode(ids, "ids", vocab)
    full = encoding.decode(ids, "ids", vocab, out="with_specials", keep_specials=True)
    return plain.join(full, "doc_id")


def _padded(spark, sf, post: bool):
    ids = _encoded_summaries(spark, sf)[0]
    return ids.select("doc_id", joined(sq.pad("ids", SUMMARY_LENGTH, post)).alias("seq"))


QUERIES["pad_post"] = partial(_padded, post=True)
QUERIES["pad_pre"] = partial(_padded, post=False)


@query("teacher_shift")
def _teacher_shift(spark, sf):
    padded = _encoded_summaries(spark, sf)[0].select("doc_id", sq.pad("ids", SUMMARY_LENGTH).alias("seq"))
    return padded.select(
        "doc_id",
        joined(sq.decoder_input("seq", SUMMARY_LENGTH)).alias("decoder_in"),
        joined(sq.decoder_target("seq", SUMMARY_LENGTH)).alias("decoder_target"),
    )


_on_documents("preview", lambda d: d.select(
    "doc_id", tx.preview("text").alias("preview"),
    tx.preview("text", 100, always=True).alias("list_view")))
_on_pairs("compression_ratio", lambda p: p.select(
    "doc_id", r6(mx.compression_ratio(TEXT, SUMMARY)).alias("ratio"),
    r6(mx.compression_ratio(TEXT, SUMMARY) * 100).alias("percent")))
_on_pairs("rouge1", lambda p: p.select("doc_id", mx.rouge1(SUMMARY, TEXT).alias("r")).select(
    "doc_id", *[r6(f"r.{c}").alias(c) for c in ("precision", "recall", "f1")]))
_on_pairs("comparison_report", lambda p: _counts_as_long(
    evaluation.comparison_report(p, TEXT, SUMMARY), "text_words", "summary_words"
).withColumn("compression", r6("compression")))


def _counts_as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def _triples(p: DataFrame) -> DataFrame:
    """Pairs with the extractive summary of their text."""
    generated = summaries.summarize(p, "extractive", TEXT).withColumnRenamed("summary", "generated")
    return filters.align_pairs(p.select("doc_id", TEXT), p.select("doc_id", SUMMARY), generated)


@query("evaluation_report")
def _evaluation_report(spark, sf):
    p = pairs(spark, sf)
    generated = summaries.summarize(p, "extractive", TEXT).withColumnRenamed("summary", "generated")
    triples = p.join(generated, "doc_id")
    report = evaluation.evaluation_report(triples, TEXT, SUMMARY, "generated")
    return _counts_as_long(
        report, "text_words", "reference_words", "generated_words"
    ).withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


_on_documents("join_fragments", lambda d: d.select(
    "doc_id", tx.split_fragments(tx.clean_light("text")).alias("f")
).select("doc_id", tx.join_fragments("f", F.size("f")).alias("text"), F.size("f").alias("n_fragments")))


# --- filters ----------------------------------------------------------------

_on_documents("min_words_filter", lambda d: filters.min_words_filter(d, "text").select(
    "doc_id", tx.word_count("text").cast("long").alias("n_words")))
QUERIES["valid_pairs"] = lambda spark, sf: filters.valid_pairs(turns(spark, sf))


def _sentence_scores(d: DataFrame) -> DataFrame:
    return tfidf.sentence_tfidf(tfidf.sentence_rows(d), tfidf.fit_idf(tfidf.word_lists(d)))


_on_documents("score_threshold", lambda d: ranking.score_threshold(_sentence_scores(d)).select(
    "doc_id", "idx", r6("score").alias("score")))
_on_pairs("min_rows_check", filters.min_rows_check)


@query("exclude_finished")
def _exclude_finished(spark, sf):
    """Hypotheses of every pair after two steps of the beam."""
    model = decoding.NextTokens.fit(_samples(spark, sf))
    hyps = pairs(spark, sf).select(
        "doc_id", F.lit(1).alias("hyp_id"), F.array(F.lit(START)).alias("seq"),
        F.lit(0.0).alias("score"), F.lit(False).alias("done"))
    for _ in range(2):
        hyps = decoding.beam_step(hyps, model.probs, BEAM)
    return hyps.where(~sq.is_finished("seq")).select("doc_id", "hyp_id", joined("seq").alias("seq"))


# --- joins ------------------------------------------------------------------


def _words_and_vocabulary(spark, sf):
    """Words of the texts, and the vocabulary of the summaries, which lacks many."""
    cleaned = _clean_pairs(pairs(spark, sf))
    vocab = vb.fit_vocabulary(cleaned, SUMMARY, SUMMARY_WORDS)
    return unroll(cleaned, ["doc_id"], tx.tokens(TEXT)), vocab


@query("token_id_lookup")
def _token_id_lookup(spark, sf):
    return encoding.token_id_lookup(*_words_and_vocabulary(spark, sf)).select("doc_id", "pos", "word", "id")


@query("id_token_lookup")
def _id_token_lookup(spark, sf):
    words, vocab = _words_and_vocabulary(spark, sf)
    # Every third id is pushed out of the vocabulary to meet the default.
    ids = encoding.token_id_lookup(words, vocab).select(
        "doc_id", "pos",
        F.when(F.col("pos") % 3 == 2, F.col("id") + SUMMARY_WORDS).otherwise(F.col("id")).alias("id"),
    )
    return encoding.id_token_lookup(ids, vocab).select("doc_id", "pos", "id", "token")


@query("idf_lookup")
def _idf_lookup(spark, sf):
    items = read(spark, sf, "benchmark")
    idf = tfidf.fit_idf(tfidf.word_lists(items, "text", "item_id"))
    words = tfidf.distinct_words(tfidf.word_lists(documents(spark, sf)))
    return tfidf.idf_lookup(words, idf).select("doc_id", "word", r6("idf").alias("idf"))


def _fragments(d: DataFrame) -> DataFrame:
    return importance.fragment_rows(importance.fragment_lists(d))


_on_documents("drop_stopwords", lambda d: importance.drop_stopwords(
    importance.long_word_rows(_fragments(d))))


@query("keep_important")
def _keep_important(spark, sf):
    return importance.keep_important(_fragments(documents(spark, sf)))


@query("holdout_rest")
def _holdout_rest(spark, sf):
    p = pairs(spark, sf)
    sample = splits.split_exact(p).where(F.col("split") == splits.TRAIN)
    return filters.holdout_rest(p, sample)


_on_pairs("align_pairs", _triples)


# --- aggregations -----------------------------------------------------------

_on_documents("word_freq", lambda d: vb.word_freq(_clean_documents(d), "clean").drop("first_batch"))


@query("word_freq_merge")
def _word_freq_merge(spark, sf):
    items = read(spark, sf, "benchmark").select("item_id", tx.clean_text("text").alias("clean"))
    return vb.word_freq_merge(
        vb.word_freq(_clean_documents(documents(spark, sf)), "clean"),
        vb.word_freq(items, "clean", key="item_id", batch=1),
    )


_on_documents("doc_freq", lambda d: tfidf.doc_freq(tfidf.word_lists(d)))
_on_documents("corpus_idf", lambda d: tfidf.corpus_idf(tfidf.word_lists(d)).withColumn("idf", r6("idf")))
_on_documents("fragment_idf", lambda d: importance.fragment_idf(_fragments(d)).withColumn("idf", r6("idf")))
_on_documents("fragment_word_freq", lambda d: importance.fragment_word_freq(_fragments(d)).select(
    "doc_id", "word", "freq",
    F.shiftright("first_place", 32).cast("int").alias("first_idx"),
    F.col("first_place").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("first_pos"),
))


@query("term_freq")
def _term_freq(spark, sf):
    d = documents(spark, sf)
    all_words = tfidf.term_freq(tfidf.sentence_rows(d, colocate=True)).withColumn("kind", F.lit("sentence"))
    content = _fragments(d).withColumn("words", tx.content_words("words"))
    of_content = tfidf.term_freq(content).withColumn("kind", F.lit("fragment"))
    return all_words.unionByName(of_content).withColumn("tf", r6("tf"))


_on_documents("sentence_tfidf", lambda d: _sentence_scores(d).withColumn("score", r6("score")))
_on_documents("fragment_importance", lambda d: importance.fragment_importance(_fragments(d)).withColumn(
    "score", r6("score")))
_on_documents("length_stats", lambda d: statistics.length_stats(d, "text").withColumns(
    {c: r6(c) for c in ("mean", "median", "std")}))
_on_documents("length_histogram", lambda d: statistics.length_histogram(d, "text").withColumns(
    {c: r6(c) for c in ("bin_from", "bin_to")}))
_on_documents("length_boxplot", lambda d: statistics.length_boxplot(d, "text").withColumns(
    {c: r6(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")}))


#: Size of the vocabulary that is fitted with bounded counters.
BOUNDED_WORDS = 1000

#: Rounds of a fit whose result SQL can follow; no early stop, so that their number is fixed.
ROUNDS = 10


def _classifier(spark, sf):
    """Sentences, the folder of a fit by the quality of their documents, and its best model."""
    sentences = tfidf.sentence_rows(documents(spark, sf)).select("doc_id", "idx", "sentence")
    labels = read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    path = scratch_path(spark, "classifier")
    training = classifier.Training(rounds=ROUNDS, patience=ROUNDS, rate_patience=ROUNDS, min_delta=0.0)
    return sentences, path, classifier.train(splits.split_hash(sentences.join(labels, "doc_id")), path, training)


@query("training_history")
def _training_history(spark, sf):
    found = classifier.history(spark, _classifier(spark, sf)[1])
    return found.select("epoch", *[r6(c).alias(c) for c in found.columns if c != "epoch"])


@query("training_report")
def _training_report(spark, sf):
    report = evaluation.training_report(classifier.history(spark, _classifier(spark, sf)[1]))
    return report.select("epochs", *[r6(c).alias(c) for c in report.columns if c != "epochs"])


@query("binary_metrics")
def _binary_metrics(spark, sf):
    """The share of distinct words as a score of text quality."""
    words = tx.tokens("text")
    scored = documents(spark, sf).select(
        "doc_id", mx.ratio(F.size(F.array_distinct(words)), F.size(words)).alias("score")
    ).join(read(spark, sf, "labels"), "doc_id")
    return evaluation.binary_metrics(scored, "quality", "score").withColumns(
        {c: r6(c) for c in ("accuracy", "precision", "recall")}
    )


def _shifted(ids: DataFrame) -> DataFrame:
    """Whole sequences as decoder input and target; a count table needs no fixed length."""
    n = F.size("ids") - 1
    return ids.select(
        "doc_id", F.slice("ids", 1, n).alias("decoder_in"), F.slice("ids", 2, n).alias("decoder_target"))


def _samples(spark, sf):
    return _shifted(_encoded_summaries(spark, sf)[0])


@query("token_accuracy")
def _token_accuracy(spark, sf):
    ids = _encoded_summaries(spark, sf)[0]
    # Padded to the usual length, and longer sequences not cut.
    filler = F.array_repeat(F.lit(PAD), F.greatest(F.lit(SUMMARY_LENGTH) - F.size("ids"), F.lit(0)))
    samples = _shifted(ids.select("doc_id", F.concat("ids", filler).alias("ids")))
    predicted = decoding.NextTokens.fit(samples).predict(samples).join(samples, "doc_id")
    with_pad = evaluation.token_accuracy(predicted, "predicted", "decoder_target")
    without = evaluation.token_accuracy(predicted, "predicted", "decoder_target", ignore_pad=True)
    return with_pad.withColumn("kind", F.lit("all")).unionByName(
        without.withColumn("kind", F.lit("no padding"))
    ).withColumn("accuracy", r6("accuracy"))


_on_documents("distinct_words", lambda d: tfidf.distinct_words(tfidf.word_lists(d)))
_on_pairs("count_rows", lambda p: splits.count_rows(splits.split_exact(p)))


# --- ranking ----------------------------------------------------------------


@query("vocabulary")
def _vocabulary(spark, sf):
    freqs = vb.word_freq(_clean_documents(documents(spark, sf)), "clean")
    return vb.vocabulary(freqs, TEXT_WORDS)


@query("vocabulary_bounded")
def _vocabulary_bounded(spark, sf):
    """A smaller vocabulary, whose words bounded counters can tell from the rest."""
    return heavy.fit_vocabulary_bounded(_clean_documents(documents(spark, sf)), "clean", BOUNDED_WORDS).table


_on_documents("top_words", lambda d: vb.top_words(vb.word_freq(_clean_documents(d), "clean")).select(
    "word", "freq"))
_on_documents("important_words", lambda d: importance.important_words(
    importance.fragment_word_freq(_fragments(d))))
_on_documents("tfidf_top_n", lambda d: tfidf.tfidf_top_n(_sentence_scores(d)).withColumn(
    "score", r6("score")))
_on_documents("threshold_top_n", lambda d: ranking.threshold_top_n(_sentence_scores(d)).withColumn(
    "score", r6("score")))
_on_documents("adaptive_k", lambda d: d.select(
    "doc_id", F.size(tx.split_fragments(tx.clean_light("text"))).alias("n_fragments")
).withColumn("k", ranking.adaptive_k(F.col("n_fragments"))))
_on_documents("rank_then_restore", lambda d: ranking.rank_then_restore(
    importance.fragment_importance(_fragments(d))).select("doc_id", joined("kept").alias("kept")))
_on_pairs("last_rows", filters.last_rows)
_on_documents("extractive_summary", summaries.extractive_summary)


# --- set operations and sampling --------------------------------------------


@query("union_pairs")
def _union_pairs(spark, sf):
    items = read(spark, sf, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.col("text").alias(TEXT),
        F.col("text").alias(SUMMARY),
    )
    return pr.union_pairs(pairs(spark, sf), items, items)


_on_documents("split_exact", lambda d: splits.split_exact(d.select("doc_id")))
_on_documents("split_hash", lambda d: splits.split_hash(d.select("doc_id")))
_on_pairs("split_fallback", lambda p: splits.split_fallback(p, None))
_on_pairs("set_overlap", lambda p: p.select("doc_id", mx.set_overlap(TEXT, SUMMARY).alias("s")).select(
    "doc_id", joined(F.sort_array("s")).alias("shared"), F.size("s").cast("long").alias("n")))


# --- pipelines --------------------------------------------------------------


@query("prepare_seq2seq")
def _prepare_seq2seq(spark, sf):
    # The pairs are a join that several jobs read.
    p = splits.split_exact(cut_lineage(pairs(spark, sf)))
    out = training_data.prepare_seq2seq(p, *training_data.fit_two_vocabularies(p))
    return out.select("doc_id", *[joined(c).alias(c) for c in out.columns if c != "doc_id"])


@query("fit_two_vocabularies")
def _fit_two_vocabularies(spark, sf):
    both = training_data.fit_two_vocabularies(splits.split_exact(cut_lineage(pairs(spark, sf))))
    return both[0].table.withColumn("side", F.lit(TEXT)).unionByName(
        both[1].table.withColumn("side", F.lit(SUMMARY))
    )


@query("encode_for_inference")
def _encode_for_inference(spark, sf):
    d = documents(spark, sf)
    vocab = vb.fit_vocabulary(_clean_documents(d), "clean", TEXT_WORDS)
    return training_data.encode_for_inference(d, "text", vocab).select(
        "doc_id", joined("encoder_in").alias("encoder_in"))


def _decoder(spark, sf):
    cleaned = _clean_pairs(pairs(spark, sf))
    vocab = vb.fit_vocabulary(cleaned, SUMMARY, SUMMARY_WORDS)
    ids = encoding.encode(cleaned, SUMMARY, vocab, markers=True)
    return summaries.Decoder(vocab, decoding.NextTokens.fit(_shifted(ids)))


@query("summarize_batch")
def _summarize_batch(spark, sf):
    d, p, decoder = documents(spark, sf), pairs(spark, sf), _decoder(spark, sf)
    parts = [
        summaries.summarize(d, "extractive"),
        summaries.summarize(d, "tfidf"),
        summaries.summarize(p, "greedy", TEXT, decoder=decoder, max_steps=STEPS),
        summaries.summarize(p, "beam_search", TEXT, decoder=decoder, max_steps=STEPS, beam_width=BEAM),
    ]
    named = [
        part.select(F.lit(name).alias("strategy"), "doc_id", "summary")
        for name, part in zip(summaries.STRATEGIES, parts)
    ]
    return pr.union_pairs(*named)


@query("summarize_and_log")
def _summarize_and_log(spark, sf):
    path = scratch_path(spark, "log")
    summaries.summarize_and_log(documents(spark, sf), path)
    logged = spark.read.parquet(path)
    return logged.select(
        "doc_id", SUMMARY, "source",
        tx.word_count(TEXT).cast("long").alias("text_words"),
        tx.word_count(SUMMARY).cast("long").alias("summary_words"),
        r6(mx.compression_ratio(TEXT, SUMMARY) * 100).alias("percent"),
    )


# --- model side -------------------------------------------------------------


def _salience_scores(spark, sf):
    sentences = tfidf.sentence_rows(documents(spark, sf)).select("doc_id", "idx", "sentence")
    labels = read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    path = scratch_path(spark, "salience")
    salience.fit_salience(sentences.join(labels, "doc_id")).save(path)
    return salience.score_salience(salience.Salience.load(spark, path), sentences)


@query("salience_fit_score")
def _salience_fit_score(spark, sf):
    return _salience_scores(spark, sf).withColumn("score", r6("score"))


@query("salience_top_n")
def _salience_top_n(spark, sf):
    """Extraction by the classifier's score."""
    return ranking.threshold_top_n(_salience_scores(spark, sf)).withColumn("score", r6("score"))


@query("classifier_fit_score")
def _classifier_fit_score(spark, sf):
    sentences, path, _ = _classifier(spark, sf)
    return classifier.Classifier.load(spark, path).score(sentences).withColumn("score", r6("score"))


@query("classifier_top_n")
def _classifier_top_n(spark, sf):
    """Extraction by the trained classifier; scores are compared by six digits."""
    sentences, _, model = _classifier(spark, sf)
    return ranking.threshold_top_n(model.score(sentences).withColumn("score", r6("score")))


@query("next_token_table")
def _next_token_table(spark, sf):
    return decoding.next_token_table(_samples(spark, sf)).withColumn("p", r6("p"))


#: Rounds of the alignment, and the least probability of a pair of words in its result.
ALIGN_ROUNDS, LEAST_P = 4, 0.1


def _alignment(spark, sf):
    words = _clean_pairs(pairs(spark, sf)).select(
        "doc_id", tx.tokens(TEXT).alias("words"), tx.tokens(SUMMARY).alias("summary_words"))
    return words, alignment.Alignment.fit(words, "words", "summary_words", ALIGN_ROUNDS)


@query("word_alignment")
def _word_alignment(spark, sf):
    """Pairs of words that are aligned with some confidence, as in a dictionary."""
    return _alignment(spark, sf)[1].table.withColumn("p", r6("p")).where(F.col("p") >= LEAST_P)


@query("alignment_history")
def _alignment_history(spark, sf):
    return _alignment(spark, sf)[1].history.withColumn("log_likelihood", F.round("log_likelihood", 3))


@query("likely_summary_words")
def _likely_summary_words(spark, sf):
    words, model = _alignment(spark, sf)
    return model.likely_words(words, "words").withColumn("p", r6("p"))


@query("backoff_table")
def _backoff_table(spark, sf):
    return backoff.Backoff.fit(_encoded_summaries(spark, sf)[0]).table().withColumn("p", r6("p"))


@query("backoff_likelihood")
def _backoff_likelihood(spark, sf):
    """Summaries of the validation part under a model of the training part."""
    parts = splits.split_hash(_encoded_summaries(spark, sf)[0])
    model = backoff.Backoff.fit(parts.where(F.col("split") == splits.TRAIN))
    return model.likelihood(parts.where(F.col("split") == splits.VALIDATION)).withColumn("log_p", F.round("log_p", 4))


def _encoded_texts(spark, sf):
    """The decoder, and the whole texts of the pairs in its vocabulary."""
    decoder = _decoder(spark, sf)
    cleaned = _clean_pairs(pairs(spark, sf))
    return decoder.model, encoding.encode(cleaned, TEXT, decoder.vocab)


def _decoded(found: DataFrame) -> DataFrame:
    return found.select("doc_id", joined("seq").alias("seq"), r6("score").alias("score"))


@query("greedy_decode")
def _greedy_decode(spark, sf):
    model, texts = _encoded_texts(spark, sf)
    return _decoded(model.greedy(texts, STEPS))


@query("beam_search")
def _beam_search(spark, sf):
    model, texts = _encoded_texts(spark, sf)
    return _decoded(model.beam_search(texts, BEAM, STEPS))
