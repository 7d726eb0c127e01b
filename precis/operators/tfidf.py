"""Corpus TF-IDF: document frequency, IDF, sentence scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.text import clean_text, split_sentences, tokens
from precis.operators.lookup import Sized, lookup, lookup_sums
from precis.operators.ranking import top_n
from precis.operators.rows import doc_key, n_tasks, unroll
from precis.settings import DEFAULTS, Settings


def word_lists(texts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, words)`` of cleaned texts."""
    return texts.select(F.col(key).alias("doc_id"), tokens(clean_text(text)).alias("words"))


def sentence_lists(texts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, sentences)`` of cleaned texts."""
    return texts.select(
        doc_key(key), split_sentences(clean_text(text)).alias("sentences")
    )


def sentence_rows(
    texts: DataFrame, text: str = "text", key: str = "doc_id", colocate: bool = False
) -> DataFrame:
    """``(doc_id, idx, sentence, words)`` of cleaned texts.

    With ``colocate`` the sentences travel by ``doc_id`` while they are still
    one compact row per text, so that counting their words needs no shuffle.
    """
    lists = sentence_lists(texts, text, key)
    if colocate:
        lists = lists.repartition(n_tasks(texts, text), "doc_id")
    return listed_sentences(lists)


def listed_sentences(lists: DataFrame) -> DataFrame:
    """The rows of ``sentence_rows`` out of ``(doc_id, sentences)``."""
    parts = unroll(lists, ["doc_id"], "sentences", "idx", "sentence")
    return parts.withColumn("words", tokens("sentence"))


def distinct_words(lists: DataFrame) -> DataFrame:
    """Each word of a document once; made inside the row, without a shuffle."""
    return unroll(lists, ["doc_id"], F.array_distinct("words")).drop("pos")


def doc_freq(lists: DataFrame) -> DataFrame:
    """Number of documents that hold a word."""
    return distinct_words(lists).groupBy("word").agg(F.count("*").alias("df"))


def corpus_idf(lists: DataFrame) -> DataFrame:
    """``ln(N / (1 + df))``; N counts all documents, also empty ones."""
    total = lists.agg(F.count("*")).scalar()
    return doc_freq(lists).withColumn(
        "idf", F.log(total.cast("double") / (1 + F.col("df")))
    )


def _word_rows(sentences: DataFrame, keep_empty: bool = False) -> DataFrame:
    sized = sentences.select("doc_id", "idx", F.size("words").alias("n"), "words")
    return unroll(sized, ["doc_id", "idx", "n"], "words", keep_empty=keep_empty)


def term_freq(sentences: DataFrame) -> DataFrame:
    """Share of each word among the words of its sentence."""
    rows = _word_rows(sentences)
    return (
        rows.groupBy("doc_id", "idx", "n", "word")
        .agg(F.count("*").alias("c"))
        .select("doc_id", "idx", "word", "c", (F.col("c").cast("double") / F.col("n")).alias("tf"))
    )


def fit_idf(lists: DataFrame) -> Sized:
    """Corpus IDF, computed once, stored and measured."""
    return Sized.store(corpus_idf(lists), "word")


def idf_lookup(rows: DataFrame, idf: Sized, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``idf`` to rows that have a ``word``; 0.0 for unseen words."""
    found = lookup(rows, idf, F.col("df"), settings)
    return found.drop("df").withColumn("idf", F.coalesce("idf", F.lit(0.0)))


def sentence_tfidf(
    sentences: DataFrame, idf: Sized, settings: Settings = DEFAULTS
) -> DataFrame:
    """Sum of tf times idf per sentence; 0.0 for a sentence without words.

    Summing the idf of every word and dividing by the length once is the same
    sum, so words need not be counted per sentence first.
    """
    rows = _word_rows(sentences, keep_empty=True)
    return (
        lookup_sums(rows, idf, F.col("df"), "idf", ["doc_id", "idx"], "n", settings)
        .select(
            "doc_id", "idx",
            F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(0.0).alias("score"),
        )
    )


def tfidf_top_n(scores: DataFrame, n: int = DEFAULTS.sentences_to_extract) -> DataFrame:
    """The best sentences of each document, best first, with their rank."""
    return top_n(scores, n)
