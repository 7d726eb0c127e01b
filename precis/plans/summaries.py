"""Summaries of whole tables of texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.metrics import compression_ratio
from precis.functions.text import clean_text, join_fragments, word_count
from precis.operators.decoding import NextTokens
from precis.operators.encoding import decode, encode
from precis.operators.filters import min_words_filter
from precis.operators.importance import fragment_importance, fragment_lists, fragment_rows
from precis.operators.ranking import rank_then_restore
from precis.operators.rows import n_tasks
from precis.operators.tfidf import (
    fit_idf,
    listed_sentences,
    sentence_lists,
    sentence_tfidf,
    tfidf_top_n,
    word_lists,
)
from precis.operators.vocabulary import Vocabulary
from precis.settings import DEFAULTS, SUMMARY, TEXT
from precis.sources.pairs import append_pairs

STRATEGIES = ("extractive", "tfidf", "greedy", "beam_search")


def extractive_summary(
    texts: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    colocated: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, summary, n_fragments, n_kept)`` of every text, and the columns of ``carry``.

    One shuffle in all: fragments travel by ``doc_id`` once, and both the
    scoring and the final assembly read that same exchange. Carried columns
    travel with the fragments, in an exchange of their own beside that of the scoring.
    """
    lists = fragment_lists(texts, text, key, colocated, carry)
    kept = rank_then_restore(fragment_importance(fragment_rows(lists)))
    joined = lists.join(kept, "doc_id", "left")
    n = F.size("fragments")
    fragments, positions = F.col("fragments"), F.col("kept")
    chosen = F.when(n <= 2, fragments).otherwise(
        F.transform(positions, lambda i: F.get(fragments, i))
    )
    return joined.select("doc_id", n.alias("n_fragments"), chosen.alias("chosen"), *carry).select(
        "doc_id",
        join_fragments("chosen", "n_fragments").alias("summary"),
        "n_fragments",
        F.size("chosen").alias("n_kept"),
        *carry,
    )


def tfidf_summary(
    texts: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    n: int = DEFAULTS.sentences_to_extract,
) -> DataFrame:
    """``(doc_id, summary)`` of the best sentences by corpus TF-IDF, best first.

    Sentences travel by ``doc_id`` once, and both the scoring and the final assembly read that
    same exchange. Texts without a key have no scores; they stand aside, as the join would
    leave them out of one branch only.
    """
    tasks = n_tasks(texts, text)
    lists = sentence_lists(texts.where(F.col(key).isNotNull()), text, key).repartition(tasks, "doc_id")
    best = tfidf_top_n(sentence_tfidf(listed_sentences(lists), fit_idf(word_lists(texts, text, key))), n)
    kept = best.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "idx"))).alias("kept")
    )
    joined = lists.join(kept.repartition(tasks, "doc_id"), "doc_id", "left")
    chosen = F.coalesce(
        F.transform(F.col("kept").getField("idx"), lambda i: F.get(F.col("sentences"), i)),
        F.array().cast("array<string>"),
    )
    found = joined.select("doc_id", chosen.alias("chosen")).select(
        "doc_id", join_fragments("chosen", F.size("chosen")).alias("summary")
    )
    unkeyed = texts.where(F.col(key).isNull()).select(F.col(key).alias("doc_id"), F.lit("").alias("summary"))
    return found.unionAll(unkeyed)


@dataclass(frozen=True)
class Decoder:
    """What the decoding strategies need: a vocabulary and its next-token table."""

    vocab: Vocabulary
    model: NextTokens


def summarize(
    texts: DataFrame,
    strategy: str = "extractive",
    text: str = "text",
    key: str = "doc_id",
    decoder: Decoder | None = None,
    max_steps: int = DEFAULTS.max_summary_length,
    beam_width: int = DEFAULTS.beam_width,
) -> DataFrame:
    """One ``(doc_id, summary)`` row per text, by the named strategy."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "extractive":
        return extractive_summary(texts, text, key).select("doc_id", "summary")
    if strategy == "tfidf":
        return tfidf_summary(texts, text, key)
    if decoder is None:
        raise ValueError(f"strategy {strategy} needs a decoder")
    cleaned = texts.select(F.col(key).alias("doc_id"), clean_text(text).alias("clean"))
    ids = encode(cleaned, "clean", decoder.vocab)
    if strategy == "greedy":
        found = decoder.model.greedy(ids, max_steps)
    else:
        found = decoder.model.beam_search(ids, beam_width, max_steps)
    return decode(found, "seq", decoder.vocab, out="summary")


def summary_log(texts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Texts of enough words with summary, both word counts and percent."""
    named = texts.select(F.col(key).alias("doc_id"), F.col(text).alias(TEXT))
    found = extractive_summary(min_words_filter(named, TEXT), TEXT, carry=(TEXT,))
    return found.select(
        "doc_id", TEXT, F.col("summary").alias(SUMMARY),
        word_count(TEXT).alias("text_words"),
        word_count("summary").alias("summary_words"),
        (compression_ratio(TEXT, "summary") * 100).alias("percent"),
    )


def summarize_and_log(
    texts: DataFrame, path: str, text: str = "text", key: str = "doc_id", token: str | None = None
) -> int:
    """Summarise and append the new pairs to the pair table; the new total. A repeated ``token`` adds nothing."""
    new = summary_log(texts, text, key).select("doc_id", TEXT, SUMMARY)
    return append_pairs(new, path, source="summary", token=token)
