"""Training tables for a sequence-to-sequence model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.sequences import add_markers, decoder_input, decoder_target, pad
from precis.functions.text import clean_text, tokens
from precis.operators.encoding import encode
from precis.operators.lookup import Sized, lookup
from precis.operators.rows import n_tasks, unroll
from precis.operators.splits import TRAIN
from precis.operators.vocabulary import Vocabulary, vocabulary, word_freq
from precis.settings import DEFAULTS, SUMMARY, TEXT, UNK, Settings
from precis.sources.storage import cut_lineage


def fit_two_vocabularies(
    pairs: DataFrame, settings: Settings = DEFAULTS
) -> tuple[Vocabulary, Vocabulary]:
    """Text and summary vocabulary, from the training rows only."""
    train = pairs.where(F.col("split") == TRAIN) if "split" in pairs.columns else pairs
    # Both sides are counted in one pass over the pairs, and the counts stored once.
    sides = train.select("doc_id", F.inline(F.array(
        F.struct(F.lit(0).alias("side"), clean_text(TEXT).alias("clean")),
        F.struct(F.lit(1).alias("side"), clean_text(SUMMARY).alias("clean")),
    )))
    counts = cut_lineage(word_freq(sides, "clean", by=("side",)))
    text, summary = (
        Vocabulary(Sized.store(vocabulary(
            counts.where(F.col("side") == side).drop("side"), capacity, settings.special_tokens), "token"))
        for side, capacity in ((0, settings.text_vocabulary), (1, settings.summary_vocabulary))
    )
    return text, summary


def prepare_seq2seq(
    pairs: DataFrame,
    text_vocab: Vocabulary,
    summary_vocab: Vocabulary,
    max_text: int = DEFAULTS.max_text_length,
    max_summary: int = DEFAULTS.max_summary_length,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """``(doc_id, encoder_in, decoder_in, decoder_target)`` of every pair.

    Both texts of a pair travel in one shuffle by ``doc_id`` and share one
    lookup; words beyond the padded length are dropped before they are looked
    up, since padding would cut them.
    """
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.slice(tokens(clean_text(TEXT)), 1, max_text).alias("words")),
        F.struct(F.lit(1).alias("side"), F.slice(tokens(clean_text(SUMMARY)), 1, max_summary).alias("words")),
    )
    rows = (
        pairs.select("doc_id", TEXT, SUMMARY)
        .repartition("doc_id")
        .select("doc_id", F.inline_outer(sides))
        .transform(unroll, ["doc_id", "side"], "words", keep_empty=True)
        .withColumn("entry", F.concat(F.col("side").cast("string"), F.col("word")))
    )
    found = lookup(rows, _entries(text_vocab, summary_vocab), F.col("freq"), settings)
    of_side = lambda s: F.sort_array(
        F.collect_list(
            F.when(
                F.col("pos").isNotNull() & (F.col("side") == s),
                F.struct("pos", F.coalesce("id", F.lit(UNK)).alias("id")),
            )
        )
    ).getField("id")
    ids = found.groupBy("doc_id").agg(of_side(0).alias("text_ids"), of_side(1).alias("summary_ids"))
    padded = ids.select(
        "doc_id",
        pad("text_ids", max_text).alias("encoder_in"),
        pad(add_markers("summary_ids"), max_summary).alias("summary"),
    )
    return padded.select(
        "doc_id", "encoder_in",
        decoder_input("summary", max_summary).alias("decoder_in"),
        decoder_target("summary", max_summary).alias("decoder_target"),
    )


def _entries(*vocabs: Vocabulary) -> Sized:
    """Several vocabularies as one lookup table, words marked by their side."""
    parts = [
        v.table.select(F.concat(F.lit(str(side)), F.col("token")).alias("entry"), "id", "freq")
        for side, v in enumerate(vocabs)
    ]
    return Sized(
        reduce(DataFrame.unionByName, parts), "entry",
        sum(v.tokens.n_rows for v in vocabs),
        sum(v.tokens.n_bytes + v.tokens.n_rows for v in vocabs),
    )


def encode_for_inference(
    texts: DataFrame,
    text: str,
    vocab: Vocabulary,
    length: int = DEFAULTS.max_text_length,
    key: str = "doc_id",
) -> DataFrame:
    """``(key, encoder_in)``: cleaned, encoded and padded texts."""
    cleaned = texts.select(key, clean_text(text).alias("clean"))
    ids = encode(cleaned, "clean", vocab, key=key, keep=length, tasks=n_tasks(texts, text))
    return ids.select(key, pad("ids", length).alias("encoder_in"))
