"""Texts to token ids and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.sequences import add_markers
from precis.functions.text import tokens
from precis.operators.lookup import lookup
from precis.operators.rows import unroll
from precis.operators.vocabulary import Vocabulary
from precis.settings import DEFAULTS, END, PAD, START, UNK, Settings


def token_id_lookup(
    rows: DataFrame, vocab: Vocabulary, settings: Settings = DEFAULTS
) -> DataFrame:
    """Add ``id`` to rows that have a ``word``; unknown words get UNK."""
    found = lookup(rows.withColumnRenamed("word", "token"), vocab.tokens, F.col("freq"), settings)
    return (
        found.withColumn("id", F.coalesce("id", F.lit(UNK)))
        .withColumnRenamed("token", "word")
        .drop("freq")
    )


def id_token_lookup(
    rows: DataFrame, vocab: Vocabulary, settings: Settings = DEFAULTS
) -> DataFrame:
    """Add ``token`` to rows that have an ``id``; unknown ids get ``<UNK>``."""
    # The specials have no count, yet padding and unknown words are the most frequent ids.
    weight = F.when(F.col("id") < len(settings.special_tokens), F.lit(2**62)).otherwise(F.col("freq"))
    found = lookup(rows, vocab.by_id(), weight, settings)
    return found.withColumn("token", F.coalesce("token", F.lit(settings.special_tokens[UNK]))).drop("freq")


def encode(
    texts: DataFrame,
    text: str,
    vocab: Vocabulary,
    out: str = "ids",
    key: str = "doc_id",
    markers: bool = False,
    keep: int | None = None,
    tasks: int | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Words to ids in order, as ``(key, out)``; no words give ``[]``.

    Texts are shuffled once, whole and by key. Exploding, looking up by
    broadcast and collecting again then need no further exchange. ``keep``
    leaves out words that a later cut to that length would drop anyway, before
    texts are shuffled. ``tasks`` is the number of tasks of the shuffle.
    """
    by = (tasks, key) if tasks else (key,)
    if keep is None:
        laid_out, words = texts.select(key, text).repartition(*by), tokens(text)
    else:
        laid_out, words = texts.select(key, F.slice(tokens(text), 1, keep).alias("_kept")).repartition(*by), "_kept"
    rows = unroll(laid_out, [key], words, keep_empty=True)
    ids = (
        token_id_lookup(rows, vocab, settings)
        .groupBy(key)
        .agg(
            F.sort_array(
                F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id")))
            ).alias("found")
        )
        .select(key, F.col("found").getField("id").alias(out))
    )
    return ids.withColumn(out, add_markers(out)) if markers else ids


def decode(
    sequences: DataFrame,
    seq: str,
    vocab: Vocabulary,
    out: str = "text",
    key: str = "doc_id",
    keep_specials: bool = False,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Ids to a text, as ``(key, out)``; PAD, START and END go, UNK stays."""
    laid_out = sequences.select(key, seq).repartition(key)
    rows = unroll(laid_out, [key], seq, item="id", keep_empty=True)
    shown = F.col("pos").isNotNull()
    if not keep_specials:
        shown = shown & ~F.col("id").isin(PAD, START, END)
    return (
        id_token_lookup(rows, vocab, settings)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.when(shown, F.struct("pos", "token")))).alias("found"))
        .select(key, F.array_join(F.col("found").getField("token"), " ").alias(out))
    )
