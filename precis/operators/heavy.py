"""Vocabularies of large corpora without a shuffle of all their words.

A first pass gives each task a bounded number of counters. When they run out, all are lowered
by the same amount and the empty ones go, so a counter is at most the sum of those amounts too
low. Added up, the counters of all tasks bound each word's count from both sides. If the bounds
show which words can be in the vocabulary, a second pass counts those alone, exactly; the long
tail of rare words is never shuffled. Else all words are counted as ``word_freq`` does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.text import tokens
from precis.operators.lookup import Sized
from precis.operators.vocabulary import Vocabulary, count_places, vocabulary, word_freq, word_places
from precis.settings import DEFAULTS, SPECIAL_TOKENS, Settings

#: Counters: word, its count less an error, and in the row without a word the task's error.
COUNTERS = "word string, low long, error long"
#: Words that a task takes up between two prunings.
STEP = 1 << 20


class Counters:
    """At most ``most`` counters after each pruning; true counts lie between low and low + error."""

    def __init__(self, most: int):
        self.most, self.error = most, 0
        self.words, self.low = pa.array([], pa.string()), np.zeros(0, np.int64)

    def add(self, words: pa.Array) -> None:
        found = pc.value_counts(words)
        names = pa.concat_arrays([self.words, found.field("values").cast(pa.string())])
        counts = np.concatenate([self.low, found.field("counts").to_numpy(zero_copy_only=False)])
        table = pa.table({"w": names, "n": counts}).group_by("w").aggregate([("n", "sum")])
        self.words, self.low = table.column("w").combine_chunks(), table.column("n_sum").to_numpy()
        if len(self.low) > self.most:
            # The greatest of those that go is taken off all.
            off = int(np.partition(self.low, len(self.low) - self.most - 1)[len(self.low) - self.most - 1])
            self.error += off
            stay = self.low > off
            self.words, self.low = self.words.filter(pa.array(stay)), self.low[stay] - off


def task_counters(texts: DataFrame, text: str, most: int) -> DataFrame:
    """The counters of each task, and a row without a word with its error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, waiting, n = Counters(most), [], 0
        for batch in batches:
            # Long texts are taken up in parts, so that what waits is bounded.
            flat = batch.column(0).flatten()
            for at in range(0, len(flat), STEP):
                waiting.append(flat.slice(at, STEP))
                n += len(waiting[-1])
                if n >= STEP:
                    counters.add(pa.concat_arrays(waiting))
                    waiting, n = [], 0
        if waiting:
            counters.add(pa.concat_arrays(waiting))
        size = len(counters.low)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([counters.words, pa.nulls(1, pa.string())]), pa.array(np.append(counters.low, 0)),
             pa.array(np.append(np.zeros(size, np.int64), counters.error))], names=["word", "low", "error"])

    return texts.select(tokens(text).alias("words")).mapInArrow(run, COUNTERS)


@dataclass(frozen=True)
class Candidates:
    """Words that can be among the most frequent; None if the bounds do not tell."""

    words: Sized | None
    error: int
    least: int


def candidates(texts: DataFrame, text: str, capacity: int, most: int) -> Candidates:
    """The words whose upper bound reaches the lower bound of the ``capacity``-th word.

    A word without a counter was seen ``error`` times at most. So if that is less than the
    bound, no word is missed; if no counter was ever lowered, none is missed either.
    """
    merged = Sized.store(task_counters(texts, text, most).groupBy("word").agg(
        F.sum("low").alias("low"), F.sum("error").alias("error")), "word").table
    error = merged.where("word is null").agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    best = merged.where("word is not null").select("word", "low").orderBy(F.desc("low")).limit(capacity)
    row = best.agg(F.count("*").alias("n"), F.min("low").alias("least")).first()
    least = row.least if row.n == capacity and capacity else 0
    if error >= least and error:
        return Candidates(None, error, least)
    return Candidates(Sized.store(merged.where(F.col("word").isNotNull() & (F.col("low") + error >= least)).select("word"), "word"),
                      error, least)


def fit_vocabulary_bounded(
    texts: DataFrame, text: str, capacity: int, key: str = "doc_id", specials: tuple[str, ...] = SPECIAL_TOKENS,
    counters: int | None = None, settings: Settings = DEFAULTS,
) -> Vocabulary:
    """The same as ``fit_vocabulary``; each task holds ``counters`` words (four for each of the vocabulary).

    The special tokens count as words until the vocabulary leaves them out, so as many more
    words are asked for. Where the words that can be in the vocabulary are too many to send,
    or the bounds do not separate them, all words are counted.
    """
    most = 4 * capacity if counters is None else counters
    found = candidates(texts, text, capacity + len(specials), most)
    if found.words is None or not found.words.is_small(settings):
        freqs = word_freq(texts, text, key)
    else:
        freqs = survivors_freq(texts, text, found.words, key)
    return Vocabulary(Sized.store(vocabulary(freqs, capacity, specials), "token"))


def survivors_freq(texts: DataFrame, text: str, words: Sized, key: str = "doc_id") -> DataFrame:
    """``word_freq`` of the given words alone, filtered before anything is shuffled."""
    return count_places(word_places(texts, text, key).join(F.broadcast(words.table), "word", "left_semi"))
