"""A trainable sentence classifier that yields a score column.

Words are counted in sentences that belong in a summary and in others; a sentence's
score is the logistic of the summed log ratios of its words (naive Bayes). The fit is
one grouped count, so it is repeatable and all words of all sentences take part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions.text import tokens
from precis.operators.lookup import Sized, lookup_sums
from precis.operators.rows import unroll
from precis.settings import DEFAULTS, Settings


@dataclass(frozen=True)
class Salience:
    """``(word, weight, n)`` of every word seen, and the log ratio of the sentences."""

    words: Sized
    prior: float

    def save(self, path: str) -> None:
        """One parquet table; the row without a word is the prior."""
        prior = self.words.table.sparkSession.createDataFrame(
            [(None, self.prior, 0)], "word string, weight double, n long")
        self.words.table.unionByName(prior).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Salience":
        table = spark.read.parquet(path)
        prior = table.where("word is null").first().weight
        return Salience(Sized.measure(table.where("word is not null"), "word"), prior)


def fit_salience(labelled: DataFrame) -> Salience:
    """Fit on ``(sentence, label)`` with labels 1 and 0; other labels take no part.

    A word's weight is the log ratio of its shares among the words of both
    kinds, with one added to each count; the prior that of the sentences.
    """
    is_in, is_out = F.col("label") == 1, F.col("label") == 0
    known = labelled.where(is_in | is_out)
    words = unroll(known.select("label", tokens("sentence").alias("words")), ["label"], "words")
    counts = words.groupBy("word").agg(F.count_if(is_in).alias("a"), F.count_if(is_out).alias("b"))
    stored = Sized.store(counts, "word").table
    totals = stored.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"),
        F.count("*").alias("v"),
    ).first()
    sentences = known.agg(F.count_if(is_in).alias("a"), F.count_if(is_out).alias("b"))
    prior = sentences.select(F.log((F.col("a") + 1) / (F.col("b") + 1))).first()[0]
    share = lambda c, total: (F.col(c) + 1) / F.lit(total + totals.v)
    weight = F.log(share("a", totals.a)) - F.log(share("b", totals.b))
    weighed = stored.select("word", weight.alias("weight"), (F.col("a") + F.col("b")).alias("n"))
    return Salience(Sized.measure(weighed, "word"), prior)


def score_salience(
    model: Salience, sentences: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """``(doc_id, idx, score)``: the probability that a sentence belongs in a summary.

    Words that were not seen in training do not count.
    """
    split = sentences.select("doc_id", "idx", tokens("sentence").alias("words"))
    rows = unroll(split, ["doc_id", "idx"], "words", keep_empty=True)
    sums = lookup_sums(rows, model.words, F.col("n"), "weight", ["doc_id", "idx"], settings=settings)
    total = F.lit(model.prior) + F.col("total")
    return sums.select("doc_id", "idx", (1 / (1 + F.exp(-total))).alias("score"))
