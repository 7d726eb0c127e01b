"""Word counts and capped vocabularies."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precis.functions.text import tokens
from precis.operators.lookup import Sized
from precis.operators.rows import unroll
from precis.settings import DEFAULTS, SPECIAL_TOKENS

FIRST = ("first_batch", "first_doc", "first_rank")


def word_freq(
    texts: DataFrame,
    text: str,
    key: str = "doc_id",
    batch: int = 0,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Corpus word counts with the place of first occurrence, apart for each ``by``.

    The place is ``(first_batch, first_doc, first_rank)``, the rank being that
    among the distinct words of the document. Distinct words are put before
    all words in one array: the former carry the place, the latter the count.
    So every aggregate is a primitive with map-side combine, and frequent
    words shrink to one row per task before the shuffle.
    """
    return count_places(word_places(texts, text, key, by), batch, by)


def word_places(texts: DataFrame, text: str, key: str = "doc_id", by: tuple[str, ...] = ()) -> DataFrame:
    """A row for each distinct word of a text (``at`` below ``n``), and after those for each word."""
    words = texts.select(*by, F.col(key).alias("doc"), tokens(text).alias("words"))
    both = words.select(*by, "doc", "words", F.array_distinct("words").alias("distinct")).select(
        *by, "doc", F.size("distinct").alias("n"), F.concat("distinct", "words").alias("both")
    )
    return unroll(both, [*by, "doc", "n"], "both", pos="at")


def count_places(rows: DataFrame, batch: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    """The counts of ``word_freq`` out of rows of ``word_places``."""
    place = F.col("at") < F.col("n")
    doc = F.when(place, F.col("doc"))
    return rows.groupBy(*by, "word").agg(
        F.count_if(~place).alias("freq"),
        F.lit(batch).alias("first_batch"),
        F.min(doc).alias("first_doc"),
        F.min_by(F.col("at"), doc).alias("first_rank"),
    )


def word_freq_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add the counts of further texts; first occurrence is that of the older."""
    return (
        old.unionByName(new)
        .groupBy("word")
        .agg(F.sum("freq").alias("freq"), F.min(F.struct(*FIRST)).alias("first"))
        .select("word", "freq", *[F.col(f"first.{c}").alias(c) for c in FIRST])
    )


def _by_rank():
    return [F.desc("freq"), *[F.asc(c) for c in FIRST]]


def top_words(freqs: DataFrame, n: int = DEFAULTS.top_words) -> DataFrame:
    return freqs.orderBy(*_by_rank()).limit(n)


def vocabulary(
    freqs: DataFrame, capacity: int, specials: tuple[str, ...] = SPECIAL_TOKENS
) -> DataFrame:
    """The most frequent words as ``(token, id, freq)``, four specials first.

    Ties go to the word that occurs first. A word spelled like a special token
    never takes a second id.
    """
    n_special = len(specials)
    if capacity < n_special:
        raise ValueError(f"a vocabulary needs room for {n_special} special tokens")
    words = (
        freqs.where(~F.col("word").isin(*specials))
        .orderBy(*_by_rank())
        .limit(capacity - n_special)
        # One task, over no more rows than the vocabulary has.
        .withColumn("id", F.row_number().over(Window.orderBy(*_by_rank())) + n_special - 1)
        .select(F.col("word").alias("token"), "id", "freq")
    )
    first = freqs.sparkSession.createDataFrame(
        [(token, i, 0) for i, token in enumerate(specials)],
        "token string, id int, freq long",
    )
    return first.unionByName(words)


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary ``(token, id, freq)``: stored, and of measured size."""

    tokens: Sized

    @property
    def table(self) -> DataFrame:
        return self.tokens.table

    def by_id(self) -> Sized:
        """The same rows looked up by id."""
        return replace(self.tokens, key="id")

    def save(self, path: str) -> None:
        self.table.write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Vocabulary":
        return Vocabulary(Sized.measure(spark.read.parquet(path), "token"))


def fit_vocabulary(
    texts: DataFrame,
    text: str,
    capacity: int,
    key: str = "doc_id",
    specials: tuple[str, ...] = SPECIAL_TOKENS,
) -> Vocabulary:
    """Count, rank and store; the corpus is read once, whatever follows."""
    ranked = vocabulary(word_freq(texts, text, key), capacity, specials)
    return Vocabulary(Sized.store(ranked, "token"))
