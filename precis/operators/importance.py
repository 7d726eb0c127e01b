"""Fragment scores inside each document.

Texts are cut into fragments and shuffled once, by ``doc_id``, while still
compact. Word rows are made after that, so every aggregate, window and join
below finds its rows in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.text import (
    clean_light,
    content_words,
    is_content,
    is_long,
    split_fragments,
    tokens,
)
from precis.operators.rows import doc_key, n_tasks, unroll


def fragment_lists(
    texts: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    colocated: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, fragments)`` laid out by ``doc_id``; the key must be unique.

    Set ``colocated`` for a table that is bucketed by its key already. The
    test for a key is one that joins on it would add to some branches only;
    said here, all branches stay alike and share one exchange. The number of
    tasks follows the measured size of the texts.
    """
    lists = texts.where(F.col(key).isNotNull()).select(
        doc_key(key), split_fragments(clean_light(text)).alias("fragments"), *carry
    )
    return lists if colocated else lists.repartition(n_tasks(texts, text), "doc_id")


def fragment_rows(lists: DataFrame) -> DataFrame:
    """``(doc_id, n_fragments, idx, fragment, words)``."""
    counted = lists.select("doc_id", F.size("fragments").alias("n_fragments"), "fragments")
    rows = unroll(counted, ["doc_id", "n_fragments"], "fragments", "idx", "fragment")
    return rows.withColumn("words", tokens("fragment"))


def _place(idx: str = "idx", pos: str = "pos"):
    """Two ints in one long: a sortable place of a word in its document."""
    return F.shiftleft(F.col(idx).cast("long"), 32) + F.col(pos)


def fragment_idf(rows: DataFrame) -> DataFrame:
    """``ln(N / (1 + df))`` with the fragments of one text as its documents.

    Counts every word longer than two characters, stopwords too.
    """
    long_words = F.array_distinct(F.filter("words", is_long))
    words = unroll(rows, ["doc_id", "n_fragments"], long_words)
    return (
        words.groupBy("doc_id", "n_fragments", "word")
        .agg(F.count("*").alias("df"))
        .select(
            "doc_id", "word", "df",
            F.log(F.col("n_fragments").cast("double") / (1 + F.col("df"))).alias("idf"),
        )
    )


def fragment_word_freq(rows: DataFrame) -> DataFrame:
    """Counts of content words per document, with the first place."""
    words = unroll(rows, ["doc_id", "idx"], content_words("words"))
    return words.groupBy("doc_id", "word").agg(
        F.count("*").alias("freq"), F.min(_place()).alias("first_place")
    )


def important_words(freqs: DataFrame) -> DataFrame:
    """The most frequent fifth of a document's content words, at least five."""
    of_doc = Window.partitionBy("doc_id")
    order = of_doc.orderBy(F.desc("freq"), "first_place")
    return (
        # Ranked first: the count then needs no sort of its own.
        freqs.withColumn("rank", F.row_number().over(order))
        .withColumn("n_distinct", F.count("*").over(of_doc))
        .where(F.col("rank") <= F.greatest(F.lit(5), F.floor(F.col("n_distinct") / 5)))
        .select("doc_id", "word", "freq", "rank")
    )


def fragment_importance(rows: DataFrame) -> DataFrame:
    """Score of every fragment: ``(doc_id, n_fragments, idx, score)``.

    ``(0.7 * (sum tf*idf) / m + 0.3 * u / m) * max(0.5, 1 - |n - 10| / 20)``
    with m content words, u distinct important words, n words in all. Only
    content words enter, so only these are exploded; a fragment without any
    keeps one row with no word and scores 0.0.
    """
    keep = ["doc_id", "n_fragments", "idx", "n_words"]
    counted = rows.withColumn("n_words", F.size("words"))
    words = (
        unroll(counted, keep, content_words("words"), keep_empty=True)
        .withColumn("place", _place())
        .drop("pos")
    )
    has_word = F.col("word").isNotNull()
    of_word = Window.partitionBy("doc_id", "word")
    of_doc = Window.partitionBy("doc_id")
    before = F.lag("idx").over(of_word.orderBy("place"))
    # One sort serves all windows up to the rank.
    weighed = (
        words.withColumn("new", has_word & (before.isNull() | (before != F.col("idx"))))
        .withColumn("df", F.count_if("new").over(of_word))
        .withColumn("freq", F.count("word").over(of_word))
        .withColumn("first_place", F.min("place").over(of_word))
        # Each distinct word counts where it first occurs.
        .withColumn(
            "n_distinct", F.count_if(F.col("place") == F.col("first_place")).over(of_doc)
        )
        # First places differ between words, so equal ranks are equal words;
        # rows without a word have freq 0 and come last.
        .withColumn("rank", F.dense_rank().over(of_doc.orderBy(F.desc("freq"), "first_place")))
    )
    idf = F.log(F.col("n_fragments").cast("double") / (1 + F.col("df")))
    important = F.col("rank") <= F.greatest(F.lit(5), F.floor(F.col("n_distinct") / 5))
    sums = weighed.groupBy(*keep).agg(
        F.count("word").alias("m"),
        # The idf of every occurrence: the same sum as count times idf.
        F.sum(F.when(has_word, idf).otherwise(0.0)).alias("weight"),
        F.count_if(F.col("new") & important).alias("u"),
    )
    n, m = F.col("n_words"), F.col("m")
    fit = F.greatest(F.lit(0.5), 1.0 - F.abs(n - 10) / 20)
    score = (0.7 * (F.col("weight") / m / m) + 0.3 * (F.col("u") / m)) * fit
    return sums.select(
        "doc_id", "n_fragments", "idx", F.when(m > 0, score).otherwise(0.0).alias("score")
    )


def long_word_rows(rows: DataFrame) -> DataFrame:
    """Long words as ``(doc_id, idx, pos, word)``."""
    return unroll(rows, ["doc_id", "idx"], "words").where(is_long(F.col("word")))


def drop_stopwords(words: DataFrame) -> DataFrame:
    """Rows whose ``word`` is a content word; a set test, no join needed."""
    return words.where(is_content(F.col("word")))


def keep_important(rows: DataFrame) -> DataFrame:
    """``(doc_id, idx, pos, word)`` of words that are important in their document.

    The windows of ``fragment_importance`` rank the words where they lie, so
    nothing is joined or shuffled beyond the layout by document.
    """
    words = drop_stopwords(long_word_rows(rows)).withColumn("place", _place())
    of_word, of_doc = Window.partitionBy("doc_id", "word"), Window.partitionBy("doc_id")
    ranked = (
        words.withColumn("freq", F.count("*").over(of_word))
        .withColumn("first_place", F.min("place").over(of_word))
        .withColumn("n_distinct", F.count_if(F.col("place") == F.col("first_place")).over(of_doc))
        .withColumn("rank", F.dense_rank().over(of_doc.orderBy(F.desc("freq"), "first_place")))
    )
    important = F.col("rank") <= F.greatest(F.lit(5), F.floor(F.col("n_distinct") / 5))
    return ranked.where(important).select("doc_id", "idx", "pos", "word")
