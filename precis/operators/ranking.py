"""Picking the best sentences.

One rule for ties throughout: the score rounded to ten digits (the order in
which a shuffle adds numbers may move the last ones), then the later sentence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.settings import DEFAULTS


def best_first() -> list[Column]:
    return [F.round("score", 10).desc(), F.col("idx").desc()]


def by_score(partition: str = "doc_id"):
    return Window.partitionBy(partition).orderBy(*best_first())


def score_threshold(scores: DataFrame, threshold: float = DEFAULTS.score_threshold) -> DataFrame:
    return scores.where(F.col("score") >= threshold)


def top_n(scores: DataFrame, n: int) -> DataFrame:
    """The n best rows per document.

    The constant bound lets Spark cut every task's share of a document to n
    rows before the shuffle, so a very long document is no hot spot.
    """
    return scores.withColumn("rank", F.row_number().over(by_score())).where(F.col("rank") <= n)


def threshold_top_n(
    scores: DataFrame,
    n: int = DEFAULTS.sentences_to_extract,
    threshold: float = DEFAULTS.score_threshold,
) -> DataFrame:
    return top_n(score_threshold(scores, threshold), n)


def adaptive_k(n: Column) -> Column:
    """How many of n fragments a summary keeps; double arithmetic on purpose."""
    share = lambda f: F.floor(n.cast("double") * F.lit(f)).cast("int")
    return (
        F.when(n <= 5, F.greatest(F.lit(2), n - 1))
        .when(n <= 10, F.greatest(F.lit(3), share(0.4)))
        .otherwise(F.greatest(F.lit(4), share(0.35)))
    )


def rank_then_restore(scores: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The adaptive number of best fragments, as positions in document order.

    Needs ``(doc_id, n_fragments, idx, score)``. A document is one row of the
    source, so its fragments fit one task; with the scores already laid out by
    ``doc_id`` nothing is shuffled.
    """
    ranked = scores.withColumn("rank", F.row_number().over(by_score()))
    return (
        ranked.where(F.col("rank") <= adaptive_k(F.col("n_fragments")))
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list("idx")).alias("kept"))
    )
