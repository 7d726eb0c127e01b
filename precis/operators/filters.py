"""Row filters, checks and small reports on the pair table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.text import has_words, word_count
from precis.settings import DEFAULTS, SUMMARY, TEXT


def min_words_filter(texts: DataFrame, text: str, n: int = DEFAULTS.min_words) -> DataFrame:
    """Only texts long enough to summarise."""
    return texts.where(word_count(text) >= n)


def valid_pairs(pairs: DataFrame) -> DataFrame:
    """Only pairs with a text and a summary."""
    return pairs.where(has_words(TEXT) & has_words(SUMMARY))


def min_rows_check(pairs: DataFrame, n: int = DEFAULTS.min_pairs) -> DataFrame:
    """One row: how many pairs there are, and whether that is too few to train."""
    return pairs.agg(F.count("*").alias("n")).withColumn("too_few", F.col("n") < n)


def last_rows(pairs: DataFrame, n: int = 3, key: str = "doc_id") -> DataFrame:
    """The last rows with their 1-based number in the table.

    The numbers follow from the row count, so nothing but the last rows is
    ever ranked.
    """
    total = pairs.agg(F.count("*")).scalar()
    last = pairs.orderBy(F.desc(key)).limit(n)
    seen = last.agg(F.sort_array(F.collect_list(F.struct(key, *[c for c in pairs.columns if c != key])), asc=False).alias("rows"))
    numbered = seen.select(F.posexplode("rows").alias("back", "row"))
    return numbered.select((total - F.col("back")).alias("number"), "row.*")


def holdout_rest(rows: DataFrame, sample: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that are not in the sample."""
    return rows.join(sample.select(key), key, "left_anti")


def align_pairs(
    texts: DataFrame, references: DataFrame, generated: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Text, reference and generated summary of each document side by side."""
    return texts.join(references, key).join(generated, key)
