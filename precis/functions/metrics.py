"""Row-local measures of a text, its summary and a reference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from precis.functions.text import _col, tokens, word_count


def ratio(part: Column, whole: Column) -> Column:
    """Division that gives 0.0 where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def compression_ratio(text: Column | str, summary: Column | str) -> Column:
    return ratio(word_count(summary), word_count(text))


def word_set(c: Column | str) -> Column:
    """Distinct lowercase words."""
    return F.array_distinct(tokens(F.lower(F.coalesce(_col(c), F.lit("")))))


def set_overlap(left: Column | str, right: Column | str) -> Column:
    """Words found in both texts, compared as they are."""
    return F.array_intersect(tokens(left), tokens(right))


def rouge1_from_counts(shared: Column, n_reference: Column, n_generated: Column) -> Column:
    """Precision, recall and F1 from sizes of word sets."""
    precision = ratio(shared, n_generated)
    recall = ratio(shared, n_reference)
    total = precision + recall
    f1 = F.when(total > 0, 2 * (precision * recall) / total).otherwise(F.lit(0.0))
    return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def rouge1(reference: Column | str, generated: Column | str) -> Column:
    """ROUGE-1 on word sets; all zero if either text has no words."""
    ref, gen = word_set(reference), word_set(generated)
    return rouge1_from_counts(
        F.size(F.array_intersect(ref, gen)), F.size(ref), F.size(gen)
    )
