"""Reports on summaries, classifiers and training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.metrics import compression_ratio, ratio, rouge1
from precis.functions.text import word_count
from precis.settings import DEFAULTS, PAD


def comparison_report(pairs: DataFrame, text: str, summary: str) -> DataFrame:
    """Text, summary, both word counts and the compression."""
    return pairs.select(
        "doc_id", text, summary,
        word_count(text).alias("text_words"),
        word_count(summary).alias("summary_words"),
        compression_ratio(text, summary).alias("compression"),
    )


def evaluation_report(
    triples: DataFrame, text: str, reference: str, generated: str
) -> DataFrame:
    """Text, reference and generated summary with word counts and ROUGE-1."""
    return triples.select(
        "doc_id", text, reference, generated,
        word_count(text).alias("text_words"),
        word_count(reference).alias("reference_words"),
        word_count(generated).alias("generated_words"),
        rouge1(reference, generated).alias("rouge1"),
    ).select("*", "rouge1.*").drop("rouge1")


def training_report(history: DataFrame) -> DataFrame:
    """Number of epochs, last and best values of a training history."""
    last = lambda c: F.max_by(c, "epoch").alias(f"last_{c}")
    return history.agg(
        F.count("*").alias("epochs"),
        last("loss"), last("val_loss"), last("accuracy"), last("val_accuracy"),
        F.min("val_loss").alias("best_val_loss"),
        F.max("val_accuracy").alias("best_val_accuracy"),
    )


def binary_metrics(
    scored: DataFrame, label: str, score: str, threshold: float = DEFAULTS.score_threshold
) -> DataFrame:
    """Accuracy, precision and recall of ``score > threshold`` against a 0/1 label."""
    said, true = F.col(score) > threshold, F.col(label) == 1
    return scored.agg(
        F.count("*").alias("n"),
        F.count_if(said & true).alias("tp"),
        F.count_if(said).alias("positive"),
        F.count_if(true).alias("relevant"),
        F.count_if(said == true).alias("right"),
    ).select(
        "n",
        ratio(F.col("right"), F.col("n")).alias("accuracy"),
        ratio(F.col("tp"), F.col("positive")).alias("precision"),
        ratio(F.col("tp"), F.col("relevant")).alias("recall"),
    )


def token_accuracy(
    sequences: DataFrame, predicted: str, target: str, ignore_pad: bool = False
) -> DataFrame:
    """Share of positions whose predicted id is the target id."""
    at = F.arrays_zip(F.col(predicted).alias("p"), F.col(target).alias("t"))
    rows = sequences.select(F.inline_outer(at)).where(F.col("t").isNotNull())
    if ignore_pad:
        rows = rows.where(F.col("t") != PAD)
    return rows.agg(
        F.count("*").alias("n"), F.count_if(F.col("p") == F.col("t")).alias("right")
    ).select("n", "right", ratio(F.col("right"), F.col("n")).alias("accuracy"))
