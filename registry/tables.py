"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.settings import SUMMARY, TEXT


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant's next turn, NULL where there is none.

    Both ids are in the join key, so one very long conversation is no hot key.
    """
    said = read(spark, sf_dir, "conversations")
    asked = said.where("role = 'user'").select("conv_id", "turn", F.col("text").alias(TEXT))
    answered = said.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias(SUMMARY)
    )
    doc_id = F.shiftleft("conv_id", 20) + F.col("turn")
    return asked.join(answered, ["conv_id", "turn"], "left").select(
        doc_id.alias("doc_id"), TEXT, SUMMARY
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs ``(doc_id, texto, resumen)`` out of conversations."""
    return turns(spark, sf_dir).where(F.col(SUMMARY).isNotNull())


def r6(c: Column | str) -> Column:
    """Six digits, for comparison between engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def joined(c: Column | str) -> Column:
    """An array as one string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<string>"), " ")
