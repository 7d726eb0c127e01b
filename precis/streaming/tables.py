"""Tables that follow a stream: appended pairs, and word counts.

Both are micro-batch jobs. A batch that Spark repeats after a failure has the number that it
had, and that number names its commit, so nothing is added twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from precis.operators.vocabulary import FIRST, word_freq
from precis.sources.commits import add_batch
from precis.sources.pairs import append_pairs

COUNTS = "word string, freq long, first_doc long, first_rank int"


def append_stream(pairs: DataFrame, path: str, checkpoint: str, name: str = "stream", source: str = "user") -> DataStreamWriter:
    """A writer, to be started, that appends a stream of pairs as ``append_pairs`` does.

    The token of a batch is ``name`` and its number, so two streams into one table need
    different names, and a stream keeps its name and its ``checkpoint`` folder when it is
    started anew. Keys must be unique within a batch.
    """
    def commit(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            append_pairs(batch, path, source, token=f"{name}-{number}")

    return pairs.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def word_freq_stream(texts: DataFrame, text: str, path: str, checkpoint: str, key: str = "doc_id") -> DataStreamWriter:
    """A writer, to be started, that keeps the counts of ``word_freq`` of a stream of texts.

    The counts are state of the stream, kept by word in its ``checkpoint`` folder; a batch is
    combined in the tasks before it is shuffled to the state. The new counts of the words that
    a batch changes are one part of the table, written once or not at all.
    """
    def commit(changed: DataFrame, number: int) -> None:
        add_batch(changed.sparkSession, path, lambda _: changed.drop("first_batch"), f"b-{number}", look_first=False)

    counts = word_freq(texts, text, key)
    return counts.writeStream.outputMode("update").foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def read_word_freq(spark: SparkSession, path: str) -> DataFrame:
    """``(word, freq, first_batch, first_doc, first_rank)`` of all batches so far.

    The last count of a word is its greatest, and its last place its first one.
    """
    first = F.min(F.struct(F.lit(0).alias("first_batch"), "first_doc", "first_rank")).alias("first")
    return spark.read.schema(COUNTS).parquet(path).groupBy("word").agg(F.max("freq").alias("freq"), first).select(
        "word", "freq", *[F.col(f"first.{c}").alias(c) for c in FIRST])
