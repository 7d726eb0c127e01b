"""From raw documents to a training mix: five stages, each over all that the one before kept.

Every stage takes the documents and gives documents with the same columns. Their
decisions take effect: documents in no known language go, lines that many documents
share are cut out, one document of each group of near copies stays, contaminated
documents go, and the rest is replicated to the sources' target weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from precis.llm.decontamination import without_contaminated
from precis.llm.language_id import fit, with_known_language
from precis.llm.line_dedup import without_common_lines
from precis.llm.mixing import mixed_documents
from precis.llm.near_dedup import without_near_copies
from precis.sources.storage import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters, most of them in one of the languages that the corpus teaches."""
    return with_known_language(docs, fit(docs), strangers=False)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    return without_common_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on shingles of five words."""
    return without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stands in the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, as many on average as the source's target weight asks for, shuffled."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontamination", decontamination), ("mixing", mixing),
]

#: Learned scores cannot be had in SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage gives is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
