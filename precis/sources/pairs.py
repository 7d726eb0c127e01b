"""The pair table ``(doc_id, texto, resumen)``: reading, appending, writing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.operators.filters import valid_pairs
from precis.settings import SUMMARY, TEXT
from precis.sources.commits import add_batch

# Cell contents that count as missing when a CSV file is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_pairs(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Scan CSV pairs with a header; a missing path gives an empty table.

    ``doc_id`` is a digest of the row and the number of its copy, so it is the same
    however the files are cut; copies are counted, not ranked, so many of them are no
    hot group. Quoted cells may hold line breaks; a file with such cells cannot be
    split, so it is one task: give a folder of files as ``write_pairs_csv`` makes
    them. With ``multiline=False`` files of any size are split at line ends.
    """
    schema = f"{TEXT} string, {SUMMARY} string"
    try:
        raw = spark.read.csv(path, schema=schema, header=True, multiLine=multiline, quote='"', escape='"')
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], f"doc_id string, {schema}")
        raise
    cells = [
        F.when(F.col(c).isin(*NA_TOKENS), None).otherwise(F.col(c)).alias(c)
        for c in (TEXT, SUMMARY)
    ]
    digest = F.md5(F.to_json(F.struct(TEXT, SUMMARY)))
    rows = raw.select(*cells).withColumn("digest", digest).groupBy("digest").agg(
        F.first(TEXT).alias(TEXT), F.first(SUMMARY).alias(SUMMARY), F.count("*").cast("int").alias("n"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select(
        F.concat_ws("-", "digest", F.col("copy").cast("string")).alias("doc_id"), TEXT, SUMMARY)


def write_pairs_csv(pairs: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write CSV files of bounded size with a header."""
    pairs.select(TEXT, SUMMARY).write.option("maxRecordsPerFile", rows_per_file).csv(
        path, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def append_pairs(
    pairs: DataFrame, path: str, source: str = "user", valid_only: bool = False, token: str | None = None
) -> int:
    """Append pairs to a parquet table, creating it if absent; the new total.

    Only the new rows are written, under fresh keys: the name of the batch and the
    key within it, so keys stay unique whatever is appended at the same time. The name
    is ``token``, or else the next number. A batch comes in whole and once: an append
    with a token that the table has adds nothing. A batch with a null or repeated key
    is refused. ``valid_only`` leaves out blank pairs. ``source`` tells saved summaries
    from pairs given by users.
    """
    spark = pairs.sparkSession
    if valid_only:
        pairs = valid_pairs(pairs)
    keys = pairs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    if not keys.isEmpty():
        raise ValueError("the keys of a batch must be unique and not null")
    add_batch(spark, path, lambda name: pairs.select(
        F.concat_ws("-", F.lit(name), F.col("doc_id").cast("string")).alias("doc_id"),
        TEXT, SUMMARY, F.lit(source).alias("source")), token)
    return spark.read.parquet(path).count()


def write_split(pairs: DataFrame, path: str) -> None:
    """Write train and validation parts as partitions of one table."""
    pairs.write.partitionBy("split").parquet(path)


def union_pairs(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, duplicates kept."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result
