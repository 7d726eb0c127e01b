"""Texts entered line by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.text import has_words, trim_ws


def assemble_lines(lines: DataFrame) -> DataFrame:
    """One text per document out of ``(doc_id, line_no, line)``.

    Leading blank lines are skipped, the first blank line after content ends
    the text, the rest is joined by one space and trimmed. Lines travel once, by
    document, as their text becomes one row in the end; two running counts and
    the assembly use that layout.
    """
    content = has_words("line")
    so_far = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    begun = lines.withColumn("content", content).withColumn("begun", F.count_if("content").over(so_far) > 0)
    ended = begun.withColumn("ended", F.count_if(F.col("begun") & ~F.col("content")).over(so_far) > 0)
    kept = (
        ended.where(F.col("content") & ~F.col("ended"))
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("parts"))
    )
    return kept.select(
        "doc_id", trim_ws(F.array_join(F.col("parts").getField("line"), " ")).alias("text")
    )
