"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import BLANKS, KEY, ascii_lower, keyed, numbered, restored, stored


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digests(lines: Column, min_chars: int) -> Column:
    """128 bits of each line's key; null for a key that is too short.

    One pass for each step, as a step that uses its input twice would compute it twice.
    """
    bare = F.transform(lines, lambda x: F.btrim(x, F.lit(BLANKS)))
    keys = F.transform(bare, ascii_lower)
    return F.transform(keys, lambda k: F.when(
        F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))


def dropped_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Places (from 0) of the lines to drop: k1, k2, places array; only documents that have some."""
    rows = keyed(docs).select(*KEY, _digests(_lines(F.col("text")), min_chars).alias("d"))
    # One row for each key of a document (the outer form computes the array once); counts combine before the shuffle, so a
    # line that is everywhere costs one row for each task.
    frequent = stored(
        rows.select(F.explode_outer(F.array_distinct("d")).alias("d")).where("d is not null")
        .select("d.h1", "d.h2").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_docs).select("h1", "h2")
    )
    places = rows.select(*KEY, F.posexplode_outer("d").alias("place", "d")).where("d is not null")
    places = places.select(*KEY, "place", "d.h1", "d.h2")
    # A set, as copies of a row have the same key.
    return places.join(frequent, ["h1", "h2"]).groupBy(*KEY).agg(F.collect_set("place").alias("places"))


def _kept(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` with n_lines, n_dropped and kept, the lines that stay."""
    joined = rows.join(dropped, list(KEY), "left").withColumn("lines", _lines(F.col("text")))
    n = F.size("lines")
    places = F.coalesce("places", F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), n - 1), places)
    return joined.select(
        *rows.columns,
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n").alias("kept"),
        n.cast("long").alias("n_lines"),
        F.size(places).cast("long").alias("n_dropped"),
    )


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Every document without the lines that ``min_docs`` or more documents have.

    A line's key is the line without ASCII blanks at both ends and with A-Z in
    lower case; keys of under ``min_chars`` code points are never dropped. Each row
    is a document, also one that repeats another row. A null text is one empty
    line. Ties need no rule, as all lines of a key go. An empty table gives none.

    Returns doc_id, text (lines that stay, joined by a line feed), n_lines, n_dropped.
    """
    kept = _kept(keyed(docs), dropped_lines(docs, min_docs, min_chars))
    return kept.select("doc_id", F.col("kept").alias("text"), "n_lines", "n_dropped")


def without_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the same columns and the text of ``line_dedup``."""
    return restored(_kept(numbered(docs), dropped_lines(docs, min_docs, min_chars)), docs, "kept")
