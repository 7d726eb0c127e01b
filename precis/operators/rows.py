"""Tables of rows out of tables of arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in one task of a layout by key; its rows of words take about thirty times the space.
TASK_BYTES = 4 * 1024 * 1024


def n_tasks(texts: DataFrame, text: str) -> int:
    """How many tasks the word rows of some texts need, by the measured size of the texts.

    Exchanged texts look small, so adaptive execution would put many of them in one task,
    whose word rows then spill. The measure reads one column and cleans nothing.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    return max(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))


def doc_key(key: str) -> Column:
    """The key by the name ``doc_id``, without an alias where it has that name.

    Spark drops a needless alias, but not from the first table of a union, whose exchange
    then differs from those it could be shared with.
    """
    return F.col(key) if key == "doc_id" else F.col(key).alias("doc_id")


def unroll(
    df: DataFrame,
    keep: list[str],
    values: Column | str,
    pos: str = "pos",
    item: str = "word",
    keep_empty: bool = False,
) -> DataFrame:
    """One row per array element, with its 0-based position.

    Spark tests an array for emptiness ahead of an inner explode by computing
    it a second time, and pushes that test below exchanges, which then differ
    from others they could be shared with. The outer form has no such test.
    Sizes belong one step earlier, so that the array itself is not copied into
    each of its rows.
    """
    rows = df.select(*keep, F.posexplode_outer(values).alias(pos, item))
    return rows if keep_empty else rows.where(F.col(pos).isNotNull())
