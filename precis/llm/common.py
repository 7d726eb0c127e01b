"""Helpers that several operators share: column choice, row keys, batches of texts, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.sources.storage import scratch_path

#: ASCII blanks that end a word and that are stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The row key of ``keyed``.
KEY = ("k1", "k2")
#: Bytes of text that a Python task handles at a time.
SLICE_BYTES = 4 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name and place.

    Other columns may have any name, also one that differs from a wanted one in
    case only. The first column of a name counts.
    """
    every = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return every.select(*(F.col(f"c{df.columns.index(n)}").alias(n) for n in names))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the row key (k1, k2), two longs that are never null.

    k1 is the document's id and k2 a digest of id and text, so that the key is the
    same on every read. Rows with equal keys are copies in id and text, which every
    operator here treats alike.
    """
    return numbered(docs).select("doc_id", "text", *KEY)


def numbered(docs: DataFrame) -> DataFrame:
    """``keyed`` beside all columns of ``docs``, which are named c0, c1 and so on."""
    every = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at_id, text = (F.col(f"c{docs.columns.index(n)}") for n in ("doc_id", "text"))
    doc_id = at_id.cast("long")
    return every.select(
        "*", doc_id.alias("doc_id"), text.alias("text"),
        F.coalesce(doc_id, F.lit(0)).alias("k1"), F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text).alias("k2"),
    )


def restored(rows: DataFrame, docs: DataFrame, text: str | None = None) -> DataFrame:
    """Rows of ``numbered(docs)`` with the columns of ``docs``.

    With ``text`` the text is taken from that column, and n_chars follows it where
    there is such a column.
    """
    names, types = docs.columns, [f.dataType for f in docs.schema]
    out = [F.col(f"c{i}") for i in range(len(names))]
    if text:
        out[names.index("text")] = F.col(text)
        if "n_chars" in names:
            i = names.index("n_chars")
            out[i] = F.length(text).cast(types[i])
    return rows.select(*(c.alias(f"c{i}") for i, c in enumerate(out))).toDF(*names)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has about ``size`` bytes of text, one row at least."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    return column(batch, name).cast(pa.binary()).to_pylist()


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers well mixed (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An odd factor, so that it has an inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


class Rolling:
    """Hashes of any run of words of one text, each by two look-ups and a product."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        up, down = np.full(n + 1, FACTOR, np.uint64), np.full(n + 1, INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(words) * np.cumprod(up, dtype=np.uint64)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of words[start:end] for arrays of starts and ends."""
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as the longs of Spark."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The rows written as a table to the shared checkpoint folder and read from there.

    Besides the lineage, this makes a join with sums plain: both sides are then shuffled
    for the join itself, which lets adaptive execution split a key with many rows, and
    Spark knows the size of the table, and so whether to send it whole.
    """
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
