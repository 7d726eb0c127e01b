"""Find passages of benchmark items in documents with a Wu-Manber search over words."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import KEY, as_bytes, column, keyed, numbered, pick, restored, slices, stored
from precis.sources.storage import scratch_path

#: Bytes that are part of a word after lower-casing: digits, a-z and all of other scripts.
_WORD = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_TABLE = bytes(b if b in _WORD else 0x20 for b in bytes(range(256)).lower())

HITS = "doc_id long, k1 long, k2 long, n_words long, first array<int>, last array<int>, item array<string>"


def words(text: bytes | None) -> list[bytes]:
    """The words of a text, lower-cased in ASCII."""
    return (text or b"").translate(_TABLE).split()


class Matcher:
    """Wu-Manber search for windows that are all of one length.

    Words are numbers here: their place in the vocabulary of the items, 0 for all
    others, so equal numbers mean equal words. ``shift`` tells for a block of
    words how far a window may move when the block stands at its end; where it
    is 0, the block's hash leads to the bucket of windows that end with it, and
    those are compared word by word.
    """

    def __init__(self, windows: dict[tuple[int, ...], list[str]], length: int):
        self.length, self.block = length, min(2, length)
        slots = 1 << max(10, (4 * len(windows) * length).bit_length())
        self.mask = slots - 1
        most = length - self.block + 1
        self.shift = np.full(slots, most, np.int32)
        self.items: list[list[str]] = list(windows.values())
        self.windows = np.array(list(windows), np.int64).reshape(len(windows), length)
        ends = np.empty(0, np.int64)
        for at in range(self.block - 1, length):
            ends = self.slot(self.windows, at)
            np.minimum.at(self.shift, ends, length - 1 - at)
        order = np.argsort(ends, kind="stable")
        self.bucket = order
        self.first = np.searchsorted(ends[order], np.arange(slots))
        self.after = np.searchsorted(ends[order], np.arange(slots), side="right")

    def slot(self, ids: np.ndarray, at: int) -> np.ndarray:
        """Hash of the block whose last word is in column ``at``."""
        last = ids[:, at]
        before = ids[:, at - 1] if self.block == 2 else 0
        return self._hash(before, last)

    def _hash(self, before: np.ndarray | int, last: np.ndarray) -> np.ndarray:
        return ((before * 0x9E3779B1 + last * 0x85EBCA77) >> 7) & self.mask

    def search(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where windows begin, and which: texts are ids[start:end], all searched at once."""
        at, stop = starts + self.length - 1, ends
        found_at, found = [], []
        live = at < stop
        at, stop = at[live], stop[live]
        while len(at):
            slot = self._hash(ids[at - 1] if self.block == 2 else 0, ids[at])
            shift = self.shift[slot]
            here = np.flatnonzero(shift == 0)
            if len(here):
                # Every window of the bucket against the words before the block's end.
                first, count = self.first[slot[here]], self.after[slot[here]] - self.first[slot[here]]
                place = np.repeat(at[here], count) - self.length + 1
                nth = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
                window = self.bucket[np.repeat(first, count) + nth]
                for k in range(self.length):
                    same = ids[place + k] == self.windows[window, k]
                    place, window = place[same], window[same]
                found_at.append(place)
                found.append(window)
            at = at + np.maximum(shift, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


class Index:
    """The windows of some benchmark items: a vocabulary and one matcher for each length."""

    def __init__(self, items: Iterable[tuple[str, bytes]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            length = min(n, len(ids))
            for i in range(len(ids) - length + 1 if ids else 0):
                owners = windows[length][tuple(ids[i : i + length])]
                if item not in owners:
                    owners.append(item)
        self.matchers = [Matcher(w, length) for length, w in sorted(windows.items())]

    def scan(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self._scan(slices(batches))

    def clean(self, share: int):
        """mapInArrow function that passes on the rows of which less than 1 / share of the words is hit."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = []

            def seen() -> Iterator[pa.RecordBatch]:
                for part[:] in ([x] for x in slices(batches)):
                    yield part[0]

            for out in self._scan(seen()):
                good = []
                for n, first, last in zip(*(column(out, c).to_pylist() for c in ("n_words", "first", "last"))):
                    n_hit, end = 0, -1
                    for a, b in sorted(zip(first, last)):
                        n_hit += max(0, b - max(end, a - 1))
                        end = max(end, b)
                    good.append(not n_hit or share * n_hit < n)
                yield part[0].filter(pa.array(good, pa.bool_()))

        return run

    def _scan(self, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, none = self.vocabulary.get, 0
        for batch in parts:
            ids, sizes = [], []
            for text in as_bytes(batch):
                own = words(text)
                sizes.append(len(own))
                ids.append(np.array([known(w, none) for w in own], np.int64))
            ends = np.cumsum(sizes, dtype=np.int64)
            starts = ends - sizes
            flat = np.concatenate([*ids, np.zeros(1, np.int64)])
            hits: list[tuple[list[int], list[int], set[str]]] = [([], [], set()) for _ in sizes]
            for m in self.matchers:
                places, windows = m.search(flat, starts, ends)
                owners = np.searchsorted(ends, places, side="right")
                order = np.lexsort((places, owners))
                for doc, place, window in zip(owners[order].tolist(), places[order].tolist(), windows[order].tolist()):
                    first, last, item = hits[doc]
                    place -= int(starts[doc])
                    if first and first[-1] <= place <= last[-1] + 1:
                        last[-1] = max(last[-1], place + m.length - 1)
                    else:
                        first.append(place)
                        last.append(place + m.length - 1)
                    item.update(m.items[window])
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id"), column(batch, "k1"), column(batch, "k2"), pa.array(sizes, pa.int64()),
                pa.array([h[0] for h in hits], pa.list_(pa.int32())),
                pa.array([h[1] for h in hits], pa.list_(pa.int32())),
                pa.array([sorted(h[2]) for h in hits], pa.list_(pa.string())),
            ], names=["doc_id", "k1", "k2", "n_words", "first", "last", "item"])


def _items(benchmark: DataFrame, n: int, block_bytes: int) -> tuple[DataFrame, int]:
    """item_id, text, block of all items with a text, and the number of blocks.

    An item without an id is named by a digest of its text, so each different one counts.
    """
    items = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), "text")
    name = F.coalesce("item_id", F.concat(F.lit("null:"), F.md5(F.col("text").cast("binary"))))
    items = items.where("text is not null").select(name.alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)).cast("int"))
    if n_blocks > 1:
        # One folder for each block, so that a block is read alone.
        path = scratch_path(benchmark.sparkSession, "items")
        items.repartition("block").write.partitionBy("block").parquet(path)
        items = benchmark.sparkSession.read.schema(items.schema).parquet(path)
    return items, n_blocks


def _send(items: DataFrame, block: int, n: int) -> Broadcast:
    """The texts of one block as a broadcast, from which each Python worker makes their index once."""
    some = [(r.item_id, r.text.encode()) for r in items.where(F.col("block") == block).toLocalIterator()]
    return items.sparkSession.sparkContext.broadcast({"items": some, "n": n})


def _with_index(sent: Broadcast, use: Callable[[Index], Callable]) -> Callable:
    """mapInArrow function that makes or finds the worker's index of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        if "index" not in block:
            block["index"] = Index(block["items"], block["n"])
            block["items"] = None
        yield from use(block["index"])(batches)

    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, n: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """Spans of each document's words that some item's window covers, and the items.

    A benchmark beyond ``block_bytes`` of text is several blocks. They are searched one
    after another, each in a job of its own whose hits are stored, so driver and workers
    hold one block at a time; the hits are put together by document. No item is left out.
    Returns doc_id, k1, k2, n_words, first, last, item (spans may overlap).
    """
    (items, n_blocks), rows = _items(benchmark, n, block_bytes), keyed(docs)
    if n_blocks == 1:
        return rows.mapInArrow(_with_index(_send(items, 0, n), lambda x: x.scan), HITS)
    # Rows of one key are copies; they come back below.
    once, found = stored(rows.dropDuplicates(list(KEY))), []
    for b in range(n_blocks):
        sent = _send(items, b, n)
        hits = once.mapInArrow(_with_index(sent, lambda x: x.scan), HITS)
        # The first block tells the number of words of all documents, the others bring hits alone.
        found.append(stored(hits if b == 0 else hits.where(F.size("item") > 0)))
        sent.destroy()
    merged = reduce(DataFrame.unionAll, found).groupBy(*KEY).agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("first")).alias("first"),
        F.flatten(F.collect_list("last")).alias("last"), F.array_distinct(F.flatten(F.collect_list("item"))).alias("item"),
    )
    return rows.select("doc_id", *KEY).join(merged, list(KEY)).select("doc_id", *KEY, "n_words", "first", "last", "item")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, block_bytes: int = 16 << 20
) -> DataFrame:
    """How much of each document stands in the benchmark.

    Words are runs of digits, a-z and all beyond ASCII, after A-Z have become a-z.
    A window is ``n`` consecutive words of an item; an item of fewer words, but not
    none, is one window. A document's word inside any occurrence of a window is hit.
    A document is contaminated if it has hits, and ``share`` times their number is at
    least its number of words. Nulls and texts without words have no words and no
    hits, items likewise; an item without an id is named "null:" and the MD5 of its text, so
    such items of different texts are different ones, and repeats of one text are one. Items
    of equal text but different ids all count; repeated rows of one item count once. Repeated documents each
    get their row. With an empty benchmark nothing is hit.

    Returns doc_id, k1, k2 (key of the row), n_words, n_hit, items (array, sorted as strings), contaminated.
    """
    found = benchmark_hits(docs, benchmark, n, block_bytes)
    # Length of the union of spans: sorted, each adds what lies beyond the last end.
    spans = F.array_sort(F.arrays_zip("first", "last"))
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    union = F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a["end"], s["last"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(a["end"], s["first"] - 1))).alias("n"),
    ))["n"]
    hit = F.when(F.size("first") == 0, F.lit(0).cast("long")).otherwise(union)
    return found.select("doc_id", *KEY, "n_words", hit.alias("n_hit"), F.array_sort("item").alias("items")).select(
        "*", ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, block_bytes: int = 16 << 20
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    (items, n_blocks), rows = _items(benchmark, n, block_bytes), numbered(docs)
    if n_blocks == 1:
        sent = _send(items, 0, n)
        return restored(rows.mapInArrow(_with_index(sent, lambda x: x.clean(share)), rows.schema), docs)
    bad = decontaminate(docs, benchmark, n, share, block_bytes).where("contaminated").select(*KEY).distinct()
    return restored(rows.join(bad, list(KEY), "left_anti"), docs)
