"""Remove long passages that stand anywhere else, by compacting a De Bruijn graph of words.

An edge of the graph is a window of ``n`` consecutive words; its ends are nodes, the runs
of n - 1 words it begins and ends with.

* *Seeds.* A window belongs to its minimizer, the least hash of the runs of ``core``
  words in it, so equal windows have equal minimizers. A maximal run of windows of one
  text with one minimizer travels as one row, for about twelve words. A minimizer that
  one such run has, once, has no window that stands twice. Runs that stand twice as
  a whole are edges as they are; where runs of one minimizer differ, their windows are
  counted one by one at their source coordinates. What repeats is the graph.
* *Compaction.* Where a text passes from one edge that repeats to the next it passes a node.
  Degrees are grouped counts of the different edges on either side. A node with one edge
  in and one out joins the two, and rounds of pointer doubling, each a join, give every
  edge its path and its place there. Edges on a ring without a branch stay paths alone.
* *Verification.* Neighbouring edges of a text that follow each other on a path are one long
  span. The words at its source coordinates are laid beside those of all other spans of the
  path, place by place, in blocks. Where hashes were equal but words are not, all windows of
  the minimizers on that path are counted by their words.

So hashes only propose; equal windows always have equal hashes, and words decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import KEY, Rolling, as_bytes, column, hashes, keyed, mixed, signed, slices, stored

Hashes = Callable[[list[bytes]], np.ndarray]

PATHS = "k1 long, k2 long, start int, n int, core long, path long, loop boolean"
WINDOWS = "k1 long, k2 long, at int, core long, window long, times int"
BLOCKS = "top long, block long, lo int, words binary"
EXACT = "k1 long, k2 long, at int, words binary"
SPANS = "k1 long, k2 long, spans array<struct<start: int, n: int, top: long, ahead: long>>"
#: Places of a path that are compared together.
BLOCK = 64
#: Different blocks that a task holds before it hands them on.
HELD = 1 << 16
RESULT = "doc_id long, text string, n_words long, n_removed long"


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours; doubling needs few passes."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def _cores(rolling: Rolling, n_words: int, core: int) -> np.ndarray:
    at = np.arange(max(0, n_words - core + 1))
    # Mixed again, so that the order among cores has nothing to do with their use as keys.
    return mixed(rolling.of(at, at + core) ^ np.uint64(0x5851F42D4C957F2D))


def _loops(cores: np.ndarray, minimizer: np.ndarray, start: np.ndarray, end: np.ndarray, reach: int) -> np.ndarray:
    """Which paths hold their minimizer twice; only those can hold a window twice."""
    loop = np.zeros(len(start), bool)
    order = np.argsort(cores, kind="stable")
    near = (cores[order[1:]] == cores[order[:-1]]) & (np.diff(order) <= reach + 1)
    p, q = order[:-1][near], order[1:][near]
    if len(p):
        for back in range(-1, reach + 1):
            at = np.clip(p - back, 0, len(minimizer) - 1)
            path = np.searchsorted(start, at, side="right") - 1
            both = (minimizer[at] == cores[p]) & (start[path] <= p) & (q < end[path] + reach)
            loop[path[both]] = True
    return loop


def paths_of(n: int, core: int, hashed: Hashes = hashes):
    """mapInArrow function: (k1, k2, text) to the paths of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, starts, sizes, keys, digests, loops = [], [], [], [], [], []
            for i, text in enumerate(as_bytes(batch)):
                words = (text or b"").split()
                if len(words) < n:
                    continue
                rolling = Rolling(hashed(words))
                cores = _cores(rolling, len(words), core)
                minimizer = least(cores, n - core + 1)
                cuts = np.flatnonzero(minimizer[1:] != minimizer[:-1]) + 1
                start = np.concatenate([[0], cuts])
                end = np.concatenate([cuts, [len(minimizer)]])
                key, loop = minimizer[start], _loops(cores, minimizer, start, end, n - core)
                rows.append(np.full(len(start), i))
                starts.append(start)
                sizes.append(end - start)
                keys.append(key)
                digests.append(rolling.of(start, end + n - 1))
                loops.append(loop)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([
                    column(batch, "k1").take(at), column(batch, "k2").take(at),
                    pa.array(np.concatenate(starts), pa.int32()), pa.array(np.concatenate(sizes), pa.int32()),
                    *(signed(np.concatenate(x)) for x in (keys, digests)), pa.array(np.concatenate(loops)),
                ], names=["k1", "k2", "start", "n", "core", "path", "loop"])

    return run


def windows_of(n: int, hashed: Hashes = hashes):
    """mapInArrow function: texts with the paths to look into, to every window of those paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, places, keys, windows, times = [], [], [], [], []
            for i, (text, asked) in enumerate(zip(as_bytes(batch), column(batch, "asked").to_pylist())):
                rolling = Rolling(hashed(text.split()))
                for path in asked:
                    at = np.arange(path["start"], path["start"] + path["n"])
                    rows.append(np.full(len(at), i))
                    places.append(at)
                    keys.append(np.full(len(at), path["core"], np.int64))
                    windows.append(rolling.of(at, at + n))
                    times.append(np.full(len(at), min(path["times"], 2)))
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([
                column(batch, "k1").take(at), column(batch, "k2").take(at), pa.array(np.concatenate(places), pa.int32()),
                pa.array(np.concatenate(keys)), signed(np.concatenate(windows)),
                pa.array(np.concatenate(times), pa.int32()),
            ], names=["k1", "k2", "at", "core", "window", "times"])

    return run


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: the edges of texts, those that follow each other in the text and on a path as one."""
    for batch in batches:
        spans = column(batch, "spans")
        sizes, flat = np.diff(spans.offsets.to_numpy()), spans.flatten()
        row = np.repeat(np.arange(len(sizes)), sizes)
        start, size, ahead, top = (flat.field(f).to_numpy() for f in ("start", "n", "ahead", "top"))
        shift = ahead - start
        order = np.lexsort((start, shift, top, row))
        row, start, size, ahead, top, shift = (x[order] for x in (row, start, size, ahead, top, shift))
        cut = (row[1:] != row[:-1]) | (top[1:] != top[:-1]) | (shift[1:] != shift[:-1]) | (np.diff(start) != size[:-1])
        first = np.concatenate([[0], np.flatnonzero(cut) + 1]) if len(row) else np.zeros(0, int)
        last = np.append(first[1:], len(row)) - 1 if len(row) else first
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=len(sizes)))])
        values = pa.StructArray.from_arrays([
            pa.array(start[first], pa.int32()), pa.array(start[last] + size[last] - start[first], pa.int32()),
            pa.array(top[first], pa.int64()), pa.array(ahead[first], pa.int64())], names=["start", "n", "top", "ahead"])
        yield pa.RecordBatch.from_arrays(
            [column(batch, "k1"), column(batch, "k2"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
            names=["k1", "k2", "spans"])


def blocks_of(n: int):
    """mapInArrow function: texts with their edges, to the words of their spans by path and block of places.

    A span is a run of edges that follow each other in the text and on their path. What one
    task has twice at the same places of a path it writes once, but for what it held before.
    """

    def handed(found: dict[tuple[int, int, int, bytes], None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            names=["top", "block", "lo", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int, bytes], None] = {}
        for batch in slices(batches):
            for text, edges in zip(as_bytes(batch), column(batch, "spans")):
                words = text.split()
                start, size, ahead, top = (edges.values.field(f).to_numpy() for f in ("start", "n", "ahead", "top"))
                order = np.lexsort((top, ahead, size, start))
                start, size, ahead, top = start[order], size[order], ahead[order], top[order]
                step = np.diff(start)
                cut = (top[1:] != top[:-1]) | (np.diff(ahead) != step) | (step != size[:-1])
                cuts = [0, *(np.flatnonzero(cut) + 1).tolist(), len(start)]
                for a, b in pairwise(cuts):
                    at, place, path = int(start[a]), int(ahead[a]), int(top[a])
                    end = place + int(start[b - 1] + size[b - 1]) - at + n - 1
                    shift = at - place
                    while place < end:
                        block = place // BLOCK
                        stop = min(end, (block + 1) * BLOCK)
                        found[path, block, place - block * BLOCK, b" ".join(words[place + shift : stop + shift])] = None
                        place = stop
                    if len(found) >= HELD:
                        yield handed(found)
                        found = {}
        if found:
            yield handed(found)

    return run


def unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: blocks in order of path and block, to the paths that have two words at one place."""
    block, known = None, {}
    for batch in batches:
        bad = []
        for path, number, lo, words in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, number) != block:
                block, known = (path, number), {}
            for place, word in enumerate(words.split(b" "), lo):
                if known.setdefault(place, word) != word:
                    bad.append(path)
                    break
        if bad:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(set(bad)), pa.int64())], names=["top"])


def exact_of(n: int):
    """mapInArrow function: texts with the paths to look into, to the words of every window of those paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for i, (text, asked) in enumerate(zip(as_bytes(batch), column(batch, "asked").to_pylist())):
                words = text.split()
                places = [p for path in asked for p in range(path["start"], path["start"] + path["n"])]
                for a in range(0, len(places), 8192):
                    some = places[a : a + 8192]
                    at = pa.array(np.full(len(some), i))
                    yield pa.RecordBatch.from_arrays([
                        column(batch, "k1").take(at), column(batch, "k2").take(at), pa.array(some, pa.int32()),
                        pa.array([b" ".join(words[p : p + n]) for p in some], pa.binary()),
                    ], names=["k1", "k2", "at", "words"])

    return run


def remover_of(n: int):
    """mapInArrow function: texts with their repeated spans, to the texts without them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, n_words, n_removed = [], [], []
            for text, spans in zip(as_bytes(batch), column(batch, "spans").to_pylist()):
                words = (text or b"").split()
                if spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    start = np.array([s["start"] for s in spans])
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + np.array([s["n"] for s in spans]) + n - 1, -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                else:
                    left = words
                kept.append(b" ".join(left).decode())
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            ], names=["doc_id", "text", "n_words", "n_removed"])

    return run


def passages(by_row: DataFrame) -> DataFrame:
    """before, after, ahead: each two edges that meet at a node of some text, once, and the windows of the first."""
    edges = F.sort_array("edges")
    pairs = F.zip_with(
        F.slice(edges, 1, F.size("edges") - 1), F.slice(edges, 2, F.size("edges") - 1),
        lambda a, b: F.when(a["start"] + a["n"] == b["start"], F.struct(
            a["edge"].alias("before"), b["edge"].alias("after"), a["n"].cast("long").alias("ahead"))))
    return by_row.select(F.explode(F.filter(pairs, lambda p: p.isNotNull())).alias("p")).select("p.*").distinct()


def compacted(pairs: DataFrame) -> DataFrame:
    """edge, top, ahead: for the edges of ``pairs`` that follow another on a path, its first edge and the windows between.

    A node with one edge in and one out joins these two; round i of pointer doubling carries
    every edge over 2^i others. A round writes only the edges that had not arrived before
    it, and those point at different edges, so no key of these joins is hot. Rounds end when none
    is left or only rings are, whose edges stay alone, like those of no path.
    """
    pairs = stored(pairs)
    one_out = pairs.groupBy("before").agg(F.count(F.lit(1)).alias("outs"), F.max("after").alias("after"), F.max("ahead").alias("ahead"))
    one_in = pairs.groupBy("after").agg(F.count(F.lit(1)).alias("ins")).where("ins = 1").select("after")
    going = stored(one_out.where("outs = 1 and before <> after").join(one_in, "after").select(
        F.col("after").alias("edge"), F.col("before").alias("top"), "ahead"))
    # The first edge of a path has arrived, so that every edge finds the one it points at.
    firsts = going.select("top").join(going.select(F.col("edge").alias("top")), "top", "left_anti")
    there = stored(firsts.select(F.col("top").alias("edge"), "top", F.lit(0).cast("long").alias("ahead")))
    left = going.count()
    while left:
        on = there.withColumn("end", F.lit(True)).unionAll(going.withColumn("end", F.lit(False))).toDF("top", "further", "more", "end")
        moved = stored(going.join(on, "top").select(
            "edge", F.col("further").alias("top"), (F.col("ahead") + F.col("more")).alias("ahead"), "end"))
        there = there.unionAll(moved.where("end").drop("end"))
        going = moved.where("not end").drop("end")
        before, left = left, going.count()
        if left == before:
            break
    return there.where("edge <> top")


def _repeated(rows: DataFrame, paths: DataFrame, n: int, hashed: Hashes) -> DataFrame:
    """k1, k2, start, n, core, edge: the places of all edges that repeat, by hash."""
    # Counts and extremes combine before the shuffle, so hot passages are a row for each task.
    cores = stored(paths.groupBy("core").agg(
        F.count(F.lit(1)).alias("times"), F.min("path").alias("low"), F.max("path").alias("high"), F.max("loop").alias("loops"),
    ).where("times > 1 or loops"))
    branches = (F.col("low") != F.col("high")) | F.col("loops")
    found = stored(paths.join(cores, "core").select(*KEY, "start", "n", "core", "path", branches.alias("branches")))
    columns = (*KEY, "start", "n", "core", F.col("path").alias("edge"))
    whole = found.where("not branches").select(*columns)
    branching = found.where("branches")
    # Each kind of path once, with the coordinates of one of its places.
    kinds = stored(branching.groupBy("core", "path").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct(*KEY, "start", "n")).alias("source")))
    copies = branching.join(kinds.where("times > 1").select("core", "path"), ["core", "path"]).select(*columns)
    asked = kinds.select("source.*", "core", "times").groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "n", "core", F.least("times", F.lit(2).cast("long")).alias("times"))).alias("asked"))
    windows = stored(rows.join(asked, list(KEY)).mapInArrow(windows_of(n, hashed), WINDOWS), "zstd")
    repeated = stored(windows.groupBy("window").agg(F.sum("times").alias("n"), F.min("times").alias("least")).where(
        "n > 1 and least = 1").select("window"))
    # The source of a copied path gives its windows too, so that words of such a window meet those of its like elsewhere.
    single = windows.join(repeated, "window").select(
        *KEY, F.col("at").alias("start"), F.lit(1).alias("n"), "core", F.col("window").alias("edge"))
    return stored(whole.unionAll(copies).unionAll(single), "zstd")


def _by_words(rows: DataFrame, paths: DataFrame, cores: DataFrame, n: int) -> DataFrame:
    """k1, k2, start, n: windows of the given minimizers that repeat, counted by their words."""
    asked = paths.join(cores, "core").select(*KEY, "start", "n").distinct().groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "n")).alias("asked"))
    windows = stored(rows.join(asked, list(KEY)).mapInArrow(exact_of(n), EXACT))
    again = stored(windows.groupBy("words").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("words"))
    return windows.join(again, "words").select(*KEY, F.col("at").alias("start"), F.lit(1).alias("n"))


def with_spans(docs: DataFrame, n: int = 35, hashed: Hashes = hashes) -> DataFrame:
    """doc_id, k1, k2, text, spans: each row with the runs of windows (start, n windows) that stand anywhere else."""
    core = max(1, n // 3)
    rows = keyed(docs).select("doc_id", *KEY, "text")
    paths = rows.select(*KEY, "text").mapInArrow(paths_of(n, core, hashed), PATHS)
    places = _repeated(rows, paths, n, hashed)
    # Repeated rows have one key and the same edges, which a set holds once before and after the shuffle.
    by_row = places.groupBy(*KEY).agg(F.collect_set(F.struct("start", "n", "edge")).alias("edges"))
    named = stored(compacted(passages(by_row)))
    # Copies of a text join by edge here; as both tables are stored, hot edges can be split.
    spans = places.select(*KEY, "start", "n", "edge").join(named, "edge", "left").groupBy(*KEY).agg(F.collect_set(F.struct(
        "start", "n", F.coalesce("top", "edge").alias("top"), F.coalesce("ahead", F.lit(0)).alias("ahead"))).alias("spans"))
    spans = spans.mapInArrow(joined, SPANS)
    marked = stored(rows.join(spans, list(KEY), "left"), "zstd")
    blocks = marked.where("spans is not null").select("text", "spans").mapInArrow(blocks_of(n), BLOCKS)
    # Tasks have combined what they share, so one shuffle does.
    ordered = blocks.repartition("top", "block").sortWithinPartitions("top", "block")
    false = stored(ordered.mapInArrow(unlike, "top long").distinct())
    if false.isEmpty():
        return marked
    # All places of an edge have its path, so these minimizers hold all that was wrongly held equal.
    path = places.join(named, "edge", "left").select("core", F.coalesce("top", "edge").alias("top"))
    wrong = path.join(false, "top", "left_semi").select("core").distinct()
    wrong = stored(wrong)
    right = places.join(wrong, "core", "left_anti").select(*KEY, "start", "n")
    mended = right.unionAll(_by_words(rows, paths, wrong, n)).groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "n")).alias("spans"))
    return rows.join(mended, list(KEY), "left")


def substring_dedup(docs: DataFrame, n: int = 35, hashed: Hashes = hashes) -> DataFrame:
    """Every document without the words that a repeated window of ``n`` words covers.

    Words are runs without ASCII blanks, unchanged. A window is repeated if its words
    also start at any other place, in the same document or another; windows are judged
    on the input. Each row is a document, also one that repeats another row, so of
    repeated rows nothing long stays. Nulls, empty and short texts lose nothing (null
    becomes the empty text). Ties need no rule, as all places of a window go. An
    empty table gives none. ``hashed`` gives a 64-bit number for each word; it
    decides how fast the result is had, not what it is.

    Returns doc_id, text (words that stay, joined by a space), n_words, n_removed.
    """
    return with_spans(docs, n, hashed).select("doc_id", "text", "spans").mapInArrow(remover_of(n), RESULT)
