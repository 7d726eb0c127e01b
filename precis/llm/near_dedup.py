"""Near-duplicate documents: MinHash bands find candidates, odd sketches sift, full sets decide.

The work is on classes, the different sets of shingles; copies share one class. A
bucket holds the classes that agree in one band. Pairs of a bucket are not made
all: every member meets the bucket's leader, the class that meets most others.
Links found so join most of a group of near copies. Only where members of a bucket
are then still in different components do these meet each other, in blocks of
bounded size, so that no link is lost and none is sought twice within a component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import (
    KEY, Rolling, as_bytes, column, hashes, keyed, mixed, numbered, restored, slices, stored,
)
from precis.llm.components import components

SIGNATURES = ("doc_id long, k1 long, k2 long, n_shingles long, node binary, bands array<long>, sketch array<long>")
SETS = "node binary, shingles array<long>"
LINKS = "a binary, b binary"


@dataclass(frozen=True)
class Settings:
    #: Words in a shingle.
    words: int = 5
    #: Linked from this similarity on, in percent.
    percent: int = 80
    #: Bands and samples in a band: a pair of similarity 0.8 meets in some band but for 3 in a million.
    bands: int = 32
    rows: int = 5
    #: Bits of the odd sketch.
    bits: int = 512
    #: Standard deviations below the expected similarity at which a sketch rules a pair out.
    deviations: float = 5.0
    #: Classes of one bucket that a task compares with as many others at a time.
    block: int = 512

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_differences(self) -> int:
        """Bits in which the sketches of a pair at the limit differ, but for rare exceptions.

        s samples of a pair with similarity j differ in s(1-j) places on average,
        each of which turns two bits of the n; equal bits turned twice cancel.
        """
        s, n, j = self.samples, self.bits, self.percent / 100
        turned = 2 * s * (1 - j)
        mean = n / 2 * (1 - np.exp(-2 * turned / n))
        slope = np.exp(-2 * turned / n)
        variance = (2 * slope) ** 2 * s * j * (1 - j) + n / 4 * (1 - np.exp(-4 * turned / n))
        return int(np.ceil(mean + self.deviations * np.sqrt(variance)))


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; all words as one if they are fewer."""
    own = hashes((text or b"").lower().split())
    if not len(own):
        return own
    at = np.arange(max(1, len(own) - words + 1))
    return np.unique(Rolling(own).of(at, np.minimum(at + words, len(own))))


class Signer:
    """MinHash samples of a set, folded into bands and into an odd sketch."""

    def __init__(self, settings: Settings):
        self.settings = settings
        seeds = mixed(np.arange(1, 2 * settings.samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.factors = (seeds[: settings.samples] | np.uint64(1))[:, None]
        self.shifts = seeds[settings.samples :][:, None]

    def samples(self, own: np.ndarray) -> np.ndarray:
        """The least of all values of the set under each of the functions."""
        out = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        step = 1 << 13
        for i in range(0, len(own), step):
            part = own[None, i : i + step]
            for j in range(0, len(out), 32):
                least = (part * self.factors[j : j + 32] + self.shifts[j : j + 32]).min(1)
                np.minimum(out[j : j + 32], least, out=out[j : j + 32])
        return out

    def bands(self, samples: np.ndarray) -> np.ndarray:
        """Keys of the bands; samples are the rows."""
        grid = samples.reshape(len(samples), self.settings.bands, self.settings.rows)
        key = np.broadcast_to(np.arange(self.settings.bands, dtype=np.uint64), grid.shape[:2])
        for r in range(self.settings.rows):
            key = mixed(key * np.uint64(31) + grid[:, :, r])
        return key

    def sketches(self, samples: np.ndarray) -> np.ndarray:
        """Each sample turns one bit, chosen by its value and its place."""
        bits = self.settings.bits
        at = mixed(samples ^ mixed(np.arange(samples.shape[1], dtype=np.uint64))) % np.uint64(bits)
        odd = np.zeros((len(samples), bits), np.uint8)
        rows = np.repeat(np.arange(len(samples)), samples.shape[1])
        np.bitwise_xor.at(odd, (rows, at.ravel().astype(np.int64)), 1)
        return np.packbits(odd, axis=1).view(np.int64)

    def sign(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t, self.settings.words) for t in as_bytes(batch)]
            filled = [i for i, s in enumerate(sets) if len(s)]
            bands: list[list[int] | None] = [None] * len(sets)
            sketches: list[list[int] | None] = [None] * len(sets)
            if filled:
                samples = np.array([self.samples(sets[i]) for i in filled])
                for i, b, k in zip(filled, self.bands(samples).view(np.int64).tolist(), self.sketches(samples).tolist()):
                    bands[i], sketches[i] = b, k
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id"), column(batch, "k1"), column(batch, "k2"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
            ], names=["doc_id", "k1", "k2", "n_shingles", "node", "bands", "sketch"])


def _sets_of(words: int):
    """mapInArrow function: (node, text) to (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t, words) for t in as_bytes(batch)]
            ends = np.cumsum([0, *map(len, sets)])
            values = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "node"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                names=["node", "shingles"])

    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches that are sorted by them."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [column(batch, k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        if rest and any(column(rest[-1], k)[-1] != column(batch, k)[0] for k in keys):
            yield pa.Table.from_batches(rest)
            rest = []
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            rest.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def _meet(settings: Settings):
    """mapInArrow function: cells of buckets to the links between members of different components."""
    most, percent = settings.most_differences, settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["bucket", "i", "j"]):
            table = cell.combine_chunks()
            nodes = table["node"].to_pylist()
            roots = np.unique(np.array([r.hex() for r in table["root"].to_pylist()]), return_inverse=True)[1]
            if not roots.any():
                continue
            block = table["block"].to_numpy()
            i, j = table["i"][0].as_py(), table["j"][0].as_py()
            sizes = table["n"].to_numpy()
            sketches = np.array(table["sketch"].to_pylist(), np.int64).view(np.uint64)
            chunk = table["shingles"].chunk(0)
            ends, values = chunk.offsets.to_numpy(), chunk.values.to_numpy()
            left = np.flatnonzero(block == i)
            right = np.flatnonzero(block == j)
            found_a, found_b = [], []
            for x in left.tolist():
                # Of two blocks all pairs are seen here once, of one block those in order.
                other = right[right > x] if i == j else right
                other = other[roots[other] != roots[x]]
                small, large = np.minimum(sizes[other], sizes[x]), np.maximum(sizes[other], sizes[x])
                other = other[100 * small >= percent * large]
                if len(other):
                    apart = np.bitwise_count(sketches[other] ^ sketches[x]).sum(1)
                    other = other[apart <= most]
                if len(other):
                    own = values[ends[x] : ends[x + 1]]
                    for y in other.tolist():
                        both = len(np.intersect1d(own, values[ends[y] : ends[y + 1]], assume_unique=True))
                        if 100 * both >= percent * (sizes[x] + sizes[y] - both):
                            found_a.append(nodes[x])
                            found_b.append(nodes[y])
            if found_a:
                yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], names=["a", "b"])

    return run


def _differences(a: Column, b: Column) -> Column:
    each = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda t, x: t + x)


def _star_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between each bucket's leader and its other members."""
    meets = members.groupBy("node").agg(F.sum("m").alias("meets"))
    leaders = stored(members.join(meets, "node").groupBy("bucket").agg(F.max(F.struct("meets", "node")).alias("top")))
    pairs = members.join(leaders, "bucket").select("node", F.col("top.node").alias("leader")).where("node <> leader")
    pairs = pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*(F.col(c).alias(name if c == "node" else f"{c}_{name}") for c in df.columns))

    light = nodes.select("node", "sketch", "n")
    near = pairs.join(side(light, "a"), "a").join(side(light, "b"), "b").where(
        (settings.percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))
        & (_differences(F.col("sketch_a"), F.col("sketch_b")) <= settings.most_differences)
    ).select("a", "b")
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return near.join(side(sets, "a"), "a").join(side(sets, "b"), "b").where(
        100 * both >= settings.percent * (F.size("shingles_a") + F.size("shingles_b") - both)
    ).select("a", "b")


def _rest_links(members: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between members of a bucket that are in different components."""
    placed = members.join(roots, "node", "left").select("bucket", "m", "node", F.coalesce("root", "node").alias("root"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = stored(open_.where("low <> high").select("bucket"))
    n_blocks = F.ceil(F.col("m") / settings.block).cast("int")
    left = placed.join(open_, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
    # A block meets itself and every other block of its bucket once.
    cells = left.withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1))).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    rich = cells.join(nodes.select("node", "sketch", "n").join(sets, "node"), "node")
    dealt = rich.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return dealt.select("bucket", "i", "j", "block", "node", "root", "sketch", "n", "shingles").mapInArrow(_meet(settings), LINKS).distinct()


def near_components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, k1, k2, n_shingles, node (the class, null for an empty set), component_id for every row."""
    rows = keyed(docs).select("doc_id", *KEY, "text")
    signed = stored(rows.mapInArrow(Signer(settings).sign, SIGNATURES))
    classes = signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct(*KEY)).alias("key"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = stored(classes)
    places = classes.select("node", F.explode("bands").alias("bucket"))
    crowded = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stored(places.join(crowded, "bucket").select("bucket", "m", "node"))
    nodes = classes.join(members.select("node").distinct(), "node").select("node", "key.*", "n", "sketch")
    nodes = stored(nodes)
    # Repeated rows have one key and give their set more than once.
    texts = nodes.select("node", *KEY).join(rows.select(*KEY, "text"), list(KEY)).select("node", "text")
    sets = stored(texts.mapInArrow(_sets_of(settings.words), SETS).dropDuplicates(["node"]))
    links = stored(_star_links(members, nodes, sets, settings))
    roots = components(links)
    more = stored(_rest_links(members, roots, nodes, sets, settings))
    if not more.isEmpty():
        # The components found so far are stars, to which the further links are added.
        stars = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = components(stars.unionAll(more))
    named = classes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = stored(named.groupBy("root").agg(F.min("least_id").alias("component_id")))
    named = named.join(least, "root").select("node", "root", "component_id")
    return signed.select("doc_id", *KEY, "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", *KEY, "n_shingles", "node", "root",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Components of documents whose shingles are alike, one row for each row of ``docs``.

    Words are runs without ASCII blanks after A-Z have become a-z; a document's set is
    its distinct shingles of ``words`` words, all words as one shingle if there are
    fewer, nothing for null and empty texts, which are linked with nothing. Documents
    are linked if 100 * intersection >= percent * union, confirmed on the full sets.
    component_id is the smallest doc_id reachable; a null id is larger than any, so
    it remains only among nulls. ``kept`` is doc_id = component_id (nulls equal). Of
    repeated rows with one doc_id all are kept or none. An empty table gives none.

    Returns doc_id, n_shingles, component_id, kept.
    """
    found = near_components(docs, settings)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stand for their component, unchanged; one row of each."""
    found = near_components(docs, settings)
    stay = found.where(F.col("node").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
    one = stay.groupBy("root").agg(F.min(F.struct(*KEY)).alias("key")).select("key.*")
    empty = found.where("node is null").select(*KEY).distinct()
    rows = numbered(docs)
    first = rows.join(one, list(KEY)).dropDuplicates(list(KEY))
    return restored(first.unionAll(rows.join(empty, list(KEY), "left_semi")), docs)
