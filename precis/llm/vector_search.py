"""Nearest neighbours with balanced posting lists, chosen through a graph of their centroids.

A bounded sample gives the centroids; every vector goes to the list of its nearest
one and, near a boundary, to those of others about as near. A query walks the graph of
centroids and reads the lists whose centroids are within a ratio of the nearest.
Lists and the queries on them meet in blocks of bounded size. Equal vectors are one
entry with their smallest ids, which are all that a result can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.llm.common import column, pick, stored

PLACED = "h1 long, h2 long, v array<double>, ids array<long>, list int"
ASKED = "h1 long, h2 long, v array<double>, list int"
FOUND = "h1 long, h2 long, vec_id long, score double"
#: How many times more lists a query reads that has found too few.
WIDER = 8


@dataclass(frozen=True)
class Settings:
    k: int = 10
    #: Vectors in a list on average, lists at most, and sampled vectors for each list.
    list_rows: int = 256
    most_lists: int = 8192
    sample_per_list: int = 32
    #: Lists that a boundary vector is in at most, and how much farther than the nearest they may be.
    replicas: int = 3
    replica_ratio: float = 1.1
    #: Lists that a query reads at least, and how much farther than the nearest centroid the others may be.
    least_probes: int = 8
    probe_ratio: float = 1.13
    #: Neighbours of a centroid in the graph, and centroids that a walk keeps (more where the ratio asks for more).
    neighbours: int = 16
    beam: int = 16
    #: Entries and queries that meet in one block.
    block: int = 4096


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b, with the small error of the product form."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def balanced_centroids(sample: np.ndarray, n_lists: int, rounds: int = 8) -> np.ndarray:
    """Means of groups, none of which has over twice the average of the sample: large ones are halved."""
    rng = np.random.default_rng(7)
    sample = np.unique(sample, axis=0)
    n_lists = max(1, min(n_lists, len(sample)))
    centroids = sample[rng.choice(len(sample), n_lists, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([distances(p, centroids).argmin(1) for p in np.array_split(sample, 1 + len(sample) // 4096)])
        sums, sizes = np.zeros_like(centroids), np.bincount(own, minlength=len(centroids))
        np.add.at(sums, own, sample)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    most, out = 2 * max(1, len(sample) // n_lists), []
    todo = [sample[own == i] for i in range(len(centroids))]
    while todo:
        group = todo.pop()
        if not len(group):
            continue
        if len(group) > most:
            # Halves along the longest direction from the mean.
            away = group - group.mean(0)
            along = away @ away[np.argmax((away**2).sum(1))]
            order = np.argsort(along, kind="stable")
            todo += [group[order[: len(group) // 2]], group[order[len(group) // 2 :]]]
        else:
            out.append(group.mean(0))
    return np.array(out)


class CentroidGraph:
    """Each centroid knows its nearest others and a few random ones; walks keep the best seen."""

    def __init__(self, centroids: np.ndarray, settings: Settings):
        self.centroids, self.settings = centroids, settings
        n = len(centroids)
        rng = np.random.default_rng(11)
        near = min(settings.neighbours, n - 1)
        rows = []
        for part in np.array_split(np.arange(n), 1 + n // 1024):
            d = distances(centroids[part], centroids)
            d[np.arange(len(part)), part] = np.inf
            nearest = np.argpartition(d, near - 1, axis=1)[:, :near] if near else np.zeros((len(part), 0), int)
            rows.append(np.concatenate([nearest, rng.integers(0, n, (len(part), 4))], axis=1))
        self.edges = np.concatenate(rows)
        self.entries = rng.choice(n, min(n, 12), replace=False)

    def walk(self, vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and squared distances of the ``width`` nearest centroids found, nearest first."""
        n = len(self.centroids)
        width = min(width, n)
        rows = np.arange(len(vectors))[:, None]
        seen = np.zeros((len(vectors), n + 1), bool)
        beam = np.full((len(vectors), width), n)
        far = np.full((len(vectors), width), np.inf)
        done = np.ones((len(vectors), width), bool)
        fresh = np.broadcast_to(self.entries, (len(vectors), len(self.entries)))
        while True:
            fresh = np.sort(fresh, axis=1)
            again = np.zeros(fresh.shape, bool)
            again[:, 1:] = fresh[:, 1:] == fresh[:, :-1]
            fresh = np.where(again | seen[rows, fresh], n, fresh)
            seen[rows, fresh] = True
            known = fresh < n
            gap = self.centroids[np.where(known, fresh, 0)] - vectors[:, None, :]
            new = np.where(known, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
            every, away = np.concatenate([beam, fresh], 1), np.concatenate([far, new], 1)
            ready = np.concatenate([done, ~known], 1)
            best = np.argsort(away, axis=1, kind="stable")[:, :width]
            beam, far, done = every[rows, best], away[rows, best], ready[rows, best]
            open_ = ~done
            if not open_.any():
                return beam, far
            # The two nearest that have not been looked from.
            turn = open_ & (np.cumsum(open_, axis=1) <= 2)
            done |= turn
            steps = self.edges[np.where(beam < n, beam, 0)]
            order = np.argsort(~turn, axis=1, kind="stable")[:, :2]
            used = turn[rows, order]
            fresh = np.where(used[:, :, None], steps[rows, order], n).reshape(len(vectors), -1)


class Lists:
    """Which lists a vector is filed in, and which ones a query reads."""

    def __init__(self, graph: CentroidGraph, settings: Settings):
        self.graph, self.settings = graph, settings

    def _pairs(self, vectors: np.ndarray, ratio: float, least: int, most: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lists, block by block; without ``most`` a walk is widened until it passes the ratio."""
        rows, lists = [], []
        n = len(self.graph.centroids)
        if least >= n:
            # All lists, whether a walk would come to them or not.
            return np.repeat(np.arange(len(vectors)), n), np.tile(np.arange(n), len(vectors))
        width = max(self.settings.beam, least)
        todo = [(p, width) for p in np.array_split(np.arange(len(vectors)), 1 + len(vectors) // 512)]
        while todo:
            part, width = todo.pop()
            found, squared = self.graph.walk(vectors[part], width)
            near = (squared <= squared[:, :1] * ratio**2) & np.isfinite(squared)
            if most is None and width < len(self.graph.centroids):
                more = near[:, -1]
                if more.any():
                    todo.append((part[more], 2 * width))
                    part, found, squared, near = part[~more], found[~more], squared[~more], near[~more]
            near[:, :least] = np.isfinite(squared[:, :least])
            if most:
                near[:, most:] = False
            at, place = np.nonzero(near)
            rows.append(part[at])
            lists.append(found[at, place])
        return np.concatenate(rows), np.concatenate(lists)

    def _run(self, batches: Iterator[pa.RecordBatch], names: list[str], ratio: float, least: int, most: int | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.array(column(batch, "v").to_pylist())
                rows, lists = self._pairs(vectors, ratio, least, most)
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, n) for n in names), pa.array(lists, pa.int32())], names=[*names, "list"])

    def file(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = self.settings
        return self._run(batches, ["h1", "h2", "v", "ids"], s.replica_ratio, 1, s.replicas)

    def ask(self, least: int):
        """mapInArrow function: queries to the lists that they read, ``least`` or more."""
        return lambda batches: self._run(batches, ["h1", "h2", "v"], self.settings.probe_ratio, least, None)


def _nearest(k: int):
    """Cogroup function: entries and queries of one block to each query's k + 1 nearest ids."""

    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [])
        if entries.num_rows and queries.num_rows:
            vectors = np.array(entries["v"].to_pylist())
            ids = entries["ids"].to_pylist()
            asked = np.array(queries["v"].to_pylist())
            h1, h2 = queries["h1"].to_pylist(), queries["h2"].to_pylist()
            width = min(k + 1, len(vectors))
            for part in np.array_split(np.arange(len(asked)), 1 + len(asked) // 256):
                rough = distances(asked[part], vectors)
                # What the product form may have put in wrong order is measured exactly.
                limit = np.partition(rough, width - 1, axis=1)[:, width - 1] * (1 + 1e-9) + 1e-9
                for q, row, most in zip(part.tolist(), rough, limit):
                    at = np.flatnonzero(row <= most)
                    exact = np.sqrt(((vectors[at] - asked[q]) ** 2).sum(1))
                    best = sorted((d, i) for d, e in zip(exact.tolist(), at.tolist()) for i in ids[e])[: k + 1]
                    for d, i in best:
                        for column_, x in zip(out, (h1[q], h2[q], i, d)):
                            column_.append(x)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(out, types)], names=["h1", "h2", "vec_id", "score"])

    return run


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v of the rows that take part, each once: of the most common length, finite and not zero."""
    rows = pick(vectors, id_col, vector_col).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = rows.where(F.col("vec_id").isNotNull() & whole & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0].d if lengths else 0)).select(
        "vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct()


def _digest() -> tuple[Column, Column]:
    return F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")


def _blocks(counts: DataFrame, block: int) -> dict[int, int]:
    """How many blocks each list has; one row for a list, so no more than there are centroids."""
    return {r.list: -(-r.n // block) for r in counts.collect()}


def _meet(filed: DataFrame, asked: DataFrame, entry_blocks: dict[int, int], settings: Settings) -> DataFrame:
    """The k + 1 nearest ids that each query finds in each block of the lists it reads."""
    asked = stored(asked)
    query_blocks = _blocks(asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")), settings.block)
    sizes = filed.sparkSession.createDataFrame(
        [(i, entry_blocks[i], query_blocks[i]) for i in entry_blocks if i in query_blocks], "list int, eb int, qb int")

    def dealt(df: DataFrame, mine: str, other: str) -> DataFrame:
        at = F.pmod(F.col("h1"), F.col(mine)).cast("int")
        cells = df.join(F.broadcast(sizes), "list").withColumn(mine, at)
        return cells.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    cell = ["list", "eb", "qb"]
    left, right = dealt(filed, "eb", "qb").groupBy(*cell), dealt(asked, "qb", "eb").groupBy(*cell)
    return left.cogroup(right).applyInArrow(_nearest(settings.k), FOUND).distinct()


def search(vectors: DataFrame, queries: Column, settings: Settings = Settings(), **names: str) -> DataFrame:
    """The k nearest rows by Euclidean distance for each row that ``queries`` (on vec_id) selects.

    Rows that are null, zero, or hold a null or non-finite component, and such of
    another length than most, take no part, nor do rows without id. Repeated rows count once. A
    query's candidates are all rows of other ids. Ties go to the smaller id. A query
    whose lists hold fewer than k candidates reads WIDER times as many, again and again
    until it has k or has read all lists, so it gets k if there are so many. One list
    holds everything up to ``list_rows`` vectors. An empty table gives none.

    Returns query_id, rank (from 1), vec_id, score (double distance).
    """
    spark, k = vectors.sparkSession, settings.k
    rows = stored(valid_vectors(vectors, **names))
    # Of equal vectors the k + 1 smallest ids; tasks cut theirs before the shuffle.
    order = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("nth", order).where(F.col("nth") <= k + 1)
    entries = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(*_digest(), "v", "ids"))
    n = entries.count()
    n_lists = max(1, min(settings.most_lists, -(-n // settings.list_rows)))
    share = min(1.0, n_lists * settings.sample_per_list / max(1, n))
    draw = F.pmod(F.col("h1"), F.lit(1_000_000)) / F.lit(1e6)
    sample = [np.array(r.v) for r in entries.where(draw < share).select("v").toLocalIterator()]
    sample = sample or [np.array(r.v) for r in entries.select("v").limit(1).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = Lists(CentroidGraph(balanced_centroids(np.array(sample), n_lists), settings), settings)
    own = rows.where(queries).select("vec_id", "v")
    filed = stored(entries.mapInArrow(lists.file, PLACED))
    entry_blocks = _blocks(filed.groupBy("list").agg(F.count(F.lit(1)).alias("n")), settings.block)
    asking = stored(own.select("v").distinct().select(*_digest(), "v"))
    least, every = settings.least_probes, []
    while True:
        found = stored(_meet(filed, asking.mapInArrow(lists.ask(least), ASKED), entry_blocks, settings))
        # Queries with fewer than k ids besides their own; they are asked anew, more widely.
        enough = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select("h1", "h2")
        every.append(found)
        if least >= len(lists.graph.centroids):
            break
        asking = stored(asking.join(enough, ["h1", "h2"], "left_anti").select("h1", "h2", "v"))
        if asking.isEmpty():
            break
        least *= WIDER
    found = reduce(DataFrame.unionAll, every).distinct()
    nearest = Window.partitionBy("h1", "h2").orderBy("score", "vec_id")
    top = found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k + 1).drop("nth")
    ids = own.select(F.col("vec_id").alias("query_id"), *_digest())
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        ids.join(top, ["h1", "h2"]).where("vec_id <> query_id").withColumn("rank", F.row_number().over(mine))
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
