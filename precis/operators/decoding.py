"""Next-token probabilities, greedy and beam decoding.

The next id depends on the last one by a corpus table P(next | previous), mixed
with the successors that the text itself has: ``(1 - share) * P + share * P_text``.
Only ids that follow the last one in the text, and the few best of the corpus, can
be among the best of the mix, so a text brings its own rows, as many as it has
words, and the corpus a table bounded by the vocabulary, whose size is checked before
it is sent. All steps of a text then run in one task, without a join or a checkpoint
for each, and all texts of a batch take each step together in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.sequences import add_markers
from precis.operators.lookup import Sized, lookup
from precis.operators.rows import unroll
from precis.settings import DEFAULTS, END, PAD, START, UNK, Settings
from precis.sources.storage import cut_lineage

TINY = 1e-10
#: Bytes of a row of successors.
ROW_BYTES = 16
DECODED = "doc_id {0}, seq array<int>, score double, done boolean"


def next_token_table(samples: DataFrame) -> DataFrame:
    """``(prev, next, p)`` from teacher-forced pairs; PAD targets left out.

    Counts are combined map-side; after that a previous id has at most one row
    per vocabulary word.
    """
    pairs = samples.select(
        F.inline_outer(
            F.arrays_zip(
                F.col("decoder_in").alias("prev"), F.col("decoder_target").alias("next")
            )
        )
    ).where(F.col("next") != PAD)
    counts = pairs.groupBy("prev", "next").agg(F.count("*").alias("c"))
    total = F.sum("c").over(Window.partitionBy("prev"))
    return counts.select("prev", "next", (F.col("c").cast("double") / total).alias("p"))


def best_next(probs: DataFrame) -> DataFrame:
    """The most likely next id of each id; ties go to the lowest id."""
    order = Window.partitionBy("prev").orderBy(F.desc("p"), F.asc("next"))
    return probs.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")


def top_next(probs: DataFrame, k: int) -> DataFrame:
    """The k most likely next ids of each id; of equals the highest are kept."""
    order = Window.partitionBy("prev").orderBy(F.desc("p"), F.desc("next"))
    return probs.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def beam_step(hyps: DataFrame, probs: DataFrame, k: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Expand every open hypothesis by its k best ids, keep k per document.

    ``hyps`` is ``(doc_id, hyp_id, seq, score, done)``; ``hyp_id`` is the rank
    in the beam. Finished hypotheses are carried. Ties keep the order of the
    beam, then the lower id. A sequence without a known continuation stays.
    """
    # One row for each id, so that an id that many hypotheses end in is a hot key
    # of the lookup like any other; its weight is how often rows would meet it.
    choices = Sized.store(
        top_next(probs, k).groupBy("prev").agg(F.collect_list(F.struct("next", "p")).alias("choices")), "prev")
    last_open = F.when(~F.col("done"), F.element_at("seq", -1)).alias("prev")
    weight = F.when(F.col("prev") == START, 2).otherwise(1)
    found = lookup(hyps.select("*", last_open), choices, weight, settings)
    grown = found.select("*", F.explode_outer("choices").alias("choice"))
    step, extended = F.col("choice.next"), F.col("choice").isNotNull()
    candidates = grown.select(
        "doc_id", "hyp_id", step.alias("next"),
        F.when(extended, F.concat("seq", F.array(step))).otherwise(F.col("seq")).alias("seq"),
        (F.col("score") + F.when(extended, F.log(F.col("choice.p") + TINY)).otherwise(0.0)).alias("score"),
        (F.col("done") | ~extended | F.coalesce(step == END, F.lit(False))).alias("done"),
    )
    order = Window.partitionBy("doc_id").orderBy(F.round("score", 10).desc(), "hyp_id", "next")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("doc_id", F.col("rank").alias("hyp_id"), "seq", "score", "done")


def text_successors(texts: DataFrame, probs: DataFrame, share: float = DEFAULTS.text_share) -> DataFrame:
    """``(doc_id, own)``: for every two ids that follow each other in a text their mixed probability.

    ``texts`` is ``(doc_id, ids)`` with unique keys, ids of the whole text; START and END
    are put around them. An unknown word follows nothing. Counts combine before
    the shuffle; a pair of ids that is frequent in the corpus is one row for each text.
    """
    marked = texts.select("doc_id", add_markers("ids").alias("ids"))
    steps = marked.select("doc_id", F.explode_outer(F.arrays_zip(
        F.slice("ids", 1, F.size("ids") - 1).alias("prev"), F.slice("ids", 2, F.size("ids") - 1).alias("next"))).alias("s"))
    pairs = steps.select("doc_id", "s.prev", "s.next").where(F.col("next") != UNK)
    counts = pairs.groupBy("doc_id", "prev", "next").agg(F.count("*").alias("c"))
    total = F.sum("c").over(Window.partitionBy("doc_id", "prev"))
    mine = counts.withColumn("mine", F.col("c").cast("double") / total)
    known = mine.join(probs, ["prev", "next"], "left")
    p = (1 - share) * F.coalesce("p", F.lit(0.0)) + share * F.col("mine")
    return known.groupBy("doc_id").agg(
        F.collect_list(F.struct("prev", "next", p.alias("p"))).alias("own"))


class Successors:
    """The k best next ids of each key, best first, as tables of k columns; -1 where there are fewer.

    Of equal ones the highest ids are kept, or the lowest.
    """

    def __init__(self, keys: np.ndarray, ids: np.ndarray, p: np.ndarray, k: int, high: bool):
        order = np.lexsort((-ids if high else ids, -p, keys))
        keys, ids, p = keys[order], ids[order], p[order]
        self.keys, first, sizes = np.unique(keys, return_index=True, return_counts=True)
        nth = np.arange(len(keys)) - np.repeat(first, sizes)
        row, good = np.repeat(np.arange(len(first)), sizes), nth < k
        self.ids, self.p = np.full((len(first) + 1, k), -1, np.int64), np.zeros((len(first) + 1, k))
        self.ids[row[good], nth[good]], self.p[row[good], nth[good]] = ids[good], p[good]

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key; the last row, which is empty, for keys without one."""
        if not len(self.keys):
            return np.zeros(keys.shape, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, len(self.keys))


def mixed_successors(own: pa.Array, corpus: Successors, size: int, high: bool) -> Successors:
    """The best next ids by text and last id (key: text * size + id), where the text has some of its own.

    A text's own rows have the corpus in them already; the corpus adds the ids that the text lacks.
    """
    lists, flat = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), own.flatten()
    prev, ids, p = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    keys = np.repeat(np.arange(len(lists)), lists) * size + prev
    k = corpus.ids.shape[1]
    once = np.unique(keys)
    at = corpus.rows(once % size)
    more_keys, more_ids, more_p = np.repeat(once, k), corpus.ids[at].ravel(), corpus.p[at].ravel()
    fresh = (more_ids >= 0) & ~np.isin(more_keys * size + more_ids, keys * size + ids)
    return Successors(
        np.concatenate([keys, more_keys[fresh]]), np.concatenate([ids, more_ids[fresh]]).astype(np.int64),
        np.concatenate([p, more_p[fresh]]), k, high)


def paths(own: pa.Array, corpus: Successors, size: int, max_steps: int, high: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The best of k hypotheses of each text: ids (rows are cut at their lengths), lengths, score, done.

    Ties are as in ``beam_step``; with k = 1 this is greedy decoding.
    """
    mixed, k = mixed_successors(own, corpus, size, high), corpus.ids.shape[1]
    out = np.full((len(own), max_steps + 1), -1, np.int64)
    out_length, out_score, out_done = np.ones(len(own), np.int64), np.zeros(len(own)), np.zeros(len(own), bool)
    text = np.arange(len(own))
    seq = np.full((len(own), k, max_steps + 1), -1, np.int32)
    seq[:, :, 0] = START
    length = np.ones((len(own), k), np.int64)
    score, real, done = np.zeros((len(own), k)), np.zeros((len(own), k), bool), np.zeros((len(own), k), bool)
    real[:, 0] = True

    def finish(some: np.ndarray) -> None:
        t = text[some]
        out[t], out_length[t], out_score[t], out_done[t] = seq[some, 0], length[some, 0], score[some, 0], done[some, 0]

    place = np.repeat(np.arange(k), k + 1)
    for _ in range(max_steps):
        if not len(text):
            break
        last = np.take_along_axis(seq, length[:, :, None] - 1, 2)[:, :, 0].astype(np.int64)
        mine, common = mixed.rows(text[:, None] * size + last), corpus.rows(last)
        has = (mine < len(mixed.keys))[:, :, None]
        ids, p = np.where(has, mixed.ids[mine], corpus.ids[common]), np.where(has, mixed.p[mine], corpus.p[common])
        ids = np.where((real & ~done)[:, :, None], ids, -1)
        # What cannot go on stays as it is, as a candidate without a further id.
        stays = real & (ids < 0).all(2)
        ids = np.concatenate([ids, np.full((*stays.shape, 1), -1)], 2).reshape(len(text), -1)
        grown = np.concatenate([score[:, :, None] + np.log(p + TINY), score[:, :, None]], 2).reshape(len(text), -1)
        good = (ids >= 0) | np.concatenate([np.zeros((*p.shape,), bool), stays[:, :, None]], 2).reshape(len(text), -1)
        rank = np.where(good, -np.round(grown, 10), np.inf)
        best = np.lexsort((ids, np.broadcast_to(place, ids.shape), rank), axis=1)[:, :k]
        real, parent, ids, score = (np.take_along_axis(x, best, 1) for x in (good, np.broadcast_to(place, ids.shape), ids, grown))
        seq = np.take_along_axis(seq, parent[:, :, None], 1)
        length, done = np.take_along_axis(length, parent, 1), np.take_along_axis(done, parent, 1)
        t, h = np.nonzero(real & (ids >= 0))
        seq[t, h, length[t, h]] = ids[t, h]
        length[t, h] += 1
        done |= (ids < 0) | (ids == END)
        over = (done | ~real).all(1)
        finish(over)
        text, seq, length, score, real, done = (x[~over] for x in (text, seq, length, score, real, done))
    finish(np.ones(len(text), bool))
    return out, out_length, out_score, out_done


@dataclass(frozen=True)
class NextTokens:
    """A stored next-token table: the stand-in for a trained decoder."""

    probs: DataFrame

    @staticmethod
    def fit(samples: DataFrame) -> "NextTokens":
        return NextTokens(cut_lineage(next_token_table(samples)))

    def predict(self, samples: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
        """``(doc_id, predicted)``: the most likely next id at every position.

        Positions without a known continuation, padding above all, get PAD. The
        table looked up has one row for each id of the vocabulary.
        """
        rows = unroll(samples.select("doc_id", "decoder_in").repartition("doc_id"),
                      ["doc_id"], "decoder_in", item="prev", keep_empty=True)
        best = Sized.store(best_next(self.probs).drop("p"), "prev")
        return (
            lookup(rows, best, F.lit(1), settings)
            .groupBy("doc_id")
            .agg(
                F.sort_array(
                    F.collect_list(
                        F.when(
                            F.col("pos").isNotNull(),
                            F.struct("pos", F.coalesce("next", F.lit(PAD)).alias("next")),
                        )
                    )
                ).alias("found")
            )
            .select("doc_id", F.col("found").getField("next").alias("predicted"))
        )

    def greedy(
        self,
        texts: DataFrame,
        max_steps: int = DEFAULTS.max_summary_length,
        share: float = DEFAULTS.text_share,
    ) -> DataFrame:
        """Greedy decoding of whole encoded texts ``(doc_id, ids)``: ``(doc_id, seq, score, done)``."""
        return self._decode(texts, best_next(self.probs), share, 1, max_steps, high=False)

    def beam_search(
        self,
        texts: DataFrame,
        k: int = DEFAULTS.beam_width,
        max_steps: int = DEFAULTS.max_summary_length,
        share: float = DEFAULTS.text_share,
    ) -> DataFrame:
        """Beam search of width k for whole encoded texts; the best sequence of each."""
        return self._decode(texts, top_next(self.probs, k), share, k, max_steps, high=True)

    def _decode(self, texts: DataFrame, corpus: DataFrame, share: float, k: int, max_steps: int, high: bool) -> DataFrame:
        # At most k rows for each word of the vocabulary, whatever the corpus; no more are read than may be sent.
        most = DEFAULTS.broadcast_bytes // ROW_BYTES
        table = corpus.select(F.col("prev").cast("int"), F.col("next").cast("int"), "p").limit(most + 1).toArrow()
        if table.num_rows > most:
            raise ValueError(f"more than {most} rows of successors; use fewer words or a narrower beam")
        prev, ids, p = (table.column(i).to_numpy() for i in range(3))
        sent = texts.sparkSession.sparkContext.broadcast((prev, ids, (1 - share) * p))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common = Successors(*(x.astype(np.int64) for x in sent.value[:2]), sent.value[2], k, high)
            for batch in batches:
                own = batch.column(1)
                size = 1 + max(START, END, *(int(x.max(initial=0)) for x in (sent.value[0], sent.value[1])), *(
                    int(own.flatten().field(i).to_numpy(zero_copy_only=False).max(initial=0)) for i in (0, 1)))
                seq, length, score, done = paths(own, common, size, max_steps, high)
                # Greedy decoding leaves out the END that it reaches.
                length = length - (seq[np.arange(len(seq)), length - 1] == END) if k == 1 and not high else length
                offsets = pa.array(np.append(0, np.cumsum(length)).astype(np.int32))
                flat = pa.array(seq[np.arange(seq.shape[1]) < length[:, None]].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(offsets, flat), pa.array(score), pa.array(done)],
                    names=["doc_id", "seq", "score", "done"])

        key = next(f.dataType.simpleString() for f in texts.schema if f.name == "doc_id")
        return text_successors(texts, self.probs, share).mapInArrow(run, DECODED.format(key))
