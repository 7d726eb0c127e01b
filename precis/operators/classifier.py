"""A sentence classifier trained by rounds of distributed gradient steps.

A sentence is the hashed slots of its words; its score is the logistic of a bias and the
words' weights, scaled by the root of their number. Each round is one pass over the stored
features: tasks sum the gradient of the cross-entropy over their rows, some further tasks add
those sums up, and the driver adds what is left and takes the step by one of three rules.
Losses and accuracies of both parts come from the same pass and are written as they come,
as is each model that is the best so far on the validation part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions.text import tokens
from precis.operators.splits import TRAIN
from precis.sources.storage import scratch_path

#: Partial sums that the driver adds up itself; more are added by tasks first.
FEW = 16
SUMS = "bucket int, part int, gradient binary, n double, loss double, hits double, val_n double, val_loss double, val_hits double"
HISTORY = "epoch int, loss double, val_loss double, accuracy double, val_accuracy double, rate double"
SCORED = "doc_id {0}, idx int, score double"
# The constants of the update rules.
DECAY, DECAY_SQUARE, RMS_DECAY, EPSILON = 0.9, 0.999, 0.9, 1e-7


@dataclass(frozen=True)
class Training:
    """How a fit runs. ``rule`` is adam, rmsprop or sgd."""

    slots: int = 1 << 16
    rule: str = "adam"
    rate: float = 0.1
    # Most rounds, rounds without a better validation loss before the fit stops or
    # the rate falls, what counts as better, by how much the rate falls and to where.
    rounds: int = 50
    patience: int = 5
    min_delta: float = 0.001
    rate_patience: int = 3
    rate_factor: float = 0.5
    least_rate: float = 1e-7


def word_slots(sentence: Column | str, slots: int) -> Column:
    """The slot of each word of a sentence, by 32 bits of its MD5."""
    return F.transform(tokens(sentence), lambda w: F.pmod(
        F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int"))


class Rule:
    """One of the update rules, with what it remembers of earlier gradients."""

    def __init__(self, name: str, size: int):
        if name not in ("adam", "rmsprop", "sgd"):
            raise ValueError(f"unknown rule {name!r}; adam, rmsprop and sgd are known")
        self.name, self.steps = name, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, gradient: np.ndarray, rate: float) -> np.ndarray:
        """What to take off the weights."""
        self.steps += 1
        if self.name == "sgd":
            return rate * gradient
        if self.name == "rmsprop":
            self.square = RMS_DECAY * self.square + (1 - RMS_DECAY) * gradient**2
            return rate * gradient / (np.sqrt(self.square) + EPSILON)
        self.mean = DECAY * self.mean + (1 - DECAY) * gradient
        self.square = DECAY_SQUARE * self.square + (1 - DECAY_SQUARE) * gradient**2
        mean, square = self.mean / (1 - DECAY**self.steps), self.square / (1 - DECAY_SQUARE**self.steps)
        return rate * mean / (np.sqrt(square) + EPSILON)


def _margins(lists: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Margins of sentences; and the slots, sizes and scales of their words. The last weight is the bias."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    scale = 1 / np.sqrt(np.maximum(1, sizes))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return weights[-1] + scale * np.bincount(owner, weights[flat], len(sizes)), flat, sizes, scale


def _partial(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums over a task's sentences."""
    gradient, sums = np.zeros(len(weights)), np.zeros(6)
    for batch in batches:
        y, seen = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        seen = seen.astype(bool)
        z, flat, sizes, scale = _margins(batch.column(0), weights)
        loss, hit = np.logaddexp(0, np.where(y == 1, -z, z)), (z > 0) == (y == 1)
        for i, some in enumerate((seen, ~seen)):
            sums[3 * i : 3 * i + 3] += some.sum(), loss[some].sum(), hit[some].sum()
        d = np.where(seen, 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y, 0.0)
        gradient[:-1] += np.bincount(flat, np.repeat(d * scale, sizes), len(weights) - 1)
        gradient[-1] += d.sum()
    return gradient, sums


def _row(bucket: int, part: int, gradient: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    values = [bucket, part, gradient.tobytes(), *sums.tolist()]
    names = [f.split()[0] for f in SUMS.split(", ")]
    types = [pa.int32(), pa.int32(), pa.binary(), *[pa.float64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)


def _added(table: pa.Table) -> pa.Table:
    """The sums of a bucket, added in the order of their parts."""
    table = table.sort_by("part")
    gradient = sum(np.frombuffer(b.as_py()) for b in table.column("gradient"))
    sums = np.array([sum(table.column(i).to_pylist()) for i in range(3, 9)])
    return pa.Table.from_batches([_row(table.column("bucket")[0].as_py(), table.column("part")[0].as_py(), gradient, sums)])


def sums_over(features: DataFrame, n_parts: int, weights: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Gradient summed over training sentences; n, loss, hits of the training and of the validation part.

    The weights, 8 bytes a slot, are sent to all tasks; each task gives one vector of that size.
    """
    sent = features.sparkSession.sparkContext.broadcast(weights)
    buckets = n_parts if n_parts <= FEW else math.isqrt(n_parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId()
        yield _row(nth % buckets, nth, *_partial(batches, sent.value))

    partial = features.select("slots", "label", "train").mapInArrow(run, SUMS)
    if n_parts > FEW:
        partial = partial.groupBy("bucket").applyInArrow(_added, SUMS)
    gradient, sums = np.zeros(len(weights)), np.zeros(6)
    for row in sorted(partial.collect(), key=lambda r: r.part):
        gradient = gradient + np.frombuffer(row.gradient)
        sums = sums + np.array(row[3:])
    sent.destroy()
    return gradient, sums.tolist()


@dataclass(frozen=True)
class Classifier:
    """Weights of slots, the bias last; ``epoch`` is the round that they come from."""

    weights: np.ndarray
    epoch: int

    def save(self, spark: SparkSession, path: str) -> None:
        """One row in a folder of its own; the last one that is whole counts."""
        row = [(self.epoch, self.weights.tobytes())]
        spark.createDataFrame(row, "epoch int, weights binary").coalesce(1).write.mode("append").parquet(f"{path}/best")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Classifier":
        row = spark.read.parquet(f"{path}/best").orderBy(F.desc("epoch")).first()
        return Classifier(np.frombuffer(row.weights).copy(), row.epoch)

    def score(self, sentences: DataFrame) -> DataFrame:
        """``(doc_id, idx, score)`` of ``(doc_id, idx, sentence)``: the probability of label 1."""
        sent = sentences.sparkSession.sparkContext.broadcast(self.weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                z = _margins(batch.column(2), sent.value)[0]
                p = pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), p], names=["doc_id", "idx", "score"])

        kind = next(f.dataType.simpleString() for f in sentences.schema if f.name == "doc_id")
        slots = word_slots("sentence", len(self.weights) - 1).alias("slots")
        return sentences.select("doc_id", F.col("idx").cast("int"), slots).mapInArrow(run, SCORED.format(kind))


def history(spark: SparkSession, path: str) -> DataFrame:
    """The rounds of a fit so far, also while it runs."""
    return spark.read.schema(HISTORY).parquet(f"{path}/history")


def train(labelled: DataFrame, path: str, training: Training = Training()) -> Classifier:
    """Fit on ``(sentence, label, split)`` and give the best model.

    Labels are 1 and 0, rows with others take no part; a null or empty sentence has no words.
    Sentences whose split is ``train`` are learned from, all others are the validation part.
    After each round the losses and accuracies of both parts are appended to ``path``/history
    and, if the validation loss fell by ``min_delta``, the weights to ``path``/best. Without
    validation rows the training loss decides, and their columns are null. ``patience`` rounds
    without a better loss end the fit, ``rate_patience`` of them lower the rate. Without
    training rows the weights stay zero, after no round. ``path`` must be new.
    """
    spark = labelled.sparkSession
    where = scratch_path(spark, "features")
    labelled.where("label in (0, 1)").select(
        word_slots("sentence", training.slots).alias("slots"), F.col("label").cast("int").alias("label"),
        F.coalesce(F.col("split") == TRAIN, F.lit(False)).alias("train")).write.parquet(where)
    features = spark.read.schema("slots array<int>, label int, train boolean").parquet(where)
    n_parts = features.rdd.getNumPartitions()
    spark.createDataFrame([], HISTORY).write.parquet(f"{path}/history")

    weights, rule, rate = np.zeros(training.slots + 1), Rule(training.rule, training.slots + 1), training.rate
    best, least, waited, waited_rate, least_seen = Classifier(weights, 0), math.inf, 0, 0, math.inf
    gradient, sums = sums_over(features, n_parts, weights)
    for epoch in range(1, (training.rounds if sums[0] else 0) + 1):
        weights = weights - rule.step(gradient / sums[0], rate)
        # One pass gives what this round has reached and the next round's gradient.
        gradient, sums = sums_over(features, n_parts, weights)
        n, val_n = sums[0], sums[3]
        loss, val_loss = sums[1] / n, sums[4] / val_n if val_n else None
        row = epoch, loss, val_loss, sums[2] / n, sums[5] / val_n if val_n else None, rate
        spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("append").parquet(f"{path}/history")
        watched = loss if val_loss is None else val_loss
        if watched < least - training.min_delta:
            best, least, waited = Classifier(weights, epoch), watched, 0
            best.save(spark, path)
        else:
            waited += 1
        if watched < least_seen - 1e-4:
            least_seen, waited_rate = watched, 0
        else:
            waited_rate += 1
        if waited_rate >= training.rate_patience:
            rate, waited_rate = max(rate * training.rate_factor, training.least_rate), 0
        if waited >= training.patience:
            break
    if not best.epoch:
        best.save(spark, path)
    return best
