"""Quality of documents from passages: multiple-instance learning with gated attention.

A document is a bag of passages of PASSAGE words; only documents have labels. Each passage is
encoded by how often bytes of each class, pairs of classes and hashed runs of three bytes stand
in it, and a layer of tanh units. Gated attention, ``softmax(w (tanh(h V) * sigmoid(h U)))``
over the passages of a document, weighs them; the weighted sum of the passages is scored. All
weights are learned together from the labels of documents. Tasks encode and score whole texts;
the fit itself is numpy over a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import BLANKS, LOWER, UPPER, as_bytes, column, pick, slices

#: Words of a passage, slots of hashed three-byte runs, bytes of text encoded at a time.
PASSAGE, SLOTS, SLICE = 64, 256, 1 << 20
RESULT = "doc_id long, score double, n_passages int, top_passage int, top_weight double"
ENCODED = "label double, n int, bag binary"


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """A coarse class (10) of each byte, and a fine one, in which each ASCII sign is a class of its own."""
    coarse = np.full(256, 6)
    for i, some in enumerate((" \t\x0b\x0c\r", "\n", LOWER, UPPER, "0123456789", ".,;:?!")):
        coarse[[ord(c) for c in some]] = i
    coarse[0xC0:], coarse[0x80:0xC0] = 7, 8
    coarse[[b for b in range(32) if chr(b) not in BLANKS] + [127]] = 9
    signs = [b for b in range(33, 127) if coarse[b] in (5, 6)]
    fine = coarse.copy()
    fine[signs] = 10 + np.arange(len(signs))
    return coarse, fine


_COARSE, _FINE = _classes()
_N_COARSE, _N_FINE = 10, int(_FINE.max()) + 1
_LOW = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.int32)
_BLANK = np.isin(np.arange(256), [ord(c) for c in BLANKS])
#: Numbers that describe a passage.
WIDTH = _N_FINE + _N_COARSE**2 + SLOTS + 1


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passages of all texts, one after another, as rows, and the number of each text's passages (one at least)."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    blank = _BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    words = np.bincount(doc, begins, len(texts)).astype(np.int64)
    sizes = np.maximum(1, -(-words // PASSAGE))
    nth = np.cumsum(begins) - (np.cumsum(words) - words)[doc] - 1
    at = (np.cumsum(sizes) - sizes)[doc] + np.maximum(nth, 0) // PASSAGE
    n = int(sizes.sum())

    def share(keys: np.ndarray, width: int) -> np.ndarray:
        counts = np.bincount(keys, minlength=n * width).reshape(n, width)
        # Roots of shares: a sign that is rare but there stands out.
        return np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True))).astype(np.float32)

    low = _LOW[data]
    runs = ((low[:-2] * 40503 + low[1:-1] * 30011 + low[2:] * 10007) >> 5) & (SLOTS - 1) if len(low) > 2 else low[:0]
    # The blank between two texts is of the first; a text without a word has nothing.
    some = (words > 0)[doc]

    def inside(more: int) -> np.ndarray:
        """Bytes with so many more of the same text after them."""
        n = max(0, len(doc) - more)
        return some[:n] & (doc[:n] == doc[more:])

    coarse = _COARSE[data]
    pair = coarse[:-1] * _N_COARSE + coarse[1:]
    length = np.log1p(np.bincount(at[some], minlength=n))[:, None].astype(np.float32)
    return np.concatenate([
        share(at[some] * _N_FINE + _FINE[data][some], _N_FINE),
        share((at[:-1] * _N_COARSE**2 + pair)[inside(1)], _N_COARSE**2),
        share((at[: len(runs)] * SLOTS + runs)[inside(2)], SLOTS), length], axis=1), sizes


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit; scoring has none."""

    #: Labelled documents that the fit takes, half of each label, and passages it takes of each, evenly spread.
    sample_rows: int = 4000
    sample_passages: int = 24
    hidden: int = 24
    gate: int = 12
    epochs: int = 25
    batch: int = 128
    rate: float = 0.01
    shrink: float = 1e-4
    seed: int = 13


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """The weights, with the forward pass over bags that stand one after another, and its gradient."""

    def __init__(self, settings: Settings, mean: np.ndarray, scale: np.ndarray, bias: float):
        rng = np.random.default_rng(settings.seed)

        def weights(a: int, *b: int) -> np.ndarray:
            return (rng.normal(size=(a, *b)) / np.sqrt(a)).astype(np.float32)

        self.mean, self.scale = mean.astype(np.float32), scale.astype(np.float32)
        self.w = {
            "encode": weights(WIDTH, settings.hidden), "shift": np.zeros(settings.hidden, np.float32),
            "tanh": weights(settings.hidden, settings.gate), "gate": weights(settings.hidden, settings.gate),
            "attend": weights(settings.gate), "out": weights(settings.hidden), "bias": np.array(bias, np.float32)}

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        w, first = self.w, np.cumsum(sizes) - sizes
        x = (x - self.mean) * self.scale
        h = np.tanh(x @ w["encode"] + w["shift"])
        t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        e = (t * g) @ w["attend"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), sizes))
        a = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(a[:, None] * h, first)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["out"] + w["bias"])}

    def gradient(self, f: dict[str, np.ndarray], sizes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean of the log loss."""
        w, first = self.w, np.cumsum(sizes) - sizes
        d = ((f["p"] - label) * weight / weight.sum()).astype(np.float32)
        dz = np.repeat(d, sizes)[:, None] * w["out"]
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), sizes))
        dt = de[:, None] * w["attend"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * w["attend"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"encode": f["x"].T @ dx, "shift": dx.sum(0), "tanh": f["h"].T @ dt, "gate": f["h"].T @ dg,
                "attend": (f["t"] * f["g"]).T @ de, "out": f["z"].T @ d, "bias": d.sum()}

    def fit(self, bags: list[np.ndarray], label: np.ndarray, weight: np.ndarray, settings: Settings) -> "Attention":
        """Adam over shuffled batches of bags."""
        rng, step = np.random.default_rng(settings.seed), 0
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        for _ in range(settings.epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), settings.batch):
                some = order[i : i + settings.batch]
                sizes = np.array([len(bags[j]) for j in some])
                f = self.forward(np.concatenate([bags[j] for j in some]), sizes)
                step += 1
                for k, d in self.gradient(f, sizes, label[some], weight[some]).items():
                    d = d + settings.shrink * self.w[k] * (k != "bias")
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d**2
                    self.w[k] = self.w[k] - settings.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _bags(most: int):
    """mapInArrow function: label, and passages of each text as bytes of float32, ``most`` at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            rows, sizes = encode([t or b"" for t in as_bytes(batch)])
            out, n, first = [], [], 0
            for size in sizes.tolist():
                take = np.arange(size) if size <= most else np.linspace(0, size - 1, most).astype(np.int64)
                out.append(rows[first + take].tobytes())
                n.append(len(take))
                first += size
            yield pa.RecordBatch.from_arrays(
                [column(batch, "label"), pa.array(n, pa.int32()), pa.array(out, pa.binary())], names=["label", "n", "bag"])

    return run


def held_out(doc_id: Column) -> Column:
    """Documents whose labels the fit may not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Attention | float:
    """Learn from ``labels`` (doc_id, quality 0 or 1) of documents that are not held out.

    Ids with several labels count with the more frequent one, with 1 in a tie; other values and
    nulls are no labels. ``sample_rows / 2`` ids of each label are taken, those with the least
    hashes, and weigh as much as all with that label. Only these ids are looked up in ``docs``.
    With one label alone, or none, the score is the share of ones (0.5 without any) for all.
    """
    known = pick(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    known = known.where(~held_out(F.col("id")))
    n = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = settings.sample_rows // 2
    some = [known.where(F.col("label") == x).orderBy(F.xxhash64("id"), "id").limit(half) for x in (0.0, 1.0)]
    # At most sample_rows ids are sent.
    ids = docs.sparkSession.createDataFrame([tuple(r) for s in some for r in s.collect()], "id long, label double")
    rows = pick(docs, "doc_id", "text").join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("id"))
    taken = rows.select("label", "text").mapInArrow(_bags(settings.sample_passages), ENCODED)
    # Repeated ids could be many documents: the bound holds for them too.
    taken = taken.orderBy(F.xxhash64("bag"), "label").limit(2 * settings.sample_rows).collect()
    label = np.array([r.label for r in taken])
    if len(set(label.tolist())) < 2:
        return n.get(1.0, 0) / sum(n.values()) if n else 0.5
    bags = [np.frombuffer(r.bag, np.float32).reshape(r.n, WIDTH) for r in taken]
    weight = np.where(label == 1, n[1.0] / (label == 1).sum(), n[0.0] / (label == 0).sum())
    every = np.concatenate(bags)
    model = Attention(settings, every.mean(0), 1 / (every.std(0) + 0.05), float(np.log(n[1.0] / n[0.0])))
    return model.fit(bags, label, weight, settings)


def scorer(model: Attention | float):
    """mapInArrow function: scores of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            rows, sizes = encode([t or b"" for t in as_bytes(batch)])
            first = np.cumsum(sizes) - sizes
            if isinstance(model, float):
                score, weight = np.full(len(sizes), model), np.repeat(1 / sizes, sizes)
            else:
                done = model.forward(rows, sizes)
                score, weight = done["p"].astype(float), done["a"].astype(float)
            most = np.maximum.reduceat(weight, first)
            hits = np.flatnonzero(weight == np.repeat(most, sizes))
            top = hits[np.searchsorted(hits, first)] - first
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.round(score, 6)), pa.array(sizes.astype(np.int32)), pa.array(top.astype(np.int32)),
                 pa.array(np.round(most, 6))], names=["doc_id", "score", "n_passages", "top_passage", "top_weight"])

    return run


def score_quality(docs: DataFrame, model: Attention | float) -> DataFrame:
    """How likely each whole text has label 1, from its passages alone.

    Null and empty texts, and those of blanks, are one passage without anything in it. Every
    row is scored, repeated rows alike; ids may be null; other columns are left out; of equal
    weights the first passage is the top one; an empty table gives none.

    Returns doc_id, score (0 to 1), n_passages, top_passage (from 0, the one with the most
    attention) and top_weight, its share of the attention.
    """
    rows = pick(docs, "doc_id", "text")
    return rows.select(rows["doc_id"].cast("long"), "text").mapInArrow(scorer(model), RESULT)
