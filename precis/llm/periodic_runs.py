"""Find periodic runs of words, the stretches that repeat with some period, by seeds on diagonals.

A run of period q and length L is a stretch of L - q places whose words equal those q
places further on (lag q). As L is ``LEAST`` and 2 q at least, that overlap has GRAM words
or more, so each run shows as two occurrences of one run of GRAM words at distance q:

* the GRAM-grams of a text that stand in it twice or more are an index, sorted by gram and place;
* lags are taken in doubling ranges; in a range whose overlaps have m words, only every
  (m - GRAM + 1)th place asks the index for partners, so a range costs no more pairs than
  twice the words, however often a gram repeats;
* an extension at a lag goes no further than the next seed of that lag, from where the next one
  goes on, and a seed within a known run whose period divides the lag is skipped: no word is
  compared twice at a lag, and multiples of a period are not followed.

Words are compared by number, never by hash; hashes only bring grams together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import FACTOR, as_bytes, column, mixed, pick, slices

#: Least length of a run, and of the overlap of a run with itself one period on.
LEAST, GRAM = 12, 6
#: Cells of words that one comparison step may take.
CELLS = 1 << 21
RESULT = "doc_id long, n_words int, runs array<struct<start:int,length:int,period:int>>, text string"


def _extent(words: np.ndarray, i: np.ndarray, j: np.ndarray, step: int, limit: np.ndarray) -> np.ndarray:
    """How many words from places i and j on, forwards or backwards, are equal; ``limit`` at most.

    The words begin and end with numbers that no other place has.
    """
    n, live, last, width = np.zeros(len(i), np.int64), np.arange(len(i)), len(words) - 1, 8
    while len(live):
        whole = []
        for part in np.array_split(live, 1 + len(live) * width // CELLS):
            at = (n[part, None] + np.arange(width)) * step
            same = words[np.clip(i[part, None] + at, 0, last)] == words[np.clip(j[part, None] + at, 0, last)]
            run = np.where(same.all(1), width, same.argmin(1))
            n[part] = np.minimum(n[part] + run, limit[part])
            whole.append(part[(run == width) & (n[part] < limit[part])])
        live, width = np.concatenate(whole), min(2 * width, 4096)
    return n


def _repeated_grams(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number and place of each gram that its own text has twice or more, by group and place."""
    n = len(words) - GRAM + 1
    key = owner[:n].astype(np.uint64)
    for k in range(GRAM):
        key = key * np.uint64(FACTOR) + mixed(words[k : k + n].astype(np.uint64))
    key = mixed(key)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    return group[many], order[many]


def _ranges(longest: int) -> Iterator[tuple[int, int, int]]:
    """Lags from, to (exclusive) and the distance of seeds; an overlap of each lag holds a seed."""
    for q in range(1, LEAST):
        yield q, q + 1, max(LEAST - q, q) - GRAM + 1
    low = LEAST
    while low <= longest // 2:
        yield low, 2 * low, low - GRAM + 1
        low *= 2


def find_runs(words: np.ndarray, owner: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and period of all runs, by start and period.

    Texts stand one after another in ``words``, with a number that nothing equals before
    each and at the end; ``owner`` is the text of each place, ``longest`` the most words of one.
    """
    if longest < LEAST:
        return tuple(np.empty((3, 0), np.int64))
    group, place = _repeated_grams(words, owner)
    stride = 2 * len(words) + 2
    code = group * stride + place
    far_end, far_period = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    found = [np.empty((3, 0), np.int64)]
    for low, high, apart in _ranges(longest):
        seed = np.flatnonzero(place % apart == 0)
        first, after = np.searchsorted(code, code[seed] + low), np.searchsorted(code, code[seed] + high)
        count = after - first
        a = np.repeat(place[seed], count)
        b = place[np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(a))]
        # Within a run of period p, a lag that is a multiple of p shows that run again.
        fresh = (far_end[a] < b + GRAM) | ((b - a) % far_period[a] != 0)
        a, lag = a[fresh], (b - a)[fresh]
        if not len(a):
            continue
        order = np.lexsort((a, lag, owner[a]))
        a, lag = a[order], lag[order]
        # The next seed of the same text and lag bounds an extension.
        near = (owner[a[1:]] == owner[a[:-1]]) & (lag[1:] == lag[:-1])
        limit = np.full(len(a), len(words), np.int64)
        limit[:-1][near] = (a[1:] - a[:-1])[near]
        ahead = _extent(words, a, a + lag, 1, limit)
        joined = np.zeros(len(a), bool)
        joined[1:] = near & (ahead == limit)[:-1]
        # A chain is one stretch; its first seed is followed back, its last one tells the end.
        heads = np.flatnonzero(~joined)
        tails = np.append(heads[1:], len(a)) - 1
        back = _extent(words, a[heads] - 1, a[heads] + lag[heads] - 1, -1, np.full(len(heads), len(words)))
        lag, start, end = lag[heads], a[heads] - back, a[tails] + ahead[tails] + lag[heads]
        long = end - start >= np.maximum(LEAST, 2 * lag)
        start, end, lag = start[long], end[long], lag[long]
        found.append(np.stack([start, end, lag]))
        for s, e, q in zip(start.tolist(), end.tolist(), lag.tolist()):
            if e - s >= high + GRAM:
                further = far_end[s:e] < e
                far_end[s:e][further], far_period[s:e][further] = e, q
    start, end, lag = np.concatenate(found, axis=1)
    # The same stretch under a multiple of its smallest period is no further run.
    order = np.lexsort((lag, end, start))
    start, end, lag = start[order], end[order], lag[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, lag = start[new], end[new], lag[new]
    order = np.lexsort((lag, start))
    return start[order], end[order], lag[order]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [(t or b"").split() for t in as_bytes(batch)]
        sizes = np.array([len(t) for t in texts])
        number: dict[bytes, int] = {}
        words = np.full(sizes.sum() + len(texts) + 1, 0, np.int64)
        # Places before and after texts are different from all others.
        firsts = np.cumsum(sizes + 1) - sizes
        edges = np.append(firsts - 1, len(words) - 1)
        inner = np.ones(len(words), bool)
        inner[edges] = False
        words[edges] = -1 - np.arange(len(edges))
        words[inner] = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, sizes.sum())
        owner = np.cumsum(~inner) - 1
        start, end, period = find_runs(words, owner, int(sizes.max(initial=0)))
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, end, -1)
        kept = np.cumsum(gone)[:-1] == 0
        out = []
        for t, a in zip(texts, firsts.tolist()):
            mine = kept[a : a + len(t)]
            out.append(b" ".join(t if mine.all() else [w for w, k in zip(t, mine.tolist()) if k]))
        own = owner[start]
        offsets = np.searchsorted(own, np.arange(len(texts) + 1)).astype(np.int32)
        struct = pa.StructArray.from_arrays(
            [pa.array(x.astype(np.int32)) for x in (start - firsts[own], end - start, period)], names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), struct),
             pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "text"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The runs of each whole text, and the text with each run cut to its first period.

    Words are the stretches without ASCII blanks. A run is a stretch of consecutive words with
    smallest period q (words q apart are equal) of ``LEAST`` and 2 q words at least, which the
    word before or after it would not continue with period q. Runs may overlap; they come by
    start, then period, and equal start and period cannot be. A word goes if it stands after
    the first q words of some run; the others are joined by one blank.

    Null, empty and short texts have no runs; a null text gives an empty one. Each row has its
    result, repeated rows and null ids too; other columns are left out; an empty table gives none.
    A text is handled whole in the task that reads it, in memory in proportion to its size.

    Returns doc_id, n_words, runs (array of start, length, period), text.
    """
    rows = pick(docs, "doc_id", "text")
    return rows.select(rows["doc_id"].cast("long"), "text").mapInArrow(_scan, RESULT)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts (by crc32 of doc_id) made periodic from some word on.

    With h = crc32 of the decimal doc_id, g = floor(h / 10) and n words, texts with h divisible
    by 10 have from word a = g % n on the words a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)),
    joined by blanks. All other texts, and those without words or doc_id, stay as they are.
    """
    rows = pick(docs, "doc_id", "text")
    rows = rows.select(rows["doc_id"].cast("long"), "text").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    g = F.floor(F.col("h") / 10)

    def periodic(words):
        n = F.size(words).cast("long")
        # Each number is bound by a list of one, so that it is computed once a text and not once a word.
        return F.flatten(F.transform(F.array(F.struct(n.alias("n"), (g % n).alias("a"))), lambda x: F.transform(
            F.array(1 + F.floor((x["n"] - x["a"]) / (3 + g % 8))),
            lambda p: F.array_join(F.transform(words, lambda w, i: F.when(
                i >= x["a"], F.get(words, (x["a"] + (i - x["a"]) % p).cast("int"))).otherwise(w)), " "))))

    split = F.array(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != ""))
    made = F.flatten(F.transform(split, lambda words: F.when(F.size(words) > 0, periodic(words))))
    text = F.when(F.col("h") % 10 == 0, F.coalesce(F.get(made, 0), "text")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
