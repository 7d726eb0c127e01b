"""Languages of texts, word by word: scripts narrow the candidates, Viterbi labels the spans."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import KEY, Rolling, column, keyed, mixed, numbered, pick, restored, slices, stored

#: First code points of blocks and their script; a block ends where the next begins. Fixed values.
SCRIPTS = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x1900, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"), (0xFF21, "latin"),
    (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_WHICH = np.array([_NAMES.index(name) for _, name in SCRIPTS])



def _marks() -> str:
    """The code points that sit on the letter before them (vowel signs, accents), as ranges of a character class."""
    at = [c for c in range(0x300, 0x20000) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    ends = [i for i in range(len(at)) if i + 1 == len(at) or at[i + 1] != at[i] + 1]
    starts = [0, *(i + 1 for i in ends[:-1])]
    return "".join(f"{chr(at[a])}-{chr(at[b])}" for a, b in zip(starts, ends))


#: Runs of letters with the marks on them, and of signs for numbers such as superscripts, which go afterwards.
WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")
UNKNOWN = "und"
COUNTS = "lang string, slot int, n long"
FITS = "lang int, n double, m double, q double"
#: Numbers of the table of counts; with very many languages each gets fewer slots.
MOST_CELLS, LEAST_SLOTS = 1 << 25, 256
LABELS = ("doc_id long, k1 long, k2 long, lang_pred string, score double, "
          "spans array<struct<first:int,last:int,lang:string>>")


@dataclass(frozen=True)
class Settings:
    #: Labelled rows of a language to learn from, on average; a language with fewer gives all.
    rows_per_language: int = 4000
    #: Slots that pieces of words are hashed into; halved until the table of all languages has MOST_CELLS numbers.
    slots: int = 1 << 16
    #: Deviations, and natural logarithms besides, by which a text may fit its language worse than labelled ones.
    misfit: float = 6.0
    slack: float = 0.5
    #: What a change of language costs, in natural logarithms of probability.
    switch: float = 8.0
    #: Share of a language's words in a script from which the language is a candidate there.
    script_share: float = 0.005
    #: Words whose scores a task keeps.
    cache: int = 300_000


def pieces(words: list[str], slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the pieces of all words, where each word's begin, and each word's script.

    The pieces of a word are its runs of three letters, with marks at both ends, and
    the word itself. All words go through a few array operations together.
    """
    marked = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    scripts = _WHICH[np.searchsorted(_FIRST, code[starts + 1], side="right") - 1]
    run = code.copy()
    run[:-1] += code[1:] << np.uint64(21)
    run[:-2] += code[2:] << np.uint64(42)
    # A run of three begins at all places of a word but its last two; the
    # next to last has the word itself instead.
    run[ends - 2] = Rolling(code).of(starts, ends)
    at = np.ones(len(code), bool)
    at[ends - 1] = False
    return (mixed(run[at]) % np.uint64(slots)).astype(np.int64), starts - np.arange(len(words)), scripts


def counter_of(settings: Settings):
    """mapInArrow function: (lang, text) to counts of pieces; scripts have the slots after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words: dict[str, Counter[str]] = {}
            for lang, text in zip(column(batch, "lang").to_pylist(), column(batch, "text").to_pylist()):
                words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, own in words.items():
                if not own:
                    continue
                slot, starts, scripts = pieces(list(own), settings.slots)
                times = np.fromiter(own.values(), np.int64, len(own))
                each = np.repeat(times, np.diff([*starts, len(slot)]))
                counts = np.bincount(
                    np.concatenate([slot, settings.slots + scripts]), np.concatenate([each, times]),
                    settings.slots + len(_NAMES))
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()),
                    pa.array(counts[some].astype(np.int64)),
                ], names=["lang", "slot", "n"])

    return run


class Model:
    """Log probabilities of pieces by language, and the candidates of each script."""

    def __init__(self, languages: list[str], counts: np.ndarray, settings: Settings):
        self.languages, self.settings = languages, settings
        piece = counts[: settings.slots] + 0.1
        self.logs = np.log(piece / piece.sum(0)).astype(np.float32) if languages else piece
        scripts = counts[settings.slots :]
        share = scripts / np.maximum(scripts.sum(0), 1)
        self.candidates = share >= settings.script_share
        #: For each language the usual mean score of a text's different words, and its deviation for a single word.
        self.usual, self.spread = np.full(len(languages), -np.inf), np.zeros(len(languages))

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each word the scores by language, whether its script is one that a language is written in, and the plain scores.

        A score is the mean log probability of its pieces, scaled to two pieces.
        The best candidate has 0; languages not written in the word's script have 10
        less than the last candidate. In a strange script all have 0.
        """
        slot, starts, scripts = pieces(words, self.settings.slots)
        sizes = np.diff([*starts, len(slot)])
        score = 2 * np.add.reduceat(self.logs[slot], starts) / sizes[:, None]
        at = self.candidates[scripts]
        best = np.where(at, score, -np.inf).max(1, keepdims=True)
        last = np.where(at, score, np.inf).min(1, keepdims=True) - 10
        known = at.any(1, keepdims=True)
        with np.errstate(invalid="ignore"):
            return np.where(known, np.where(at, score, last) - best, 0.0).astype(np.float32), known[:, 0], score.astype(np.float32)

    def fits(self):
        """mapInArrow function: (lang, text) to the number of different words, and the means of their scores and squared scores."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = {x: i for i, x in enumerate(self.languages)}
            for batch in slices(batches):
                rows = []
                for name, text in zip(column(batch, "lang").to_pylist(), column(batch, "text").to_pylist()):
                    words = [w for w in set(WORD.findall(text.lower())) if any(map(str.isalpha, w))]
                    if words:
                        own = self.score(sorted(words))[2][:, place[name]].astype(float)
                        rows.append((place[name], len(words), own.mean(), (own**2).mean()))
                names = [x.split()[0] for x in FITS.split(", ")]
                kinds = [pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        return run

    def is_strange(self, plain: np.ndarray, labels: np.ndarray) -> bool:
        """Whether words with these plain scores fit the languages that they are labelled with worse than labelled texts do."""
        gap = (plain[np.arange(len(labels)), labels] - self.usual[labels]).mean()
        return gap < -self.settings.misfit * self.spread[labels].mean() / np.sqrt(len(labels)) - self.settings.slack

    def label(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return self._label(slices(batches))

    def keep(self, least: float, wanted: tuple[str, ...] | None, strangers: bool):
        """mapInArrow function that passes on the rows with ``least`` of their letters in a wanted language.

        With ``strangers`` letters of a strange script count for the language that their word is labelled with;
        without, also texts whose words do not fit the language go.
        """
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = []

            def seen() -> Iterator[pa.RecordBatch]:
                for part[:] in ([x] for x in slices(batches)):
                    yield part[0]

            for out in self._label(seen(), strangers, judge=not strangers):
                found = zip(column(out, "lang_pred").to_pylist(), column(out, "score").to_pylist())
                good = [x != UNKNOWN and s >= least and (wanted is None or x in wanted) and (strangers or not odd)
                        for (x, s), odd in zip(found, self.odd)]
                yield part[0].filter(pa.array(good, pa.bool_()))

        return run

    def _label(self, parts: Iterator[pa.RecordBatch], strangers: bool = False, judge: bool = False) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        scores, known = np.zeros((0, len(self.languages)), np.float32), np.zeros(0, bool)
        plain = scores
        for batch in parts:
            if len(cache) > self.settings.cache:
                cache, scores, known, plain = {}, scores[:0], known[:0], plain[:0]
            ids, letters, new = [], [], []
            for text in column(batch, "text").to_pylist():
                words = WORD.findall(text.lower()) if text and self.languages else []
                own, signs = set(words), set()
                for w in own.difference(cache):
                    if w.isalpha() or any(map(str.isalpha, w)):
                        cache[w] = len(cache)
                        new.append(w)
                    else:
                        signs.add(w)
                if signs:
                    words = [w for w in words if w not in signs]
                ids.append(np.fromiter(map(cache.__getitem__, words), np.int32, len(words)))
                letters.append(np.fromiter(map(len, words), np.int32, len(words)))
            sizes = np.array([len(x) for x in ids], np.int64)
            if new:
                scores, known, plain = (np.concatenate(x) for x in zip((scores, known, plain), self.score(new)))
            if sizes.any():
                labels = viterbi(scores, np.concatenate(ids), sizes, self.settings.switch)
            ends = np.cumsum(sizes)
            best, score, spans = [], [], []
            # Of each text of the batch: whether its words fit its language badly.
            self.odd: list[bool] = []
            for n, end, own, words in zip(sizes.tolist(), ends.tolist(), letters, ids):
                if not n:
                    best.append(UNKNOWN), score.append(0.0), spans.append([]), self.odd.append(True)
                    continue
                mine = labels[end - n : end]
                weight = np.bincount(mine, own if strangers else own * known[words], len(self.languages))
                top = int((weight if weight.any() else np.bincount(mine, own)).argmax())
                best.append(self.languages[top])
                if judge and known[words].any():
                    # Each word once for each language that it is labelled with.
                    once = np.unique(words[known[words]].astype(np.int64) * len(self.languages) + mine[known[words]])
                    once, label = np.divmod(once, len(self.languages))
                    self.odd.append(self.is_strange(plain[once], label))
                else:
                    self.odd.append(False)
                score.append(float(weight.max() / own.sum()))
                cuts = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), n]
                spans.append([{"first": a, "last": b - 1, "lang": self.languages[mine[a]]} for a, b in zip(cuts, cuts[1:])])
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id"), column(batch, "k1"), column(batch, "k2"), pa.array(best, pa.string()),
                pa.array(score, pa.float64()), pa.array(spans, pa.list_(pa.struct(
                    [("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))),
            ], names=["doc_id", "k1", "k2", "lang_pred", "score", "spans"])


def viterbi(table: np.ndarray, ids: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word; texts stand one after another in ``ids`` and go step by step together.

    Of equal paths the one with the earlier language, and with fewer changes, wins.
    """
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), side="left")
    stay = np.ones((len(ids), table.shape[1]), bool)
    best = np.zeros(len(ids), np.int16)
    total = np.zeros((len(sizes), table.shape[1]))
    rows = np.arange(len(sizes))
    for t in range(longest):
        n = live[t]
        at = starts[:n] + t
        now = total[:n]
        if t:
            top = now.argmax(1)
            other = now[rows[:n], top] - switch
            kept = now >= other[:, None]
            stay[at], best[at] = kept, top
            now = np.where(kept, now, other[:, None])
        total[:n] = now + table[ids[at]]
    labels = np.zeros(len(ids), np.int16)
    label = total.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        at = starts[:n] + t
        own = label[:n]
        labels[at] = own
        label[:n] = np.where(stay[at, own], own, best[at])
    return labels


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; also those without an id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn all languages from a sample of the labelled rows, chosen by a hash of doc_id and bounded by language."""
    rows = pick(docs, "doc_id", "text", "lang").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    chosen = {r.lang: min(1.0, settings.rows_per_language / r.n) for r in sizes}
    languages, slots = sorted(chosen), settings.slots
    while slots * len(languages) > MOST_CELLS and slots > LEAST_SLOTS:
        slots //= 2
    settings = replace(settings, slots=slots)
    counts = np.zeros((slots + len(_NAMES), len(languages)))
    if not languages:
        return Model(languages, counts, settings)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / F.lit(1e6)
    shares = docs.sparkSession.createDataFrame(list(chosen.items()), "lang string, share double")
    sample = stored(rows.join(F.broadcast(shares), "lang").where(draw < F.col("share")).select("lang", "text"))
    found = sample.mapInArrow(counter_of(settings), COUNTS).groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    # At most (slots + scripts) x languages numbers, whatever the corpus.
    place = {x: i for i, x in enumerate(languages)}
    which = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[found.column("slot").to_numpy(), which] = found.column("n").to_numpy()
    model = Model(languages, counts, settings)
    # How well labelled texts fit: means of scores, and how far single words deviate, or texts as if of single words.
    n, m = F.col("n"), F.col("m")
    for r in sample.mapInArrow(model.fits(), FITS).groupBy("lang").agg(
            F.avg("m").alias("m"), F.avg("n").alias("n"), F.avg(n * m).alias("nm"), F.avg(n * m * m).alias("nmm"),
            (F.sum(n * F.col("q")) / F.sum("n") - F.pow(F.sum(n * m) / F.sum("n"), 2)).alias("words")).collect():
        model.usual[r.lang] = r.m
        model.spread[r.lang] = np.sqrt(max(0.0, r.words, r.nmm - 2 * r.m * r.nm + r.m**2 * r.n))
    return model


def label_languages(docs: DataFrame, model: Model) -> DataFrame:
    """The language of every text and of its spans.

    Words are runs of letters with the marks on them. A word's script leaves the languages that are written
    in it; a word in a script that none was learned for fits all alike. Scores of
    words by language are joined by Viterbi with a price for each change. The
    text's language is the one with the most letters (of equals the first by name),
    its score the share of them in all letters. Letters of a word in a strange script
    are no language's: a text of such words alone has a learned language with score 0.
    A null text and one without letters are ``und``
    with score 0, and so is all if nothing could be learned. Repeated rows each have
    their result; an empty table gives none.

    Returns doc_id, k1, k2 (key of the row), lang_pred, score, spans (first and last
    word, counted from 0, and language).
    """
    return keyed(docs).select("doc_id", *KEY, "text").mapInArrow(model.label, LABELS)


def with_known_language(docs: DataFrame, model: Model, least: float = 0.5, wanted: tuple[str, ...] | None = None,
                        strangers: bool = True) -> DataFrame:
    """The rows of ``docs`` in a wanted language (any learned one by default), unchanged.

    A row goes if it has no letters, or no language has ``least`` of them. Letters of
    words in a script that no learned language uses count for the language that
    the word is labelled with, or without ``strangers`` for none. Without them a row
    also goes if its different words fit the languages that they are labelled with far
    worse than those of labelled rows, as a text in an unlearned language of a known
    script does; a text of several learned languages stays.
    """
    rows = numbered(docs)
    return restored(rows.mapInArrow(model.keep(least, wanted, strangers), rows.schema), docs)
