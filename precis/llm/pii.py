"""Personal data: exact patterns for four kinds, and a conditional random field that adds spans."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import column, keyed, pick, slices
from precis.llm.crf import Crf

KINDS = ("email", "ip", "card", "phone")
#: 0 is no personal data; then the first and the further words of each kind.
N_LABELS = 1 + 2 * len(KINDS)
Span = tuple[int, int, int]  # start, kind, end

# The patterns of the contract in forms that are linear on any text: a run of
# characters is taken whole, or not at all, wherever a shorter one could not help.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
# Signs that some kind contains, also in disguise, and those that none does; scripts without blanks.
_SIGNS = r"0-9._%+\-@()\[\]\uFF10-\uFF19\uFF20\uFF0B\uFF0D\uFF0E"
_OTHER = (r"!-$&'*,/:-?\\^`{-~\u00A1-\u00A9\u00AB-\u00B4\u00B6-\u00B9\u00BB-\u00BF\u00D7\u00F7"
          r"\u2010-\u206F\u3001-\u303F\uFF01-\uFF0A\uFF0C\uFF0F\uFF1A-\uFF1F\uFF5B-\uFF65")
_LATIN = r"A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u036F\u1E00-\u1EFF\uFF21-\uFF3A\uFF41-\uFF5A"
_DENSE = (r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uAC00-\uD7AF\uF900-\uFAFF"
          r"\uFF66-\uFF9F\U00020000-\U0003FFFF")
_REST = rf"[^\s{_SIGNS}{_OTHER}{_LATIN}{_DENSE}]"
_PIECE = re.compile(
    rf"[{_DENSE}]+|[{_OTHER}]+|[{_SIGNS}]*+(?:[{_LATIN}][{_LATIN}{_SIGNS}]*|{_REST}(?:{_REST}|[{_SIGNS}])*)|[{_SIGNS}]+")

#: Words that stand for signs in spelled-out addresses; a shape keeps them. Fixed values.
SPELLED = frozenset(("at", "dot", "arroba", "punto", "punkt", "point", "plus"))
#: Shapes that no personal data begins or ends with: words and the signs after them.
_PLAIN = re.compile(r"x?[^\w@+(\[{＠]*")

FOUND = ("doc_id long, text string, base array<struct<start:int,kind:int,end:int>>, "
         "added array<struct<start:int,kind:int,end:int>>")
LABELLED = "ids array<array<int>>, labels array<int>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the run before it, not into an earlier match, and the domain after it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        start = floor + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        floor = domain.end() if domain else at + 1
        at = text.find("@", max(floor, at + 1))


def base_spans(text: str) -> list[Span]:
    """All spans of the four kinds by start, then kind."""
    found = [(a, 0, b) for a, b in emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def shape(word: str) -> str:
    """Letters as x, digits by the length of their run, the rest as it is; runs of a sign once. Spelled-out signs stay."""
    if word.lower() in SPELLED:
        return word.lower()

    def run(m: re.Match) -> str:
        n = len(m[0])
        return "0" if n > 19 else "l" if n > 11 else "m" if n > 8 else "s" if n > 4 else str(n)

    plain = re.sub(r"[^\W\d_]+", "x", word)
    return re.sub(r"([^\w\s])\1+", r"\1", re.sub(r"[0-9]+", run, plain))


def tokens(text: str) -> list[tuple[int, int]]:
    """Bounds of the tokens, which hold all characters but blanks: runs without signs that no kind contains, in one script."""
    return [m.span() for m in _PIECE.finditer(text)]


@dataclass(frozen=True)
class Settings:
    #: Documents (on average) that the labelled table is made from, sequences that training takes at
    #: most, and tokens of the longest of those; longer ones are not learned from.
    sample_rows: int = 4000
    sequences: int = 1500
    longest: int = 64
    #: Tokens kept around one that is no plain word, in the labelled table; a search takes all tokens.
    around: int = 2
    slots: int = 1 << 13
    #: How much likelier, in natural logarithms, the labels of an added span must be than none.
    margin: float = 3.0
    #: Tokens whose shapes, and triples of shapes whose scores, a task keeps.
    cache: int = 300_000


def features(shapes: tuple[str, str, str], slots: int) -> list[int]:
    """Slots of what is known of a token: its shape and those before and after it."""
    before, own, after = shapes
    names = (f"0{own}", f"-{before}", f"+{after}", f"?{own.strip('.,;:!?')}", f"*{before}|{own}", f"/{own}|{after}",
             f"#{'@' in own}{any(c in '01234sml' for c in own)}{sum(c != 'x' for c in own) // 2}")
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % slots for n in names]


_WIDE = str.maketrans({**{str(i): chr(0xFF10 + i) for i in range(10)}, "@": "＠", ".": "．"})


def _spelling(word: str, kind: int, nth: int) -> str:
    """A span in a spelling that the patterns miss; there are several for each kind."""
    if kind == 0:
        dots = lambda by: word.replace("@", " at ").replace(".", by) if by else word
        return (word.replace("@", "(at)"), dots(" dot "), word.replace("@", "[at]"), word.replace("@", " (AT) "),
                word.translate(_WIDE), word.replace("@", "{at}"), word.replace("@", " @ "), word.replace("@", " at "))[nth % 8]
    if kind == 3:
        return (word[1:].lstrip("0123456789").strip(), word.translate(_WIDE), word[1:], " ".join(word.replace(" ", "")))[nth % 4]
    if kind == 1:
        return (word.replace(".", " dot "), word.translate(_WIDE), word.replace(".", "[.]"))[nth % 3]
    digits = re.sub("[^0-9]", "", word)
    return (".".join(digits[i : i + 4] for i in range(0, len(digits), 4)), digits.translate(_WIDE),
            "/".join(digits[i : i + 4] for i in range(0, len(digits), 4)))[nth % 3]


def _disguised(text: str, spans: list[Span], nth: int) -> tuple[str, list[Span]]:
    """The text with its spans in other spellings."""
    out, done, moved, shift = [], 0, [], 0
    for i, (start, kind, end) in enumerate(spans):
        if start < done:
            continue
        word = text[start:end]
        new = _spelling(word, kind, nth + i)
        if not new:
            continue
        out += [text[done:start], new]
        moved.append((start + shift, kind, start + shift + len(new)))
        shift += len(new) - len(word)
        done = end
    return "".join([*out, text[done:]]), moved


def labeller(settings: Settings):
    """mapInArrow function: texts to labelled sequences of tokens, each text as it is and twice disguised."""
    def sequences(text: str, spans: list[Span]) -> Iterator[tuple[list[list[int]], list[int]]]:
        """Neighbourhoods of labelled tokens and of those that are no plain words; such that touch are one."""
        words = tokens(text)
        shapes = ["^", *(shape(text[a:b]) for a, b in words), "$"]
        labels = [0] * len(words)
        starts = np.array([a for a, _ in words])
        for start, kind, end in spans:
            first = int(np.searchsorted(starts, start, side="right")) - 1
            for i in range(max(0, first), int(np.searchsorted(starts, end))):
                if not labels[i] and words[i][1] > start:
                    labels[i] = 1 + 2 * kind + (words[i][0] > start)
        at = np.array([i for i, x in enumerate(labels) if x or not _PLAIN.fullmatch(shapes[i + 1])], np.int64)
        if not len(at):
            return
        low, high = np.maximum(at - settings.around, 0), np.minimum(at + settings.around + 1, len(words))
        cuts = np.flatnonzero(low[1:] > high[:-1]) + 1
        for a, b in zip(low[[0, *cuts]].tolist(), high[[*(cuts - 1), -1]].tolist()):
            yield [features(tuple(shapes[i : i + 3]), settings.slots) for i in range(a, b)], labels[a:b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, marks = [], []
            for text in column(batch, "text").to_pylist():
                spans, nth = base_spans(text), zlib.crc32(text.encode("utf-8", "surrogatepass"))
                versions = [(text, spans)] + [_disguised(text, spans, nth // 8**i) for i in range(2) if spans]
                for version in versions:
                    for own, labels in sequences(*version):
                        ids.append(own)
                        marks.append(labels)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.list_(pa.list_(pa.int32()))), pa.array(marks, pa.list_(pa.int32()))], names=["ids", "labels"])

    return run


class Finder:
    """Finds base spans and adds those of the trained field."""

    def __init__(self, crf: Crf, settings: Settings):
        self.crf, self.settings = crf, settings
        # Numbers of the shapes of tokens; 0 and 1 are the ends of a text.
        self.number: dict[str, int] = {}
        self.names, self.nth = ["^", "$"], {"^": 0, "$": 1}
        # Triples of shapes, sorted, with their scores.
        self.triples, self.scores = np.zeros(0, np.int64), np.zeros((0, N_LABELS))

    def _numbers(self, words: list[str]) -> np.ndarray:
        for w in set(words).difference(self.number):
            own = shape(w)
            if own not in self.nth:
                self.nth[own] = len(self.names)
                self.names.append(own)
            self.number[w] = self.nth[own]
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _scores(self, numbers: np.ndarray) -> np.ndarray:
        """Scores of all tokens; each triple of shapes is scored once."""
        size = 1 << 21
        code = (numbers[:-2] * size + numbers[1:-1]) * size + numbers[2:]
        once, where = np.unique(code, return_inverse=True)
        fresh = once[~np.isin(once, self.triples)]
        if len(fresh):
            ids = [features((self.names[c // size // size], self.names[c // size % size], self.names[c % size]), self.settings.slots)
                   for c in fresh.tolist()]
            triples = np.concatenate([self.triples, fresh])
            order = np.argsort(triples)
            self.scores = np.concatenate([self.scores, self.crf.emissions(np.array(ids, np.int32))])[order]
            self.triples = triples[order]
        return self.scores[np.searchsorted(self.triples, once)][where]

    def added(self, texts: list[str]) -> list[tuple[int, list[int], int, list[float]]]:
        """Text, labels, place of the first token and gains of the runs of tokens that may have labels.

        All tokens of all texts are decoded. Those that have label 0 on any best path cut a text
        into parts that can be decoded apart, as a text's ends count as label 0 too.
        """
        if max(len(self.number), len(self.triples)) > self.settings.cache or len(self.names) > 1 << 20:
            self.__init__(self.crf, self.settings)
        numbers, sizes = [], []
        for text in texts:
            own = self._numbers(_PIECE.findall(text))
            numbers += [[0], own, [1]]
            sizes.append(len(own) + 2)
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        if len(flat) < 3:
            return []
        score = self._scores(flat)
        open_ = np.zeros(len(flat), bool)
        open_[1:-1] = ~self.crf.is_surely_zero(score)
        ends = np.cumsum(sizes)
        firsts = ends - sizes
        open_[firsts] = open_[ends - 1] = False
        at = np.flatnonzero(open_)
        if not len(at):
            return []
        cuts = np.flatnonzero(np.diff(at) > 1) + 1
        lengths = np.diff([0, *cuts, len(at)])
        own = score[at - 1]
        labels = self.crf.best(own, lengths)
        gain = own[np.arange(len(at)), labels] - own[:, 0]
        out, first = [], 0
        for n in lengths.tolist():
            if labels[first : first + n].any():
                text = int(np.searchsorted(ends, at[first], side="right"))
                out.append((text, labels[first : first + n].tolist(), int(at[first] - firsts[text] - 1), gain[first : first + n].tolist()))
            first += n
        return out

    def find(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in column(batch, "text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added: list[list[Span]] = [[] for _ in texts]
            last, bounds = -1, []
            for i, labels, first, gain in self.added(texts):
                if i != last:
                    last, bounds = i, tokens(texts[i])
                added[i] += self._spans(texts[i], bounds[first : first + len(labels)], labels, gain, base[i])
            struct = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
            as_rows = [pa.array([[dict(zip(("start", "kind", "end"), s)) for s in x] for x in y], struct) for y in (base, added)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "text").cast(pa.string()), *as_rows], names=["doc_id", "text", "base", "added"])

    def _spans(self, text: str, words: list[tuple[int, int]], labels: list[int], gain: list[float], base: list[Span]) -> list[Span]:
        """Runs of tokens of one kind, without signs at their ends, that overlap no base span."""
        out, i = [], 0
        low, high = words[0][0], words[-1][1]
        near = [s for s in base if s[0] < high and low < s[2]]
        while i < len(words):
            if not labels[i]:
                i += 1
                continue
            kind, j = (labels[i] - 1) // 2, i + 1
            while j < len(words) and labels[j] == 2 + 2 * kind:
                j += 1
            start, end = words[i][0], words[j - 1][1]
            # No kind begins or ends with other signs than these.
            while end > start and not text[end - 1].isalnum():
                end -= 1
            while start < end and not (text[start].isalnum() or text[start] in "(+["):
                start += 1
            if sum(gain[i:j]) >= self.settings.margin and start < end and not any(s[0] < end and start < s[2] for s in near):
                out.append((start, kind, end))
            i = j
        return out


def fit(docs: DataFrame, settings: Settings = Settings()) -> Finder:
    """Train on a small table that Spark makes: sequences of sampled texts, labelled by the patterns.

    The sample is chosen by a hash of the text and bounded by ``sample_rows`` on average,
    the sequences that training takes by ``sequences``; those with labels come first.
    """
    rows = pick(docs, "text").where("text is not null")
    n = rows.count()
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / F.lit(1e6)
    sample = rows.where(draw < min(1.0, settings.sample_rows / max(1, n)))
    table = sample.mapInArrow(labeller(settings), LABELLED)
    order = (F.array_max("labels") > 0).cast("int"), F.xxhash64(F.col("labels"), F.col("ids"))
    some = table.where(F.size("labels") <= settings.longest).withColumn("has", order[0]).withColumn("h", order[1])
    half = settings.sequences // 2
    got = [*some.where("has = 1").orderBy("h").limit(half).collect(), *some.where("has = 0").orderBy("h").limit(half).collect()]
    crf = Crf(settings.slots, N_LABELS)
    if got:
        ids = np.array([f for r in got for f in r.ids], np.int32)
        labels = np.array([x for r in got for x in r.labels], np.int64)
        crf.fit(ids, np.array([len(r.labels) for r in got]), labels)
    return Finder(crf, settings)


def find_pii(docs: DataFrame, finder: Finder) -> DataFrame:
    """Spans of personal data in every whole text, in code points with the end exclusive.

    ``base`` has all matches of the four patterns, leftmost and not overlapping within
    a kind, without those that fail their test (parts of an address above 255, digits
    not 12 to 19 or failing Luhn, digits not 9 to 15). ``added`` has what the field
    finds beyond them, decoding all tokens of a text; it never overlaps a base span. Both are ordered by start, then
    kind. Null and empty texts have none; repeated rows each have theirs; an empty
    table gives none.

    Returns doc_id, text, base, added (arrays of start, kind as a place in KINDS, end).
    """
    return keyed(docs).select("doc_id", "text").mapInArrow(finder.find, FOUND)


def joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
