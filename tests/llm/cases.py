"""Documents with every odd case, and plain Python versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, k1 string, Text string, node int, kept string"
DATA = "/root/testdata/sf0.001"


def frame(spark, texts, ids=None, lang="en", source="s"):
    """Documents with columns whose names clash with those that operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source, None if t is None else len(t), "x", "Y", 7, None) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "été", "x", "the", "of", "中文", " ", "a.b"]
    base = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(4)]
    return [
        None, "", " ", "\n\n", "one", base[0], base[0], base[0] + " tail", base[1], base[1].upper(),
        base[0] + "\n" + base[2], base[3] * 40, "x " * 3000, ("p q r s t " * 500).strip(), "\t".join(base[2].split()),
        "line\r\n Line \n\x0bline", "word" * 20_000,
    ]


def line_dedup(texts, min_docs):
    def key(line):
        return low(line.strip(" \t\n\x0b\x0c\r"))

    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(texts, n):
    every = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in every for i in range(len(w) - n + 1))
    out = []
    for w in every:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingle_set(text, n):
    w = words(low(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near_dedup(ids, texts, n, percent=80):
    """n_shingles and component_id of each document, by comparing all pairs."""
    sets = [shingle_set(t, n) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, d in enumerate(ids):
        least[find(i)].append(d)
    return [(len(s), min(least[find(i)])) for i, s in enumerate(sets)]


def contaminated(texts, items, n=13):
    """n_words, n_hit and item ids of each document; items are (id, text)."""
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))

    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k : k + size])].add(str(i))
    sizes = {len(x) for x in windows}
    out = []
    for t in texts:
        w, hit, ids = split(t), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                own = windows.get(tuple(w[k : k + size]))
                if own:
                    hit.update(range(k, k + size))
                    ids |= own
        out.append((len(w), len(hit), sorted(ids)))
    return out
