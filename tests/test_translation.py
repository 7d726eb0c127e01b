"""Word alignments and smoothed prefixes against plain Python."""

import itertools
import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from precis.operators import alignment
from precis.operators.alignment import Alignment
from precis.operators.backoff import Backoff, trigrams
from precis.sources.storage import scratch_path

PAIRS = [
    (0, "la casa roja".split(), "casa roja".split()), (1, "la casa".split(), "casa".split()), (2, "el perro rojo corre corre".split(), "perro corre".split()),
    (3, "el perro".split(), "perro perro".split()), (4, [], "casa".split()), (5, "sin resumen".split(), []), (6, None, None), (7, ["", None, "la"], ["roja", None, ""]),
]
SCHEMA = "doc_id long, a array<string>, b array<string>"


def plain_alignment(pairs, rounds):
    pairs = [([*(w for w in a or [] if w), ""], [w for w in b or [] if w]) for _, a, b in pairs]
    table = defaultdict(lambda: 1 / len({s for _, b in pairs for s in b}))
    seen = []
    for _ in range(rounds):
        counts, like = Counter(), 0.0
        for a, b in pairs:
            for s in b:
                total = sum(table[w, s] for w in a)
                like += math.log(total / len(a))
                for w in a:
                    counts[w, s] += table[w, s] / total
        sums = Counter()
        for (w, _), c in counts.items():
            sums[w] += c
        table = {k: c / sums[k[0]] for k, c in counts.items()}
        seen.append(like)
    return table, seen


def test_alignment_equals_plain_python(spark):
    table = spark.createDataFrame(PAIRS, SCHEMA)
    model = Alignment.fit(table, "a", "b", 6)
    expected, seen = plain_alignment(PAIRS, 6)
    got = {(r.word, r.summary_word): r.p for r in model.table.collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k], rel=1e-9) for k in got)
    likes = [r.log_likelihood for r in model.history.orderBy("round").collect()]
    assert likes == pytest.approx(seen) and all(a < b for a, b in zip(likes, likes[1:]))
    assert max((p, w) for (w, s), p in got.items() if s == "perro" and w)[1] in ("perro", "el")
    path = scratch_path(spark, "alignment-test")
    model.save(path)
    again = Alignment.load(spark, path)
    assert {(r.word, r.summary_word): r.p for r in again.table.collect()} == got
    likely = again.likely_words(table, "a", 2)
    for i, a, _ in PAIRS:
        words = [*(w for w in a or [] if w), ""]
        p = {s: round(sum(expected.get((w, s), 0) for w in words) / len(words), 10) for _, s in expected}
        best = sorted(((-v, s) for s, v in p.items() if any((w, s) in expected for w in words)))[:2]
        rows = sorted((r.rank, r.summary_word, r.p) for r in likely.where(f"doc_id = {i}").collect())
        assert [(r[1], pytest.approx(r[2])) for r in rows] == [(s, -v) for v, s in best]


def test_alignment_stores_no_cells(spark, monkeypatch):
    """A pair of 300 and 200 different words has 60,000 cells and more; what is stored is rows of words and texts."""
    pairs = [(i, [f"w{j}" for j in range(300)], [f"s{j}" for j in range(i, 200 + i)]) for i in range(3)]
    stored, rows = alignment._stored, []

    def counted(df):
        out = stored(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(alignment, "_stored", counted)
    Alignment.fit(spark.createDataFrame(pairs, SCHEMA), "a", "b", 2).history.collect()
    assert max(rows) < 301 * 200


def test_alignment_in_parts_and_with_repeated_keys(spark):
    """Blocks of 40 cells: frequent summary words are in several parts. Rows with one key are one text with an empty word for each."""
    rng = random.Random(3)
    pairs = [(i, rng.choices("abcdefghij", k=6), rng.choices("rstuvw", weights=(30, 9, 3, 1, 1, 1), k=4)) for i in range(40)]
    expected, seen = plain_alignment(pairs, 4)
    model = Alignment.fit(spark.createDataFrame(pairs, SCHEMA), "a", "b", 4, block_cells=40)
    rows = model.table.collect()
    assert len(rows) == len(expected) and {(r.word, r.summary_word): r.p for r in rows} == pytest.approx(expected, rel=1e-9)
    assert [r.log_likelihood for r in model.history.orderBy("round").collect()] == pytest.approx(seen)
    twice = Alignment.fit(spark.createDataFrame([(1, ["a"], ["x", "y"]), (1, ["b"], ["x"]), (None, ["a"], ["z"])], SCHEMA), "a", "b", 1)
    assert {(r.word, r.summary_word): r.p for r in twice.table.collect()} == pytest.approx(
        {(w, s): p for w in ("a", "b", "") for s, p in (("x", 2 / 3), ("y", 1 / 3))})
    assert twice.history.first().log_likelihood == pytest.approx(3 * math.log(2))


def test_alignment_sends_ranges_of_words(monkeypatch):
    """A part gives back a row for many words, whatever the summary words that it takes up at a time; sums come out in the order of the words."""
    texts = pa.table({
        "words": [[0, 7, 9000], [7, 3], [9000, 3, 2]], "n": pa.array([[1, 2, 1], [1, 1], [3, 1, 1]], pa.list_(pa.int32())),
        "shift": [0.0, 0.0, 0.0], "summary": [[4, 5], [4], [5, 6, 4]], "m": [[1, 2], [1], [1, 1, 1]], "split": [False] * 3})
    key, known = (pa.scalar(0), pa.scalar(0)), pa.table({c: pa.array([], t) for c, t in (
        ("range", pa.int32()), ("alls", pa.list_(pa.float64())), ("likes", pa.list_(pa.float64())))})
    found = []
    for cells in (1, 5, 1 << 20):
        monkeypatch.setattr(alignment, "CHUNK_CELLS", cells)
        first = alignment._sums(3)(key, texts, known)
        assert first.column("words").to_pylist() == [[0, 2, 3, 7], [9000]]
        second = alignment._sums(3)(key, texts, alignment._added(first))
        found.append([sum(x.column("c").to_pylist(), []) for x in (first, second)])
        assert sum(found[-1][0]) == pytest.approx(7) and len(second.column("likes")[0]) == 2
    assert all(a == pytest.approx(b) for x in found for a, b in zip(x, found[2]))


def test_words_alone_in_a_text_share_a_number(spark):
    """Of 20 words that stand in one text alone, and in the same, one number travels; the table has them all."""
    pairs = [(i, [*(f"own{i}-{j}" for j in range(20)), "la"], ["casa", f"s{i}"]) for i in range(3)]
    dealt, names, _, _ = alignment.blocks(spark.createDataFrame(pairs, SCHEMA), "a", "b", 1000)
    assert {len(r.words) for r in dealt.collect()} == {3} and names.count() == 62 and names.select("id").distinct().count() == 5
    expected, _ = plain_alignment(pairs, 3)
    rows = Alignment.fit(spark.createDataFrame(pairs, SCHEMA), "a", "b", 3).table.collect()
    assert len(rows) == len(expected) and {(r.word, r.summary_word): r.p for r in rows} == pytest.approx(expected, rel=1e-9)


def test_likely_words_leave_out_what_cannot_be_among_the_best(spark, monkeypatch):
    """Against plain Python, with hardly any, some and all rows in the short table; the empty word brings 2,000 summary words to each text."""
    rng = random.Random(8)
    table = [(w, f"s{j}", 0.5 / (j + 1) ** 2 if w == "" else rng.random() ** 8) for w, n in (("", 2000), ("a", 900), ("b", 5), ("c", 1)) for j in rng.sample(range(n), n)]
    texts = [(0, ["a", "b", "a"]), (1, []), (2, ["c", "zz"]), (3, None), (4, ["b", None, ""]), (4, ["c"]), (None, ["a"])]
    docs, model = spark.createDataFrame(texts, "doc_id long, a array<string>"), Alignment(spark.createDataFrame(table, alignment.TABLE), None)
    counts = spark.createDataFrame([(i, w, 1) for i in range(20) for w in ("", "b")], "doc_id long, word string, n long")
    sizes = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, size long")
    assert alignment.Short.of(model.table).likely(counts, sizes, 10).count() < 20 * 30
    wanted = []
    for i in range(5):
        same = [[w for w in a or [] if w] for d, a in texts if d == i]
        words = [w for a in same for w in [*a, ""]]
        p = Counter()
        for w, s, x in table:
            p[s] += words.count(w) * x
        rows = sorted((-round(x / (len(a) + 1), 10), s) for a in same for s, x in p.items() if x)[:10]
        wanted += [(i, n + 1, s, pytest.approx(-x)) for n, (x, s) in enumerate(rows)]
    for few, likely, sent in ((512, 1 / 2048, 1 << 22), (2, 0.4, 0), (2, 2.0, 10), (3, 0.05, 6), (10000, 0.5, 10)):
        for name, value in (("FEW", few), ("LIKELY", likely), ("SENT", sent)):
            monkeypatch.setattr(alignment, name, value)
        assert sorted(tuple(r) for r in model.likely_words(docs, "a").collect()) == wanted, (few, likely, sent)


def test_likely_words_of_a_fit_store_no_entries(spark, monkeypatch):
    """Of 60,200 entries and more none is stored as a row; the best words are those of the saved table."""
    pairs = [(i, [f"w{j}" for j in range(300)], [f"s{j}" for j in range(i, 200 + i)]) for i in range(3)]
    table = spark.createDataFrame(pairs, SCHEMA)
    model = Alignment.fit(table, "a", "b", 2)
    stored, rows = alignment._stored, []

    def counted(df):
        out = stored(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(alignment, "_stored", counted)
    found = sorted(tuple(r) for r in model.likely_words(table, "a", 3).collect())
    assert max(rows) < 301 * 200
    # Words that all three texts have come first, by name.
    assert [r[:3] for r in found] == [(i, n + 1, s) for i in range(3) for n, s in enumerate(("s10", "s100", "s101"))]


def test_likely_words_of_a_fit_equal_plain_python(spark, monkeypatch):
    """Blocks of 40 cells, some in parts, with most, some and none of the entries met by all texts, so that other texts go to all blocks."""
    rng = random.Random(3)
    pairs = [(i, rng.choices("abcdefghij", k=6), rng.choices("rstuvwxyz", weights=(30, 9, 3, 1, 1, 1, 1, 1, 1), k=4)) for i in range(40)]
    table, _ = plain_alignment(pairs, 3)
    model = Alignment.fit(spark.createDataFrame(pairs, SCHEMA), "a", "b", 3, block_cells=40)
    texts = [*((f"t{i}", a) for i, a, _ in pairs[:4]), ("t4", ["zz"]), ("t5", None), ("t6", ["a", None, "", "a"]), ("t7", ["b", "zz"]), ("t7", ["c"]), (None, ["a"])]
    docs, wanted = spark.createDataFrame(texts, "doc_id string, a array<string>"), []
    for i in range(8):
        same = [[w for w in a or [] if w] for d, a in texts if d == f"t{i}"]
        words = [w for a in same for w in [*a, ""]]
        p = Counter()
        for (w, s), x in table.items():
            p[s] += words.count(w) * x
        rows = sorted((-round(x / (len(a) + 1), 10), s) for a in same for s, x in p.items() if x)[:3]
        wanted += [(f"t{i}", n + 1, s, pytest.approx(-x)) for n, (x, s) in enumerate(rows)]
    for first, likely in ((1 / 256, 1 / 2048), (0.4, 0.05), (2.0, 2.0)):
        monkeypatch.setattr(alignment, "FIRST", first)
        monkeypatch.setattr(alignment, "LIKELY", likely)
        assert sorted(tuple(r) for r in model.likely_words(docs, "a", 3).collect()) == wanted, (first, likely)


def test_sums_asked_of_a_part_come_in_slices(monkeypatch):
    """The same sums, whatever the number of cells that is taken up at a time; an open text gets the best of the part."""
    key = (pa.scalar(0), pa.scalar(0))
    texts = pa.table({
        "words": [[0, 7, 9000], [7, 3], [9000, 3, 2]], "n": pa.array([[1, 2, 1], [1, 1], [3, 1, 1]], pa.list_(pa.int32())),
        "shift": [0.0, 0.0, 0.0], "summary": [[4, 5], [4], [5, 6, 4]], "m": [[1, 2], [1], [1, 1, 1]], "split": [False] * 3, "kind": [0] * 3})
    known = pa.table({c: pa.array([], t) for c, t in (("range", pa.int32()), ("alls", pa.list_(pa.float64())), ("likes", pa.list_(pa.float64())))})
    known = alignment._added(alignment._sums(3)(key, texts, known)).append_column("kind", pa.array([1] * 2))
    rows = pa.concat_tables([texts, known], promote_options="default")
    asked = pa.table({"doc_id": ["x", "y", "z"], "sids": [[6, 4], [-1], [5]], "words": [[0, 3, 8], [7, 9000], [1]], "n": [[1, 2, 5], [1, 1], [1]], "size": [8, 2, 1]})
    table = {(w, s): p for s, w, p in _entries(texts, known, key)}
    wanted = {(d, s): sum(n * table.get((w, s), 0.0) for w, n in zip(ws, ns)) for d, ws, ns, some in (("x", [0, 3], [1, 2], (4, 6)), ("y", [7, 9000], [1, 1], (4, 5)), ("z", [], [], (5,))) for s in some}
    for cells in (1, 3, 1 << 20):
        monkeypatch.setattr(alignment, "CHUNK_CELLS", cells)
        found = alignment._asked(3, 2)(key, rows, asked).to_pylist()
        got = {(r["doc_id"], r["sid"]): r["p"] for r in found}
        assert len(got) == len(found) and {k: got[k] for k in wanted} == pytest.approx(wanted) and got.keys() - wanted.keys() <= {("y", 6)}


def _entries(texts, known, key):
    block = alignment.Block(texts, known, 3)
    for cells in block.cells():
        yield from zip(block.names[cells.name].tolist(), block.words[cells.word].tolist(), cells.table().tolist())


def test_places_of_distinct_keys():
    import numpy as np

    for keys in ([], [5], [3, 1, 3, 0], [1 << 61, 7, 1 << 61]):
        keys = np.array(keys, np.int64)
        found = alignment._distinct(keys)
        assert [x.tolist() for x in found] == [x.tolist() for x in np.unique(keys, return_inverse=True)]


def test_rows_of_several_tables_have_no_null_arrays(spark):
    both = alignment._together(spark.createDataFrame([(1, [2])], "a int, b array<int>"), spark.createDataFrame([([0.5], "x")], "c array<double>, d string"))
    assert sorted(tuple(r) for r in both.collect() if r.kind == 0) == [(1, [2], [], None, 0)]
    assert sorted(tuple(r) for r in both.collect() if r.kind == 1) == [(None, [], [0.5], "x", 1)]


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for rounds in (0, 2):
        model = Alignment.fit(empty, "a", "b", rounds)
        assert model.table.collect() == [] and model.likely_words(empty, "a").collect() == []
    assert [r.log_likelihood for r in model.history.collect()] == [0.0, 0.0]


def sequences(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")


def plain_backoff(rows, size):
    """A function of u, v, w."""
    c3 = Counter(t for s in rows for t in zip([2, *s], s, s[1:]))
    c2, c1 = Counter((v, w) for _, v, w in c3), Counter()
    for _, w in c2:
        c1[w] += 1

    def discount(c):
        one, two = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
        return one / (one + 2 * two) if one and two else 0.5

    d3, d2, d1 = discount(c3), discount(c2), discount(c1)

    def level(counts, own, d, lower):
        if not own:
            return lower
        return (max(counts - d, 0) + d * len(own) * lower) / sum(own.values())

    def p(u, v, w):
        p1 = level(c1[w], c1, d1, 1 / size)
        p2 = level(c2[v, w], {k: n for k, n in c2.items() if k[0] == v}, d2, p1)
        return level(c3[u, v, w], {k: n for k, n in c3.items() if k[:2] == (u, v)}, d3, p2)

    return p


def test_backoff_sums_to_one_and_equals_plain_python(spark):
    rng = random.Random(6)
    rows = [[2, *rng.choices(range(4, 9), weights=(9, 4, 2, 1, 1), k=rng.randrange(8)), 3] for _ in range(40)]
    model = Backoff.fit(sequences(spark, rows))
    assert model.size == len({w for s in rows for w in s[1:]}) + 1
    # 9 was never seen: it stands for all others, after any prefix, also unseen ones.
    every = [3, *range(4, 9), 9]
    assert len(every) == model.size
    wanted = list(itertools.product([2, 4, 5, 8, 9], [2, 4, 7, 9], every))
    got = {(r.u, r.v, r.w): r.p for r in model.probabilities(spark.createDataFrame(wanted, "u int, v int, w int")).collect()}
    plain = plain_backoff(rows, model.size)
    for u, v in {x[:2] for x in wanted}:
        assert sum(got[u, v, w] for w in every) == pytest.approx(1)
    assert all(p > 0 and p == pytest.approx(plain(*k)) for k, p in got.items())
    seen = {(r.u, r.v, r.w): r.p for r in model.table().collect()}
    assert set(seen) == {t for s in rows for t in zip([2, *s], s, s[1:])} and all(p == pytest.approx(plain(*k)) for k, p in seen.items())
    new = [[2, 4, 4, 9, 3], [2, 3], [2], []]
    likelihood = {r.doc_id: (r.n, r.log_p) for r in model.likelihood(sequences(spark, new)).collect()}
    assert likelihood == {i: (len(s) - 1, pytest.approx(sum(math.log(plain(*t)) for t in zip([2, *s], s, s[1:])))) for i, s in enumerate(new) if len(s) > 1}


def test_backoff_of_nothing(spark):
    model = Backoff.fit(sequences(spark, []), size=4)
    rows = model.probabilities(spark.createDataFrame([(2, 2, 5)], "u int, v int, w int")).collect()
    assert [r.p for r in rows] == [0.25] and model.table().collect() == []
    odd = trigrams(sequences(spark, [None, [], [2], [2, 0, 4, None, 3, 0, 0]])).orderBy("pos").collect()
    assert [(r.doc_id, r.u, r.v, r.w) for r in odd] == [(3, 2, 2, 4), (3, 2, 4, 3)]
