import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precis.llm import near_dedup as near
from precis.llm.components import components
from precis.llm.line_dedup import line_dedup, without_common_lines
from precis.llm import substring_dedup as substring
from precis.llm.substring_dedup import substring_dedup
from tests.llm import cases


def test_lines_against_plain_python(spark):
    texts = cases.odd_texts() + ["a\nB \n c", "A\nb", " a\nd"]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup(cases.frame(spark, texts), min_docs=3).collect()}
    assert [got[i] for i in range(len(texts))] == cases.line_dedup(texts, 3)


def test_lines_repeated_rows_and_columns(spark):
    docs = cases.frame(spark, ["x\ny", "x\ny", "x", None], ids=[1, 1, 2, None])
    out = without_common_lines(docs, min_docs=2)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r["text"], r["n_chars"]) for r in out.collect()) == [(-1, "", 0), (1, "", 0), (1, "", 0), (2, "", 0)]
    assert line_dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n", [2, 5, 35])
def test_substrings_against_plain_python(spark, n):
    texts = cases.odd_texts()
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup(cases.frame(spark, texts), n).collect()}
    assert [got[i] for i in range(len(texts))] == cases.substring_dedup(texts, n)


def test_substrings_in_periodic_and_branching_texts(spark):
    rng = random.Random(1)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(3, 40))) for _ in range(12)]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(60)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup(cases.frame(spark, texts), 9).collect()}
    assert [got[i] for i in range(len(texts))] == cases.substring_dedup(texts, 9)
    assert substring_dedup(cases.frame(spark, texts).limit(0)).collect() == []


@pytest.mark.parametrize("kinds", [1, 2, 3])
def test_substrings_with_equal_hashes_are_told_apart(spark, kinds):
    rng = random.Random(kinds)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(3, 40))) for _ in range(8)]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 5))) for _ in range(25)]
    texts += ["a b c d e f g h i j", "b a d c f e h g j i", None, ""]

    def coarse(words):
        return np.array([w[0] % kinds for w in words], np.uint64)

    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring_dedup(cases.frame(spark, texts), 9, coarse).collect()}
    assert [got[i] for i in range(len(texts))] == cases.substring_dedup(texts, 9)


def test_a_window_like_one_inside_a_copied_path_is_read(spark):
    # All words count as one but for the first and last, so that only words can tell the last text from the others.
    same = " ".join("abcdefghij")
    texts = [f"x {same} y", f"x {same} y", f"z {same[::-1]} q"]

    def coarse(words):
        return np.array([ord("m") if 97 <= w[0] <= 106 else w[0] for w in words], np.uint64)

    got = {r.doc_id: r.n_removed for r in substring_dedup(cases.frame(spark, texts), 6, coarse).collect()}
    assert got == {0: 12, 1: 12, 2: 0}


def test_paths_of_a_graph_against_a_walk(spark):
    rng = random.Random(3)
    # Edges with several neighbours, chains of all lengths up to 300, and two rings.
    pairs = {(10_000 + i, 10_001 + i) for i in range(300)} | {(i, i + 1) for c in range(0, 600, 20) for i in range(c, c + c // 40)}
    pairs |= {(rng.randrange(700, 740), rng.randrange(700, 740)) for _ in range(40)}
    pairs |= {(900 + i, 900 + (i + 1) % 7) for i in range(7)} | {(950, 950)}
    rows = [(a, b, 1 + a % 5) for a, b in sorted(pairs)]
    got = {r.edge: (r.top, r.ahead) for r in substring.compacted(spark.createDataFrame(rows, "before long, after long, ahead long")).collect()}

    outs, ins = {}, {}
    for a, b in pairs:
        outs.setdefault(a, []).append(b)
        ins.setdefault(b, []).append(a)
    before = {b: a[0] for b, a in ins.items() if len(a) == 1 == len(outs[a[0]]) and a[0] != b}
    expected = {}
    for edge in before:
        top, ahead, seen = edge, 0, {edge}
        while top in before and before[top] not in seen:
            top = before[top]
            ahead += 1 + top % 5
            seen.add(top)
        if top not in before:
            expected[edge] = (top, ahead)
    assert got == expected and len(got) > 400


def test_long_spans_are_read_once(spark):
    # A copied text of 2,000 words is one path: its words are laid out once and not once for each window.
    rng = random.Random(4)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(2000))
    rows = [r for r in substring.with_spans(cases.frame(spark, [text, text + " more", "other words"])).collect() if r.spans]
    assert len({s.top for r in rows for s in r.spans}) == 1
    assert {sum(s.n for s in r.spans) for r in rows} == {1966}


def near_rows(spark, texts, ids=None, **options):
    return near.near_dedup(cases.frame(spark, texts, ids), near.Settings(**options)).collect()


@pytest.mark.parametrize("n", [2, 5])
def test_near_copies_against_all_pairs(spark, n):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = list(cases.odd_texts())
    # A crowd around one text, whose members are linked by chance only: the hard case for leaders.
    base = rng.choices(vocabulary, k=120)
    for _ in range(250):
        copy = list(base)
        for _ in range(rng.randint(1, 14)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    ids = [3 * i + 5 for i in range(len(texts))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_rows(spark, texts, ids, words=n, block=64)}
    expected = cases.near_dedup(ids, texts, n)
    assert [got[i] for i in ids] == expected
    assert len({c for _, c in expected}) > 20


def test_near_copies_odd_rows(spark):
    rows = near_rows(spark, ["a b c", "a b c", "A B C", None, "", "z"], [7, 7, 4, 1, 2, None], words=2)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    assert got == sorted([(7, 2, 4, False), (7, 2, 4, False), (4, 2, 4, True), (1, 0, 1, True), (2, 0, 2, True), (None, 1, None, True)], key=str)
    assert near.near_dedup(cases.frame(spark, ["a"]).limit(0)).collect() == []


def test_one_row_of_each_group_stays(spark):
    docs = cases.frame(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None, "other words"], [7, 7, 9, 1, None])
    out = near.without_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "7", "None"]


def test_sketches_estimate_and_pass_links():
    settings_ = near.Settings(words=2)
    signer = near.Signer(settings_)
    rng = np.random.default_rng(0)
    apart = []
    for _ in range(300):
        both = rng.integers(0, 2**63, 800, dtype=np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**63, 100, dtype=np.uint64)]) for _ in range(2))
        odd = signer.sketches(np.array([signer.samples(a), signer.samples(b)])).view(np.uint64)
        apart.append(int(np.bitwise_count(odd[0] ^ odd[1]).sum()))
    # Exactly the similarity 0.8: the mean is what the sketch's formula says, and none is ruled out.
    turned = 2 * settings_.samples * 0.2
    assert abs(np.mean(apart) - settings_.bits / 2 * (1 - np.exp(-2 * turned / settings_.bits))) < 2
    assert max(apart) <= settings_.most_differences


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=9, max_size=80))
def test_paths_hold_every_window_once(numbers):
    import pyarrow as pa

    from precis.llm.substring_dedup import paths_of

    text = " ".join("abcd"[i] for i in numbers)
    batch = pa.RecordBatch.from_pydict({"k1": [1], "k2": [2], "text": [text]})
    rows = [r for out in paths_of(9, 3)([batch]) for r in out.to_pylist()]
    covered = sorted(i for r in rows for i in range(r["start"], r["start"] + r["n"]))
    assert covered == list(range(len(numbers) - 8))
    # A path without a loop holds no window twice.
    for r in rows:
        windows = [tuple(numbers[i : i + 9]) for i in range(r["start"], r["start"] + r["n"])]
        assert r["loop"] or len(set(windows)) == len(windows)
