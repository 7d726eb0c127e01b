"""Periodic runs and conversation repair against plain versions that try everything."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precis.llm import conversation_repair as cr
from precis.llm import periodic_runs as pr
from tests.llm import cases


def plain_runs(words):
    """start, length, period by the definition: every stretch, its smallest period, both neighbours."""
    n, out = len(words), []
    for s in range(n):
        for e in range(s + pr.LEAST, n + 1):
            part = words[s:e]
            q = next(q for q in range(1, len(part) + 1) if part[q:] == part[:-q])
            if len(part) < 2 * q or (s and words[s - 1] == words[s - 1 + q]) or (e < n and words[e] == words[e - q]):
                continue
            out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_of(texts):
    """The runs of texts that stand together in one array."""
    flat, owner, number = [], [], {}
    for i, t in enumerate(texts):
        flat += [-1 - i, *(number.setdefault(w, len(number)) for w in t)]
        owner += [i] * (len(t) + 1)
    flat, owner = [*flat, -1 - len(texts)], [*owner, len(texts)]
    first = np.cumsum([0, *(len(t) + 1 for t in texts)]) + 1
    out = [[] for _ in texts]
    for s, e, q in zip(*(x.tolist() for x in pr.find_runs(np.array(flat), np.array(owner), max(map(len, texts), default=0)))):
        out[owner[s]].append((s - int(first[owner[s]]), e - s, q))
    return out


word_lists = st.lists(st.sampled_from("ab"), max_size=40) | st.lists(st.sampled_from("abc"), max_size=60) | st.builds(
    lambda a, n, b: a * n + b, st.lists(st.sampled_from("abcd"), min_size=1, max_size=25), st.integers(1, 4),
    st.lists(st.sampled_from("abcd"), max_size=12))


@settings(max_examples=60, deadline=None)
@given(st.lists(word_lists, min_size=1, max_size=4))
def test_runs_by_definition(texts):
    assert runs_of(texts) == [plain_runs(t) for t in texts]


def quick_runs(words):
    """The same from the stretches of each lag."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        same = [a == b for a, b in zip(words, words[q:])]
        at = 0
        for equal, part in itertools.groupby(same):
            m = len(list(part))
            if equal and m + q >= max(pr.LEAST, 2 * q):
                best.setdefault((at, at + m + q), q)
            at += m
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_long_and_nested_texts():
    rng = random.Random(3)
    texts = []
    for period in (7, 31, 150, 400):
        block = rng.choices("abcdefgh", k=period)
        # Periods within periods, and a last copy that is cut.
        inner = (block[: period // 3 + 1] * 5 + block) * 4
        texts += [(block * 9)[: 8 * period + period // 2], inner + rng.choices("xyz", k=30) + inner]
    texts += [["x"] * 2000, rng.choices("ab", k=1500)]
    assert runs_of(texts) == [quick_runs(t) for t in texts]


def test_one_word_many_times_is_linear():
    words = np.concatenate([[-1], np.zeros(300_000, np.int64), [-2]])
    owner = np.append(np.zeros(300_001, np.int64), 1)
    assert [x.tolist() for x in pr.find_runs(words, owner, 300_000)] == [[1], [300_001], [1]]
    # A longer period, whose multiples are not followed either.
    words = np.concatenate([[-1], np.tile(np.arange(300), 1000), [-2]])
    assert [x.tolist() for x in pr.find_runs(words, owner, 300_000)] == [[1], [300_001], [300]]


def test_runs_of_documents(spark):
    texts = [*cases.odd_texts(), "a b " * 6 + "c", None, "a b " * 5]
    docs = cases.frame(spark, texts, ids=[*range(len(texts) - 1), None])
    rows = pr.periodic_runs(docs.repartition(3)).collect()
    expected = []
    for i, t in zip([*range(len(texts) - 1), None], texts):
        w = cases.words(t)
        runs = quick_runs(w)
        expected.append((i, len(w), runs, collapsed(w, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert pr.periodic_runs(docs.limit(0)).collect() == []


# --- conversations -------------------------------------------------------------


def plain_repair(rows):
    """cost, audit and repaired turns by trying all edits; rows are (role, text) in order, None to forbid keeping."""
    best = None
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    inserts = ("", "u", "a", "ua", "au")
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product(*(("D",) if f in ("blank", "duplicate") else ("K", "Ru", "Ra", "D") for f in faults)):
            cost, audit, roles, out = 0, "", "", []
            for i in range(len(rows) + 1):
                for c in gaps[i]:
                    cost, audit, roles = cost + 2, audit + "I", roles + c
                    out.append(({"u": "user", "a": "assistant"}[c], ""))
                if i == len(rows):
                    break
                (role, text), e = rows[i], edits[i]
                audit += e[0]
                cost += {"K": 0, "R": 2, "D": 3}[e[0]] + (faults[i] == "truncated" and e != "D")
                if e != "D":
                    new = role if e == "K" else {"u": "user", "a": "assistant"}[e[1]]
                    roles += new[:1] or " "
                    out.append((new, text))
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, out
    return best


texts = st.sampled_from(["", " ", "a.", "b!", "c", "d? "])
turn_lists = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), texts), max_size=4)


@settings(max_examples=25, deadline=None)
@given(turn_lists)
def test_repair_tries_everything(rows):
    talk, seen, out = cr.Conversation((0, False)), set(), []
    for i, (role, text) in enumerate(rows):
        bare = text.strip()
        out += talk.take(i, role, text, 1, not bare, (role, text) in seen, bool(bare) and bare[-1] not in ".!?")
        seen.add((role, text))
    out += talk.close()
    cost, audit, said = plain_repair(rows)
    assert (out[-1][-2], out[-1][-1]) == (cost, audit)
    assert [r[3:5] for r in out[:-1]] == said


def string_repair(turns):
    """The same with whole strings in place of nodes, for long conversations."""
    best = {cr.START: (0, "")}

    def inserted():
        for s, (c, t) in best.items():
            yield s, c, t
            yield cr._NEXT[s], c + 2, t + "I"
            yield cr._NEXT[cr._NEXT[s]], c + 4, t + "II"

    for mine, cut, must_go in turns:
        new = {}
        for s, c, t in inserted():
            options = [(s, c + 3, t + "D")]
            if not must_go:
                options.append((cr._NEXT[s], c + 2 + cut, t + "R"))
                if s in cr._KEPT.get(mine, {}):
                    options.append((cr._KEPT[mine][s], c + cut, t + "K"))
            for state, *x in options:
                new[state] = min(new.get(state, tuple(x)), tuple(x))
        best = new
    return min((c, t) for s, c, t in inserted() if s in (cr.START, cr.ASSISTANT))


@pytest.mark.parametrize("most_nodes", [40, 1 << 13])
def test_long_strings_are_compared_right(most_nodes):
    rng = random.Random(most_nodes)
    for _ in range(30):
        turns = [(rng.choice("uasx"), rng.random() < 0.3, rng.random() < 0.2) for _ in range(rng.randrange(400))]
        repair, audit = cr.Repair(most_nodes), ""
        for t in turns:
            repair.turn(*t)
            audit += repair.settled()
        cost, rest = repair.end()
        assert (cost, audit + rest) == string_repair(turns)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(cr, "_MODULUS", 3)
    rng = random.Random(1)
    for _ in range(30):
        turns = [(rng.choice("uas"), rng.random() < 0.3, rng.random() < 0.2) for _ in range(60)]
        repair = cr.Repair()
        for t in turns:
            repair.turn(*t)
        assert repair.end() == string_repair(turns)


def test_repair_of_tables(spark):
    schema = "conv_id long, turn long, role string, text string, Text string, n long, h1 int"
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 5, "user", "Why"), (1, None, "system", "Be good."),
        (2, 0, None, None), (None, 3, "user", "Hi."), (None, None, "user", "Hi."), (3, 7, "assistant", "So?"),
        *((4, i, "user", "again.") for i in range(50)), *((5, 2, "user", "same.") for _ in range(50)),
    ]
    said, audit = cr.repair(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema))
    got = {r.conv_id: tuple(r)[1:] for r in audit.collect()}
    # conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit
    assert got == {
        1: (3, 0, 1, 1, 1, 6, "KKKDD"), 2: (0, 1, 0, 0, 0, 3, "D"), None: (0, 0, 1, 0, 1, 5, "KDI"), 3: (0, 0, 0, 0, 0, 2, "IK"),
        4: (0, 0, 49, 0, 49, 149, "K" + "D" * 49 + "I"), 5: (0, 0, 49, 0, 49, 149, "K" + "D" * 49 + "I")}
    turns = {}
    for r in said.orderBy("place").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns[1] == [("system", "Be good."), ("user", "Hi."), ("assistant", "Yes.")]
    assert turns[3] == [("user", ""), ("assistant", "So?")] and 2 not in turns
    empty = cr.repair(spark.createDataFrame([], schema))
    assert [x.collect() for x in empty] == [[], []]


def test_damage(spark):
    import zlib

    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in (("assistant", "A. b! c?"), (None, None))]
    got = sorted((tuple(r) for r in cr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    expected = []
    for c, t, r, x in rows:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", " " if x is None else x
        x = "" if what == 1 else re.sub("[.!?]", "", x) if what == 2 else x
        expected += [(c, t, "user" if what == 4 else r, x)] * (0 if what == 0 else 2 if what == 3 else 1)
    assert got == sorted(expected, key=str)
