"""Repair the structure of conversations at least cost, with an audit of the edits.

Turns are kept, given another role, deleted, or empty ones inserted, so that roles read
``(s?(ua)+)?``. The edits form a path through a small automaton whose states are the role
that came last; for each state the cheapest edits so far are kept, of equal cost those whose
initials come first in ASCII. Edit strings are linked nodes that share their beginnings. A
node knows its ancestors 1, 2, 4, ... places up and a rolling hash of its string, so two
strings are compared by a search for the end of their common beginning.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import BLANKS, pick, stored

#: States: nothing yet, a system turn, a user turn, an assistant turn came last.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: Costs of the edits, and what a truncated turn adds that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: What a user or assistant turn makes of each state.
_NEXT = (USER, USER, ASSISTANT, USER)
#: What a kept turn makes of a state, by its role's initial.
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_LEGAL = {"su", "ua", "au"}
#: Nodes after which the edits that all paths share are handed out.
MOST_NODES = 1 << 13
_MODULUS, _BASE = (1 << 61) - 1, 911_382_323_191

ROWS = "doc_key long, no_key boolean, turn long, role string, text string, n long, blank boolean, again boolean, cut boolean"
RESULT = ("doc_key long, no_key boolean, place long, role string, text string, gaps long, blank long, "
          "duplicate long, truncated long, illegal long, cost long, audit string")


class Edits:
    """Strings of edit initials as nodes of a tree; node 0 is the empty string."""

    def __init__(self):
        self.char, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self.children: dict[tuple[int, str], int] = {}

    def add(self, node: int, chars: str) -> int:
        for c in chars:
            child = self.children.get((node, c))
            if child is None:
                child = self.children[node, c] = len(self.char)
                up = [node]
                while len(self.up[up[-1]]) >= len(up):
                    up.append(self.up[up[-1]][len(up) - 1])
                self.char.append(c)
                self.depth.append(self.depth[node] + 1)
                self.hash.append((self.hash[node] * _BASE + ord(c)) % _MODULUS)
                self.up.append(up)
            node = child
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The node above at a depth, by jumps of powers of two."""
        left = self.depth[node] - depth
        while left:
            k = left.bit_length() - 1
            node, left = self.up[node][k], left - (1 << k)
        return node

    def spell(self, node: int, above: int = 0) -> str:
        """The initials from below ``above`` down to the node."""
        out = []
        while node != above:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, a: int, b: int) -> bool:
        """Whether two strings of one length and hash are equal: read back until they are one node."""
        while a != b:
            if self.char[a] != self.char[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether string a comes before string b; a beginning comes before what continues it."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self.same(x, y) else self.spell(a) < self.spell(b)
        # Up as long as the strings still differ; after that their parents have one hash.
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]):
                p, q = self.up[x][k], self.up[y][k]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        if not self.same(self.up[x][0], self.up[y][0]):
            return self.spell(a) < self.spell(b)
        return self.char[x] < self.char[y]


class Repair:
    """The cheapest edits of the turns so far, for each state: (cost, node)."""

    def __init__(self, most_nodes: int = MOST_NODES):
        self.edits = Edits()
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.most = self.room = most_nodes

    def _inserted(self) -> Iterator[tuple[int, int, int, str]]:
        """Each state with none, one or two empty turns after it; more are never cheapest, as two give the state back."""
        for state, (cost, node) in self.best.items():
            once = _NEXT[state]
            yield state, cost, node, ""
            yield once, cost + INSERT, node, "I"
            yield _NEXT[once], cost + 2 * INSERT, node, "II"

    def _choose(self, options: Iterator[tuple[int, int, int, str]]) -> dict[int, tuple[int, int]]:
        """The cheapest option of each state; nodes are made for those alone."""
        least: dict[int, list[tuple[int, int, str]]] = {}
        for state, cost, node, chars in options:
            have = least.get(state)
            if not have or cost < have[0][0]:
                least[state] = [(cost, node, chars)]
            elif cost == have[0][0]:
                have.append((cost, node, chars))
        out = {}
        for state, have in least.items():
            cost, node = have[0][0], self.edits.add(*have[0][1:])
            for _, other, chars in have[1:]:
                other = self.edits.add(other, chars)
                if self.edits.less(other, node):
                    node = other
            out[state] = cost, node
        return out

    def turn(self, initial: str, cut: bool, must_go: bool) -> None:
        def options():
            kept = _KEPT.get(initial, {})
            for state, cost, node, chars in self._inserted():
                yield state, cost + DELETE, node, chars + "D"
                if not must_go:
                    yield _NEXT[state], cost + REROLE + TRUNCATED * cut, node, chars + "R"
                    if state in kept:
                        yield kept[state], cost + KEEP + TRUNCATED * cut, node, chars + "K"

        self.best = self._choose(options())

    def end(self) -> tuple[int, str]:
        """Cost and the initials that have not been handed out, for roles that may end here."""
        done = self._choose((START, *rest) for state, *rest in self._inserted() if state in (START, ASSISTANT))
        cost, node = done[START]
        return cost, self.edits.spell(node)

    def settled(self) -> str:
        """Initials that all paths begin with, once there are many nodes; they are forgotten here."""
        if len(self.edits.char) < self.room:
            return ""
        nodes = [node for _, node in self.best.values()]
        depth = min(self.edits.depth[n] for n in nodes)
        top = {self.edits.ancestor(n, depth) for n in nodes}
        while len(top) > 1:
            top = {self.edits.up[n][0] for n in top}
        top = top.pop()
        out, fresh = self.edits.spell(top), Edits()
        self.best = {s: (cost, fresh.add(0, self.edits.spell(n, top))) for s, (cost, n) in self.best.items()}
        self.edits = fresh
        self.room = max(self.most, 2 * len(fresh.char))
        return out


def initial(role: str) -> str:
    """The first character; a role without any is like no known one."""
    return role[:1] or " "


class Conversation:
    """Turns of one conversation as they come; repaired turns as soon as they are certain."""

    def __init__(self, key: tuple[int, bool]):
        self.key, self.repair, self.waiting, self.audit = key, Repair(), [], []
        self.state, self.place, self.first = START, 0, 0
        self.low = self.high = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def take(self, turn: int | None, role: str, text: str, n: int, blank: bool, again: bool, cut: bool) -> Iterator[tuple]:
        """``n`` equal turns, of which all but the first repeat one."""
        mine = initial(role)
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.distinct += 1
        self.illegal += n - 1 + (self.last is not None and self.last + mine not in _LEGAL)
        self.last = mine
        self.blank += n * blank
        self.duplicate += 0 if blank else n - 1 + again
        self.truncated += cut and not blank and not again
        for nth in range(n):
            must_go = blank or again or nth > 0
            self.waiting.append((role, "" if must_go else text))
            self.repair.turn(mine, cut, must_go)
            if settled := self.repair.settled():
                yield from self._apply(settled)

    def _apply(self, audit: str) -> Iterator[tuple]:
        self.audit.append(audit)
        for c in audit:
            role, text = ("", "") if c == "I" else self.waiting[self.first]
            self.first += c != "I"
            if c == "D":
                continue
            self.state = SYSTEM if c == "K" and initial(role) == "s" else _NEXT[self.state]
            self.place += 1
            yield *self.key, self.place, role if c == "K" else ROLES[self.state], text, *(None,) * 7
        self.waiting, self.first = self.waiting[self.first :], 0

    def close(self) -> Iterator[tuple]:
        cost, rest = self.repair.end()
        yield from self._apply(rest)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        yield (*self.key, None, None, None, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
               "".join(self.audit))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of whole conversations in; repaired turns, and a row for each conversation, out."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]

    def rows() -> Iterator[tuple]:
        now = None
        for batch in batches:
            for key, no_key, *turn in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.key != (key, no_key):
                    if now:
                        yield from now.close()
                    now = Conversation((key, no_key))
                yield from now.take(*turn)
        if now:
            yield from now.close()

    def packed(some: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=names)

    some, size = [], 0
    for row in rows():
        some.append(row)
        size += 64 + len(row[4] or "") + len(row[-1] or "")
        if size > 4 << 20:
            yield packed(some)
            some, size = [], 0
    if some:
        yield packed(some)


def faults(turns: DataFrame) -> DataFrame:
    """Different turns with n, how often they stand, and their faults (columns of ROWS).

    ``again`` tells that an earlier turn of the conversation has this role and text; of n
    equal turns it tells so of the first one.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text").select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("doc_key"), F.col("conv_id").isNull().alias("no_key"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"))
    # Equal turns travel as one row, so a turn that stands a million times is no hot group.
    once = stored(rows.groupBy("doc_key", "no_key", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", F.lit(1), "role")}))
    # A null turn comes first. The turn is in the join's key, so a text said at a million turns is none either.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    first = once.groupBy("doc_key", "no_key", "h1", "h2").agg(F.min(turn).alias("f")).select(
        "doc_key", "no_key", "h1", "h2", "f.known", F.col("f.turn").alias("at"), F.lit(True).alias("new"))
    bare = F.btrim("text", F.lit(BLANKS))
    joined = once.withColumns({"known": F.col("turn").isNotNull(), "at": F.coalesce("turn", F.lit(0))}).join(
        first, ["doc_key", "no_key", "h1", "h2", "known", "at"], "left")
    return joined.select(
        "doc_key", "no_key", "turn", "role", "text", "n", (bare == "").alias("blank"), F.col("new").isNull().alias("again"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"), "h1", "h2")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired turns and the audit of each conversation of ``turns`` (conv_id, turn, role, text).

    Turns are taken by turn, nulls first; of equal ones by role, then by a digest of the text.
    A null role or text counts as one blank; a null conv_id is a conversation of its own. The
    first fault of a turn counts: blank (nothing but ASCII blanks), duplicate (role and text
    stood earlier), truncated (the last other character is none of ``.!?``). Keeping a turn
    costs 0, making it a user's or assistant's 2, deletion 3, an empty new turn 2; blank and
    duplicate turns must go, and a truncated one that stays adds 1. The cheapest edits that give
    role initials ``(s?(ua)+)?`` are taken, of equally cheap ones those whose initials (D, I, K,
    R) come first in ASCII. A role of no character is like an unknown one. Other columns are left
    out, repeated rows are duplicates, and an empty table gives two empty ones.

    A conversation is streamed through one task, which holds the turns that cheapest paths do not
    share yet, not its whole; equal turns are one row there.

    Returns (conv_id, place from 1, role, text), and (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit).
    """
    rows = faults(turns).repartition("doc_key", "no_key").sortWithinPartitions(
        "no_key", "doc_key", F.asc_nulls_first("turn"), "role", "h1", "h2").drop("h1", "h2")
    done = stored(rows.mapInArrow(_run, RESULT))
    conv_id = F.when(~F.col("no_key"), F.col("doc_key")).alias("conv_id")
    said = done.where("place is not null").select(conv_id, "place", "role", "text")
    audit = done.where("place is null").select(conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return said, audit


def damaged(conversations: DataFrame) -> DataFrame:
    """Test damage by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes out ``.!?``,
    3 repeats it, 4 makes it a user's. Nulls count as one blank in that key, and become one in role and text."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    rows = pick(conversations, "conv_id", "turn", "role", "text").withColumn("what", what).where("what <> 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    times = F.when(F.col("what") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")
