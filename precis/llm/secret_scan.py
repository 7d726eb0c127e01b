"""Find secrets with a trigram inverted index; DataFrame functions only.

Each rule's regular expression gives a Boolean query over trigrams: every text
that matches must hold, for each of some groups, all trigrams of one of the
group's strings. Postings (trigram, document) are kept for the trigrams that
occur in a query, intersected, and the rule's expression then runs over the
documents that are left. A rule without mandatory trigrams runs over all.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as node
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.llm.common import KEY, keyed

#: Strings that one part of an expression may stand for before it is given up as too wide.
MOST_STRINGS = 64
#: Matches whose offsets are summed together.
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters; shorter matches are dropped without retry."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds first. Fixed values.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("bearer", r"(?i:bearer)\x20++[A-Za-z0-9._~+/=-]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    # The rest of a run that begins no token is taken with it (and dropped, as the group is
    # empty): no later start in the run can do better, so each run is tried once.
    Rule("jwt", r"eyJ((?:[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+)?+)[A-Za-z0-9_-]*+", 1, 1),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"://[^/\x20:@\n]++:[^/\x20:@\n]++@"),
)
BASE = ("assign", "access", "hex")


def _strings(item) -> list[str] | None:
    """All lower-case strings that one parsed item stands for; None if too many or unknown."""
    op, value = item
    if op is node.LITERAL:
        return [chr(value).lower()]
    if op is node.IN:
        out = set()
        for kind, x in value:
            if kind is node.LITERAL:
                out.add(chr(x).lower())
            elif kind is node.RANGE and x[1] - x[0] < MOST_STRINGS:
                out.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None
        return sorted(out) if len(out) <= 8 else None
    if op is node.SUBPATTERN:
        return _sequence(value[3])
    if op is node.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        return None if any(p is None for p in parts) else list(dict.fromkeys(itertools.chain(*parts)))
    if op in (node.MAX_REPEAT, node.MIN_REPEAT) and value[1] is not node.MAXREPEAT and value[1] <= 3:
        one = _sequence(value[2])
        if one is None:
            return None
        return ["".join(x) for n in range(value[0], value[1] + 1) for x in itertools.product(one, repeat=n)]
    return None


def _sequence(items) -> list[str] | None:
    out = [""]
    for item in items:
        more = _strings(item)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in more]
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Groups, all of which must hold; a group holds if all trigrams of one member are there."""
    groups, run = [], [""]
    for item in [*parser.parse(pattern), None]:
        more = _strings(item) if item else None
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = [a + b for a in run for b in more]
            continue
        if min(map(len, run)) >= 3:
            members = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
            # A member that asks for more than another one adds nothing.
            groups.append(sorted((m for m in members if not any(o < m for o in members)), key=sorted))
        run = [""] if more is None or len(more) > MOST_STRINGS else more
    return groups


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """k1, k2, rules: which rules with mandatory trigrams a document may match."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    terms = [(t, kind, g, m, len(member)) for kind, groups in queries.items()
             for g, group in enumerate(groups) for m, member in enumerate(group) for t in sorted(member)]
    rows = keyed(docs)
    if not terms:
        return rows.select(*KEY, F.array().cast("array<string>").alias("rules")).limit(0)
    low = rows.where("text is not null").select(*KEY, F.lower("text").alias("low"))
    present = F.array_compact(F.array(*(
        F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted({t[0] for t in terms}))))
    postings = low.select(*KEY, F.explode(present).alias("trigram")).repartition(*KEY)
    # The terms are as many as the rules make them, whatever the data.
    table = docs.sparkSession.createDataFrame(terms, "trigram string, kind string, g int, m int, size long")
    members = (
        postings.join(F.broadcast(table), "trigram")
        .groupBy(*KEY, "kind", "g", "m", "size").agg(F.count(F.lit(1)).alias("n")).where("n >= size")
    )
    groups = members.groupBy(*KEY, "kind").agg(F.count_distinct("g").alias("n"))
    enough = F.lit(False)
    for kind, query in queries.items():
        if query:
            enough = enough | ((F.col("kind") == kind) & (F.col("n") == len(query)))
    return groups.where(enough).groupBy(*KEY).agg(F.collect_set("kind").alias("rules"))


def _starts(sizes: Column) -> Column:
    """Sums of all earlier sizes, by blocks, so that many matches cost no quadratic copies."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, b: a + b)

    n = F.size(sizes)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
        lambda b: total(F.slice(sizes, b * BLOCK + 1, BLOCK)))
    before = F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b)))
    return F.transform(sizes, lambda _, i: F.get(before, F.floor(i / BLOCK).cast("int"))
                       + total(F.slice(sizes, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule: (start, order, kind, end), in code points."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    # Text between matches; one piece more than matches.
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.char_length(x))
    lengths = F.transform(found, lambda x: F.char_length(x))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), lengths, lambda g, n: g + n)
    zipped = F.arrays_zip(
        F.zip_with(_starts(steps), gaps, lambda a, g: a + g).alias("start"), lengths.alias("n"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.char_length(x)).alias("size"))
    good = F.filter(zipped, lambda s: s["n"].isNotNull() & (s["size"] >= rule.least))
    spans = F.transform(good, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("nth"), F.lit(rule.kind).alias("kind"), (s["start"] + s["n"]).alias("end")))
    return F.when(F.size(found) > 0, spans).otherwise(none())


def none() -> Column:
    return F.array().cast("array<struct<start:int,nth:int,kind:string,end:int>>")


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All secrets of every document by rule.

    Matches of a rule are leftmost and do not overlap; those of different rules may.
    Spans are ordered by start, then by the rule's place in ``rules`` (ties of both
    cannot be). Null and empty texts have none. Each row has its result, repeated
    rows too, and an empty table gives none.

    Returns doc_id, text, spans (array of start, nth, kind, end; code points, end exclusive).
    """
    rows = keyed(docs).join(candidates(docs, rules), list(KEY), "left")
    text, parts = F.coalesce("text", F.lit("")), []
    for i, rule in enumerate(rules):
        spans = _spans(text, rule, i)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("rules", rule.kind), spans).otherwise(none())
        else:
            spans = F.when(text.rlike(rule.pattern), spans).otherwise(none())
        parts.append(spans)
    return rows.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
