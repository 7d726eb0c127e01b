"""Row-local text functions: Column in, Column out, no shuffle.

All patterns are written so that Java's backtracking engine stays linear on
hostile input (a megabyte of dots, or one unbroken run of characters).
"""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from precis.functions.chars import (
    NWS,
    NWS_NOT_AT,
    STOPWORDS,
    W,
    WS,
    WS_CHARS,
    accent_table,
    strip_accents_text,
)

URL = f"http{NWS}+|www{NWS}+"
MENTION = f"[@#]{W}+"
# Same matches as \S+@\S+ : such a match always spans a whole run of
# non-blank characters, so it is enough to try once per run.
EMAIL = f"(?<!{NWS}){NWS}{NWS_NOT_AT}*+@{NWS}++"
# Same matches as [.!?]+\s+ , tried once per run of marks.
SENTENCE_END = f"(?<![.!?])[.!?]++{WS}++"
MARKS = "[.!?]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_ws(c: Column | str) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def strip_accents(c: Column | str) -> Column:
    """Drop accents inside the JVM; exact for Latin scripts."""
    source, target = accent_table()
    return F.regexp_replace(F.translate(_col(c), source, target), r"\p{Mn}+", "")


@F.pandas_udf(StringType())
def strip_accents_exact(texts: pd.Series) -> pd.Series:
    """Drop accents by the Unicode tables of Python, for every script."""
    return texts.map(strip_accents_text, na_action="ignore")


def _without(text: Column, pattern: str, *marks: str) -> Column:
    """Drop a pattern whose matches all hold one of some marks; texts without a mark are not searched."""
    def drop(t: Column) -> Column:
        marked = reduce(or_, (F.contains(t, F.lit(m)) for m in marks))
        return F.when(marked, F.regexp_replace(t, pattern, "")).otherwise(t)

    return let(text, drop)


def clean_text(
    c: Column | str,
    keep_accents: bool = True,
    lowercase: bool = True,
    emails_first: bool = False,
    exact_accents: bool = False,
) -> Column:
    """Full cleaning: URLs, mentions, hashtags, e-mails, blanks, accents.

    Mentions go before e-mails, so ``juan@ejemplo.com`` leaves ``juan.com``;
    ``emails_first`` turns the two steps round.
    """
    text = F.coalesce(_col(c), F.lit(""))
    if lowercase:
        text = F.lower(text)
    text = _without(text, URL, "http", "www")
    mentions, emails = (MENTION, "@", "#"), (EMAIL, "@")
    for pattern, *marks in [emails, mentions] if emails_first else [mentions, emails]:
        text = _without(text, pattern, *marks)
    text = F.regexp_replace(text, f"{WS}+", " ")
    if not keep_accents:
        text = strip_accents_exact(text) if exact_accents else strip_accents(text)
    return F.trim(text)


def clean_light(c: Column | str) -> Column:
    """Light cleaning before summarising: keeps line breaks."""
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    text = _without(text, URL, "http", "www")
    return trim_ws(_without(text, MENTION, "@", "#"))


def tokens(c: Column | str, strip_punct: bool = False) -> Column:
    """Words between whitespace; an empty or blank text has none.

    ``strip_punct`` takes ASCII punctuation off both ends of words, and leaves out
    words that are nothing else.
    """
    text = trim_ws(F.coalesce(_col(c), F.lit("")))
    words = F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(text, f"{WS}+")
    )
    if not strip_punct:
        return words
    bare = F.transform(words, lambda w: F.btrim(w, F.lit(string.punctuation)))
    return F.filter(bare, lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(tokens(c))


def _pieces(text: Column, pattern: str) -> Column:
    parts = F.transform(F.split(text, pattern), trim_ws)
    return F.filter(parts, lambda s: s != "")


def split_sentences(c: Column | str) -> Column:
    """Sentences end in marks followed by whitespace; the last mark stays."""
    return _pieces(F.coalesce(_col(c), F.lit("")), SENTENCE_END)


def split_fragments(c: Column | str) -> Column:
    """Non-blank lines, or sentences of over three words if those are more.

    Sentences are tried only for texts of at most three lines.
    """
    text = F.coalesce(_col(c), F.lit(""))

    def choose(lines: Column) -> Column:
        sentences = F.filter(
            _pieces(text, MARKS), lambda s: F.size(F.split(s, f"{WS}+")) > 3
        )
        return F.when(F.size(lines) > 3, lines).otherwise(
            let(sentences, lambda s: F.when(F.size(s) > F.size(lines), s).otherwise(lines))
        )

    return let(_pieces(text, "\n"), choose)


def is_long(word: Column) -> Column:
    return F.length(word) > 2


def is_content(word: Column) -> Column:
    """Longer than two characters and not a stopword."""
    return is_long(word) & ~word.isin(*STOPWORDS)


def content_words(words: Column | str) -> Column:
    return F.filter(_col(words), is_content)


def preview(c: Column | str, width: int = 200, always: bool = False) -> Column:
    """The first characters and ``...``; ``always`` adds the dots to any text."""
    text = _col(c)
    short = F.concat(F.substring(text, 1, width), F.lit("..."))
    return short if always else F.when(F.length(text) > width, short).otherwise(text)


def has_words(c: Column | str) -> Column:
    """Neither missing nor blank."""
    return trim_ws(F.coalesce(_col(c), F.lit(""))) != ""


def join_fragments(kept: Column | str, n_fragments: Column | str) -> Column:
    """Join by ``. ``; two fragments or fewer always get a closing dot.

    With more fragments the dot is added only where it is missing, and no
    fragments give the empty text.
    """
    n = _col(n_fragments)
    body = F.array_join(_col(kept), ". ")
    return (
        F.when(n == 0, F.lit(""))
        .when((n <= 2) | ~body.endswith("."), F.concat(body, F.lit(".")))
        .otherwise(body)
    )
