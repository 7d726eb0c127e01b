"""Character classes, the accent table and the stopword list."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# The whitespace set of Python's ``str.split`` and ``\s``. Java's own ``\s`` knows
# ASCII only. The Unicode property is one test per character; the same set
# spelled as ranges is several times slower.
_WS_SET = r"\p{IsWhite_Space}\x1c-\x1f"
WS = f"[{_WS_SET}]"
NWS = f"[^{_WS_SET}]"
NWS_NOT_AT = f"[^@{_WS_SET}]"
# Python's Unicode ``\w``.
W = r"[\p{L}\p{N}_]"

# The same whitespace as a plain string, for trim().
WS_CHARS = "".join(
    c for c in map(chr, range(0x3001)) if c.isspace()
)

# Words that never count as content (118 distinct).
STOPWORDS = tuple(
    """
    el la de que y a en un ser se no haber
    por con su para como estar tener le lo todo
    pero más hacer o poder decir este ir otro ese
    si me ya ver porque dar cuando muy sin vez
    mucho saber qué sobre mi alguno mismo yo también
    hasta año dos querer entre así primero desde grande
    eso ni nos llegar pasar tiempo ella sí día uno
    bien poco deber entonces poner cosa tanto hombre
    parecer nuestro tan donde ahora parte después vida
    quedar siempre creer hablar llevar dejar nada cada
    seguir menos nuevo encontrar algo solo estos trabajar
    ha han he has son es fue sido está están esta
    las los del al una
    """.split()
)


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Characters whose accent-free form is one other character, and that form.

    Built by rule from the Unicode decomposition; used with ``translate`` so
    that stripping accents stays inside the JVM.
    """
    source, target = [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        char = chr(code)
        bare = strip_accents_text(char)
        if len(bare) == 1 and bare != char and ord(bare) <= sys.maxunicode:
            source.append(char)
            target.append(bare)
    return "".join(source), "".join(target)


def strip_accents_text(text: str) -> str:
    """Decompose and drop nonspacing marks (``ñ`` becomes ``n``)."""
    return "".join(
        c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn"
    )
