"""Row-local functions over token-id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from precis.functions.text import _col
from precis.settings import END, PAD, START


def add_markers(seq: Column | str) -> Column:
    """START, the sequence, END."""
    return F.concat(F.array(F.lit(START)), _col(seq), F.array(F.lit(END)))


def pad(seq: Column | str, length: int, post: bool = True) -> Column:
    """Cut to the first ``length`` ids and fill up with PAD, after or before."""
    cut = F.slice(_col(seq), 1, length)
    filler = F.array_repeat(F.lit(PAD), F.lit(length) - F.size(cut))
    return F.concat(cut, filler) if post else F.concat(filler, cut)


def decoder_input(seq: Column | str, length: int) -> Column:
    """All but the last of ``length`` ids."""
    return F.slice(_col(seq), 1, length - 1)


def decoder_target(seq: Column | str, length: int) -> Column:
    """All but the first of ``length`` ids."""
    return F.slice(_col(seq), 2, length - 1)


def is_finished(seq: Column | str) -> Column:
    """The sequence ends in END: it is carried along, not expanded."""
    ids = _col(seq)
    return F.coalesce(F.try_element_at(ids, F.lit(-1)) == END, F.lit(False))
