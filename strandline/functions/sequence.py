"""Column expressions over read sequences and Phred quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHRED_OFFSET = 33


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: str | Column) -> Column:
    return F.reverse(F.translate(_c(seq), "ACGTNacgtn", "TGCANtgcan"))


def base_count(seq: str | Column, bases: str) -> Column:
    """Number of characters of ``seq`` that are among ``bases``."""
    s = _c(seq)
    return (F.length(s) - F.length(F.translate(s, bases, ""))).cast("int")


def gc_count(seq: str | Column) -> Column:
    return base_count(seq, "GCgc")


def quals(qual: str | Column) -> Column:
    """Phred+33 string -> array<int>."""
    return F.transform(F.split(_c(qual), ""), lambda ch: F.ascii(ch) - PHRED_OFFSET)
