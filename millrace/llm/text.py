"""Column expressions for the word and line rules that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Array of the ``[^\\x20\\x09-\\x0D]+`` runs of ``text``; null text has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(flat, " "), "")


def word_count(text: Column) -> Column:
    """Number of words of ``text`` as a long."""
    return F.size(words(text)).cast("long")


def unit_hash(*cols: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on ``cols`` and ``seed`` alone, so that reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)
