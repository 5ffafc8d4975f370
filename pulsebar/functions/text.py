"""Text predicates and clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsebar.layout import TRACK_WORDS

# runs of anything but printable ASCII and its white space (tab to return)
_NOT_PRINTABLE = r"[^\x09-\x0D\x20-\x7E]++"


def mentions(text: Column, word: str) -> Column:
    """True where ``text`` holds ``word``; case counts."""
    return text.contains(F.lit(word))


def tracked(text: Column, words: tuple[str, ...] = TRACK_WORDS) -> Column:
    """True where ``text`` holds any of the words, whatever its case."""
    lowered = F.lower(text)
    hits = [lowered.contains(F.lit(word.lower())) for word in words]
    return reduce(lambda a, b: a | b, hits)


def printable(text: Column) -> Column:
    """``text`` without the characters that are not printable ASCII."""
    return F.regexp_replace(text, _NOT_PRINTABLE, "")
