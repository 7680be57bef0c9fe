"""Keyword matching: edit distance per word inside the scan, and deletion variants that make it an equi-join."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def allowed_edits(word: str) -> int:
    """Edits tolerated for a search word: none up to 2 letters, one up to 5, two beyond."""
    return 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2


def words(text: Column) -> Column:
    return F.split(F.lower(text), "[^\\p{L}\\p{N}]+")


def word_distance(text: Column, keyword: str) -> Column:
    """Smallest edit distance between any word of ``text`` and any word of ``keyword``.

    Null where no pair is within the tolerance. A swap of two letters counts as two edits.
    """
    best = []
    for term in re.findall(r"\w+", keyword.lower()):
        limit = allowed_edits(term)
        gaps = F.transform(words(text), lambda w: F.levenshtein(w, F.lit(term), limit))
        best.append(F.array_min(F.filter(gaps, lambda g: g >= 0)))
    if not best:
        return F.lit(None).cast("int")
    return best[0] if len(best) == 1 else F.least(*best)


def edits_for(word: Column) -> Column:
    """``allowed_edits`` of a column of words."""
    return F.when(F.length(word) <= 2, 0).when(F.length(word) <= 5, 1).otherwise(2)


def _shorter(word: Column) -> Column:
    """Every string that is the word without one character."""
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))),
                      lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when(F.length(word) > 0, cut).otherwise(F.array().cast("array<string>"))


def deletion_variants(word: Column, edits: Column) -> Column:
    """The word and every string that dropping up to ``edits`` (two at most) of its characters leaves.

    Two words within that many edits of each other have a variant in common.
    """
    none = F.array().cast("array<string>")
    one = F.when(edits >= 1, _shorter(word)).otherwise(none)
    two = F.when(edits >= 2, F.flatten(F.transform(one, _shorter))).otherwise(none)
    return F.array_distinct(F.concat(F.array(word), one, two))
