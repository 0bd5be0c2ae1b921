"""Likeness of titles and names."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no content in a headline.
STOP_WORDS = (
    "a an the and or but in on at to for of with by from as is was are were been be have has had do does did will would "
    "can could should may might must its their worth order contract project wins bags secures gets receives awarded adds another growing book"
).split()


def title_words(title: Column) -> Column:
    """Distinct words of a title without the words that carry no content."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(title), F.lit(r"(?U)(\w+)"), F.lit(1)))
    return F.array_except(words, F.array(*map(F.lit, STOP_WORDS)))


def core_match(a: Column, b: Column, percent: int = 60) -> Column:
    """Whether two word sets share ``percent`` of the smaller; false if one is empty or null."""
    smaller = F.least(F.size(a), F.size(b))
    return F.coalesce((smaller > 0) & (F.size(F.array_intersect(a, b)) * 100 >= smaller * percent), F.lit(False))


def _ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    matcher = SequenceMatcher(None)
    for first, second in pairs:
        out, last = [], None
        for a, b in zip(first, second):
            if a is None or b is None:
                out.append(None)
                continue
            if b != last:
                matcher.set_seq2(b)
                last = b
            matcher.set_seq1(a)
            out.append(matcher.ratio())
        yield pd.Series(out, dtype="float64")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp likeness, order of arguments as given; null if either is null."""
    return F.pandas_udf(_ratios, "double")(a, b)


def ratio_bound(a: Column, b: Column) -> Column:
    """What the ratio of two texts of these lengths can reach at most."""
    return 2 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def letter_counts(text: Column) -> Column:
    """How often each letter a to z, each digit and the space occur, for ``letters_bound``."""
    kinds = "abcdefghijklmnopqrstuvwxyz0123456789 "
    return F.array(*[F.length(text) - F.length(F.replace(text, F.lit(k), F.lit(""))) for k in kinds])


def letters_bound(a: Column, b: Column, length_a: Column, length_b: Column) -> Column:
    """What the ratio can reach at most, from the counts of ``letter_counts``: shared letters, and all other characters as if shared."""
    shared = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda t, n: t + n)
    counted_a = F.aggregate(a, F.lit(0), lambda t, n: t + n)
    counted_b = F.aggregate(b, F.lit(0), lambda t, n: t + n)
    rest = F.least(length_a - counted_a, length_b - counted_b)
    return 2 * (shared + rest) / F.greatest(length_a + length_b, F.lit(1))
