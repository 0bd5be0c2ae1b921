"""Contract values found in titles, and when two values count as alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number patterns with the factor that brings them to crore of rupees.
BARE_RUPEES = r"(?i)(?:rs|₹|inr)\.?\s*([\d,]+)"
SCALED = (
    (r"(?i)(?:rs|₹|inr)?\.?\s*(\d+(?:[,.]\d+)*)\s*(?:crore|cr)", 1.0),
    (r"(?i)(?:rs|₹|inr)?\.?\s*(\d+(?:[,.]\d+)*)\s*(?:lakh|lac)", 0.01),
    (r"(?i)(\d+(?:[,.]\d+)*)\s*(?:million|mn)", 8.5),
)
#: A bare number above this counts as full rupees, and their number in a crore.
FULL_RUPEES, CRORE = 100_000.0, 10_000_000.0


def extract_numbers(text: Column) -> Column:
    """All contract values of a text in crore, rounded to two places, bare rupee amounts first.

    Repeated values are kept. Bare amounts of up to 100,000 are taken as crore
    already. What can't be read as a number is left out; null gives none.
    """

    def number(match: Column) -> Column:
        return F.replace(match, F.lit(","), F.lit("")).try_cast("double")

    bare = F.transform(
        F.regexp_extract_all(text, F.lit(BARE_RUPEES), F.lit(1)),
        lambda m: F.round(F.when(number(m) > FULL_RUPEES, number(m) / CRORE).otherwise(number(m)), 2),
    )

    def in_crore(pattern: str, factor: float) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda m: F.round(number(m) * factor, 2))

    scaled = [in_crore(pattern, factor) for pattern, factor in SCALED]
    none = F.array().cast("array<double>")
    return F.coalesce(F.filter(F.concat(bare, *scaled), lambda n: n.isNotNull()), none)


def similar_numbers(a: Column, b: Column, percent: float = 10.0) -> Column:
    """Whether some positive number of ``a`` is less than ``percent`` of the larger away from one of ``b``."""
    return F.exists(
        a, lambda x: F.exists(b, lambda y: (x > 0) & (y > 0) & (F.abs(x - y) / F.when((x > 0) | (y > 0), F.greatest(x, y)) * 100 < percent))
    )


def values_similar(a: Column, b: Column, tolerance: float = 0.1) -> Column:
    """Whether two numbers are at most ``tolerance`` of the larger apart; two zeros are, zero and another are not, nor is null."""
    near = F.when((a == 0) & (b == 0), F.lit(True)).when((a == 0) | (b == 0), F.lit(False))
    return F.coalesce(near.otherwise(F.try_divide(F.abs(a - b), F.greatest(a, b)) <= tolerance), F.lit(False))
