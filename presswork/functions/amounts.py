"""Money amounts stated in running text."""

from __future__ import annotations

import re
from typing import NamedTuple

#: How currencies are written.
CURRENCY = {
    "₹": "INR", "rs": "INR", "rs.": "INR", "inr": "INR", "rupee": "INR", "rupees": "INR",
    "$": "USD", "us$": "USD", "usd": "USD", "dollar": "USD", "dollars": "USD",
    "€": "EUR", "eur": "EUR", "euro": "EUR", "euros": "EUR",
    "£": "GBP", "gbp": "GBP", "pound": "GBP", "pounds": "GBP",
    "aed": "AED", "dh": "AED", "dhs": "AED", "dh.": "AED", "dhs.": "AED", "dirham": "AED", "dirhams": "AED",
    "sar": "SAR", "sr": "SAR", "riyal": "SAR", "riyals": "SAR",
    "¥": "JPY", "jpy": "JPY", "yen": "JPY",
}
#: How scales are written, and their size.
SCALE = {
    "lakh crore": 1e12, "lakh crores": 1e12, "lac crore": 1e12, "lac crores": 1e12,
    "crore": 1e7, "crores": 1e7, "cr": 1e7, "crs": 1e7,
    "lakh": 1e5, "lakhs": 1e5, "lac": 1e5, "lacs": 1e5,
    "million": 1e6, "millions": 1e6, "mn": 1e6, "mln": 1e6, "m": 1e6,
    "billion": 1e9, "billions": 1e9, "bn": 1e9, "b": 1e9,
    "trillion": 1e12, "tn": 1e12, "thousand": 1e3, "k": 1e3,
}
_UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUMBER_WORDS = {w: i for i, w in enumerate(_UNITS)} | {w: 10 * (i + 2) for i, w in enumerate(_TENS)}


def _any(words) -> str:
    return "|".join(sorted((re.escape(w).replace(r"\ ", r"\s+") for w in words), key=len, reverse=True))


_SPELLED = r"(?:(?:{w}|hundred|thousand|and)(?:[\s-]+(?:{w}|hundred|thousand|and))*)".format(w=_any(NUMBER_WORDS))
_DIGITS = r"\d[\d,]*(?:\.\d+)?"
_LEADING = re.compile(
    rf"(?<![^\W_])(?P<cur>{_any(c for c in CURRENCY if c not in {'rupee', 'dollar', 'euro', 'pound', 'yen', 'rupees', 'dollars', 'euros', 'pounds'})})\s*"
    rf"(?P<num>{_DIGITS}|{_SPELLED}\b)(?:\s*-?\s*(?P<scale>{_any(SCALE)})(?![^\W\d_]))?"
)
_TRAILING = re.compile(
    rf"(?<![\w.,])(?P<num>{_DIGITS}|{_SPELLED}\b)\s*-?\s*(?P<scale>{_any(s for s in SCALE if len(s) > 1)})(?![^\W\d_])"
    rf"(?:\s+(?P<cur>{_any(c for c in CURRENCY if len(c) > 2 and c.isalpha())})\b)?"
)
#: What follows a price, not an amount.
_PRICE = re.compile(r"\s*(?:per\b|/|apiece\b|each\b|an?\s+(?:share|unit|piece|scrip|kwh|mwh|tonne|litre|equity)\b)")
_SINGLE = re.compile(r"[\d.,₹$€£¥]|crore|\bcr|lakh|lac|million|mn|billion|bn|hundred|thousand|rupee")


class Amount(NamedTuple):
    """An amount in units of its currency; ``scaled`` tells whether the text names a scale."""

    value: float
    currency: str
    scaled: bool


def spelled_number(words: str) -> float | None:
    """The number that English words spell; null if they spell none."""
    total = current = 0
    some = False
    for word in re.findall(r"[a-z]+", words):
        if word in NUMBER_WORDS:
            current += NUMBER_WORDS[word]
        elif word == "hundred":
            current = max(current, 1) * 100
        elif word == "thousand":
            total, current = total + max(current, 1) * 1000, 0
        else:
            continue
        some = True
    return float(total + current) if some else None


def stated_amounts(text: str | None) -> list[Amount]:
    """All money amounts that a text states, in order; prices per share or unit are left out."""
    if not text or not _SINGLE.search(text.lower()):
        return []
    lowered = text.lower()
    found: list[tuple[int, int, Amount]] = []
    for pattern in (_LEADING, _TRAILING):
        for m in pattern.finditer(lowered):
            if any(begin < m.end() and m.start() < end for begin, end, _ in found):
                continue
            digits, scale = m["num"], m["scale"]
            number = float(digits.replace(",", "")) if digits[0].isdigit() else spelled_number(digits)
            scale = " ".join(scale.split()) if scale else None
            currency = CURRENCY.get(m["cur"]) if m["cur"] else "INR" if scale and SCALE[scale] in (1e5, 1e7) or scale and "c" in scale else None
            if number is None or currency is None:
                continue
            priced = _PRICE.match(lowered, m.end()) is not None
            found.append((m.start(), m.end(), Amount(-1.0 if priced else number * (SCALE[scale] if scale else 1.0), currency, scale is not None)))
    return [a for _, _, a in sorted(found, key=lambda f: f[0]) if a.value >= 0]
