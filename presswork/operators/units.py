"""Amounts recorded in different units, converted to lakh of rupees.

An amount stated in the title is read with its currency and scale. The unit in
which the value column was filled is not recorded: where title and value are
both present their ratio tells it, and these rows train a calibrated tree
ensemble that predicts the missing unit of the others from magnitude, source,
category and neighbouring fields. Confident predictions are converted, the
rest is routed for review.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.functions.amounts import Amount, stated_amounts
from presswork.functions.trees import TreeEnsemble

#: Most labelled rows that the classifier is fitted on.
MAX_LABELLED = 20_000
#: Least calibrated confidence of a conversion; below it a row is routed for review.
CONFIDENT = 0.8
#: A filled value is right within this share of the stated amount.
TOLERANCE = 0.01
CRORE, LAKH = 1e7, 1e5
#: Most rows of a rates table.
MAX_RATES = 1_000
#: A bare number of rupees below this lacks its scale.
BARE = 1e5

#: Units in which a value may have been filled, and their size in rupees. ``usd_million`` follows the rate.
UNITS = {"crore": CRORE, "lakh": LAKH, "inr_million": 1e6, "inr_billion": 1e9, "rupee": 1.0}
CLASSES = ("crore", "lakh", "inr_million", "inr_billion", "rupee", "usd_million", "own_million", "other")


def read_rates(rates: DataFrame) -> dict[str, float]:
    """Rupees for one unit of each currency; refused beyond ``MAX_RATES`` rows."""
    rows = rates.select("currency_code", "inr_per_unit").limit(MAX_RATES + 1).collect()
    if len(rows) > MAX_RATES:
        raise ValueError(f"a rates table of more than {MAX_RATES} rows")
    return {r[0].strip().upper(): float(r[1]) for r in rows if r[0] and r[1] is not None}


def in_rupees(amount: Amount, rates: dict[str, float]) -> float | None:
    """An amount in rupees; null where the currency has no rate."""
    rate = rates.get(amount.currency)
    return amount.value * rate if rate else None


def filled_unit(value: float, stated: float, currency: str, rates: dict[str, float]) -> str:
    """The unit in which ``value`` was filled, given the stated rupees."""
    sizes = dict(UNITS)
    if "USD" in rates:
        sizes["usd_million"] = 1e6 * rates["USD"]
    if currency != "INR" and currency in rates:
        sizes["own_million"] = 1e6 * rates[currency]
    off = {u: abs(value * s - stated) / stated for u, s in sizes.items()} if stated > 0 else {}
    best = min(off, key=lambda u: (off[u], CLASSES.index(u))) if off else "other"
    return best if off and off[best] <= 0.02 else "other"


def _code(text: str | None) -> float:
    """A number for a category of unbounded variety."""
    return float(zlib.crc32(text.strip().lower().encode()) % 1021) if text else -1.0


FEATURES = ("contract_value_inr_crore", "source", "category_tag", "sbu_tagging", "geography", "competitor_tier", "relevance_score", "summary")


def features(row: dict, rates: dict[str, float]) -> list[float]:
    """Magnitude, shape of the number, source, category, and neighbouring fields."""
    value = row["contract_value_inr_crore"]
    size = math.log10(value) if value and value > 0 else -9.0
    text = f"{value:.6f}".rstrip("0") if value is not None else "."
    near = [in_rupees(a, rates) for a in stated_amounts(row["summary"])]
    near = [n for n in near if n and n > 0]
    return [
        size,
        float(len(text.partition(".")[2])),
        float(len(text.partition(".")[0]) - len(text.partition(".")[0].rstrip("0"))),
        _code(row["source"]),
        _code(row["category_tag"]),
        _code(row["sbu_tagging"]),
        _code(row["geography"]),
        float(row["competitor_tier"] if row["competitor_tier"] is not None else -1),
        float(row["relevance_score"] if row["relevance_score"] is not None else -1),
        size - math.log10(near[0] / CRORE) if near and size > -9 else 99.0,
        math.log10(near[0]) if near else -9.0,
    ]


class UnitModel:
    """The classifier with its rates, as it is sent to the workers."""

    def __init__(self, rates: dict[str, float], ensemble: TreeEnsemble | None):
        self.rates, self.ensemble = rates, ensemble

    def predict(self, rows: list[dict]) -> list[tuple[str | None, float]]:
        if self.ensemble is None or not rows:
            return [(None, 0.0)] * len(rows)
        kinds, sure = self.ensemble.predict(np.array([features(r, self.rates) for r in rows]))
        return [(CLASSES[k], float(c)) for k, c in zip(kinds, sure)]

    def size(self, unit: str | None) -> float | None:
        """Rupees of one filled unit; null where it can't be known."""
        return 1e6 * self.rates["USD"] if unit == "usd_million" and "USD" in self.rates else UNITS.get(unit)


def labelled(rows: list[dict], rates: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Features and unit classes of rows whose title states the amount."""
    x, y = [], []
    for row in rows:
        amounts = [a for a in stated_amounts(row["news_title"]) if a.scaled or a.currency != "INR" or a.value >= BARE]
        rupees = in_rupees(amounts[0], rates) if amounts else None
        value = row["contract_value_inr_crore"]
        if rupees and value is not None and value > 0 and math.isfinite(value):
            x.append(features(row, rates))
            y.append(CLASSES.index(filled_unit(value, rupees, amounts[0].currency, rates)))
    return np.array(x).reshape(-1, len(features(dict.fromkeys(FEATURES), rates))), np.array(y, int)


def fit_units(articles: DataFrame, rates: dict[str, float], most: int = MAX_LABELLED) -> UnitModel:
    """The model fitted on about ``most`` rows (never more) with a value and a title, chosen by a hash of their id; two
    thirds grow the trees and one third calibrates them. Fewer than 30 labelled rows give a model that is never
    confident. Only the chosen rows leave the executors."""
    usable = articles.filter(F.col("contract_value_inr_crore").isNotNull() & F.col("news_title").rlike(r"[0-9₹$€£¥]|(?i)hundred|crore"))
    total = usable.count()
    share = 1.0 if total <= most else 0.97 * most / total
    part = F.pmod(F.xxhash64("article_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = usable.filter(part).select("article_id", "news_title", *FEATURES).limit(most).toPandas().sort_values("article_id")
    rows = sample.astype(object).where(sample.notna(), None).to_dict("records")
    x, y = labelled(rows, rates)
    if len(y) < 30:
        return UnitModel(rates, None)
    third = np.arange(len(y)) % 3 == 2
    ensemble = TreeEnsemble().fit(x[~third], y[~third], len(CLASSES)).calibrate(x[third], y[third])
    return UnitModel(rates, ensemble)


def common_units(articles: DataFrame, model: UnitModel, confident: float = CONFIDENT) -> DataFrame:
    """Each article that states or holds an amount, in common units.

    ``article_id``, ``stated_lakh`` (of the title; null if it states none),
    ``filled_crore`` (the column as filled), ``filled_unit`` (by the ratio
    where the title states the amount, else predicted), ``confidence``,
    ``value_inr_lakh`` (rounded; null under review) and ``route``: ``stated``,
    ``converted`` or ``review``. A stated number without scale takes the
    predicted unit of its filled value if that is confident. Rows without any
    amount do not come out; NaN, infinite and non-positive values are as null.
    """
    columns = ("article_id", "news_title", *FEATURES)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rates = model.rates
        for batch in batches:
            out = []
            asked: list[tuple[int, dict]] = []
            for row in batch.to_pylist():
                value = row["contract_value_inr_crore"]
                usable = value is not None and math.isfinite(value) and value > 0
                amounts = stated_amounts(row["news_title"])
                rupees = in_rupees(amounts[0], rates) if amounts else None
                bare = rupees is not None and not amounts[0].scaled and amounts[0].currency == "INR" and amounts[0].value < BARE
                if rupees is not None and not bare:
                    unit = filled_unit(value, rupees, amounts[0].currency, rates) if usable and rupees > 0 else None
                    out.append([row["article_id"], rupees / LAKH, value, unit, 1.0 if unit else None, round(rupees / LAKH), "stated"])
                elif usable:
                    asked.append((len(out), row))
                    out.append([row["article_id"], None, value, None, None, amounts[0].value if bare else None, "review"])
            for (at, row), (unit, sure) in zip(asked, model.predict([r for _, r in asked])):
                size, number = model.size(unit), out[at][5]
                out[at][3:6] = unit, sure, None
                if size is not None and sure >= confident:
                    out[at][5:] = round(row["contract_value_inr_crore"] * size / LAKH), "converted"
                    if number is not None:
                        out[at][1], out[at][5] = number * size / LAKH, round(number * size / LAKH)
            kinds = (pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.float64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 7, kinds)], names=names)

    names = ["article_id", "stated_lakh", "filled_crore", "filled_unit", "confidence", "value_inr_lakh", "route"]
    schema = "article_id bigint, stated_lakh double, filled_crore double, filled_unit string, confidence double, value_inr_lakh bigint, route string"
    return articles.select(*columns).mapInArrow(convert, schema)


def wrong_values(common: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``article_id``, ``value_inr_lakh`` where the title states an amount and the filled value is missing or off by more than ``tolerance``."""
    stated = F.col("stated_lakh") / (CRORE / LAKH)
    return common.filter(
        F.col("stated_lakh").isNotNull() & (F.col("filled_crore").isNull() | F.isnan("filled_crore") | (F.abs(F.col("filled_crore") - stated) > tolerance * stated))
    ).select("article_id", "value_inr_lakh")
