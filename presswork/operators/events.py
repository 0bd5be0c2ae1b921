"""Whether two extracted fact records tell of the same event, by rules per category."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.text import strip

#: Facts that are extracted for each category, and for all others.
FACTS = {
    "order wins": ("company", "client_or_authority", "contract_value_crore", "scope", "location"),
    "bidding activity": ("companies_bidding", "client_or_authority", "project_value_crore", "scope", "location"),
    "financial": ("company", "period", "revenue_crore", "profit_crore", "order_book_crore"),
    "project execution": ("company", "project_name", "capacity_or_scale", "location", "milestone"),
    "mergers & acquisitions": ("acquirer", "target_company", "deal_value_crore", "stake_percent"),
    "partnerships & alliances": ("companies_involved", "deal_type", "sector", "value_crore"),
    "stock market": ("company", "price_movement_percent", "trigger_event"),
    "regulatory & policy": ("authority", "policy_or_rule", "sector_affected"),
    "industry trends": ("topic", "key_stat", "geography"),
    "legal & disputes": ("company", "counterparty", "issue_type", "value_crore"),
}
OTHER_FACTS = ("company", "event_type", "value", "location")

Facts = dict[str, str | None]
Check = Callable[[Facts, Facts], bool]


@lru_cache(maxsize=100_000)
def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp likeness."""
    return SequenceMatcher(None, a, b).ratio()


@lru_cache(maxsize=20_000)
def _places(text: str) -> dict[str, int]:
    """The places of each character as bits."""
    found: dict[str, int] = {}
    for at, character in enumerate(text):
        found[character] = found.get(character, 0) | 1 << at
    return found


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, which the matching blocks of a likeness don't exceed."""
    places = _places(a)
    whole = unmatched = (1 << len(a)) - 1
    for character in b:
        met = unmatched & places.get(character, 0)
        if met:
            unmatched = ((unmatched + met) | (unmatched - met)) & whole
    return len(a) - unmatched.bit_count()


def above(a: str, b: str, least: float) -> bool:
    """Whether two texts are more than ``least`` alike; their lengths or their common subsequence may already refuse it."""
    both = len(a) + len(b)
    if both and not (2.0 * min(len(a), len(b)) / both > least and 2.0 * common_length(a, b) / both > least):
        return False
    return ratio(a, b) > least


def _plain(value: str | None) -> str:
    return str(value).lower().strip() if value is not None else ""


def names_match(a: str | None, b: str | None, least: float = 0.8) -> bool:
    """Both given, and equal, one inside the other, or more than ``least`` alike."""
    if not a or not b:
        return False
    x, y = _plain(a), _plain(b)
    return x in y or y in x or above(x, y, least)


def values_match(a: str | None, b: str | None, tolerance: float = 0.1) -> bool:
    """Both read as numbers and are at most ``tolerance`` of the larger apart; zero only matches zero."""
    try:
        x, y = float(a), float(b)
    except (TypeError, ValueError):
        return False
    if x == 0 or y == 0:
        return x == y
    return abs(x - y) / max(x, y) <= tolerance


def reading(field: str, check: Check) -> Check:
    """``check``, marked with the only field that it reads."""
    check.field = field
    return check


def needing(kind: str, field: str, check: Check) -> Check:
    """``check``, marked with what it needs and the engine can test: ``given``, ``value`` or ``same`` of a field."""
    check.needs = (kind, field)
    return reading(field, check)


def name(field: str) -> Check:
    """Check: the names are given and match."""
    return needing("given", field, lambda f, g: names_match(f.get(field), g.get(field)))


def unless_missing(field: str, alike: Callable[[str, str], bool]) -> Check:
    """Check: alike, or missing on either side."""
    return reading(field, lambda f, g: not f.get(field) or not g.get(field) or alike(f[field], g[field]))


def value(field: str) -> Check:
    return needing("value", field, unless_missing(field, values_match))


def same(field: str) -> Check:
    return needing("same", field, unless_missing(field, lambda a, b: _plain(a) == _plain(b)))


def nearly(field: str, least: float) -> Check:
    return unless_missing(field, lambda a, b: not _plain(a) or not _plain(b) or above(_plain(a), _plain(b), least))


def inside(field: str) -> Check:
    return unless_missing(field, lambda a, b: _plain(a) in _plain(b) or _plain(b) in _plain(a))


def either(*checks: Check) -> Check:
    def check(f: Facts, g: Facts) -> bool:
        return any(c(f, g) for c in checks)

    check.parts = checks
    return check


def given(field: str, check: Check) -> Check:
    return needing(
        "given", field, lambda f, g: bool(f.get(field)) and bool(g.get(field)) and bool(_plain(f[field])) and bool(_plain(g[field])) and check(f, g)
    )


#: All checks of a category must hold.
RULES: dict[str, tuple[Check, ...]] = {
    "order wins": (name("company"), value("contract_value_crore"), either(name("client_or_authority"), inside("scope")), same("location")),
    "bidding activity": (name("client_or_authority"), value("project_value_crore"), same("location")),
    "financial": (name("company"), same("period"), value("revenue_crore")),
    "mergers & acquisitions": (name("acquirer"), name("target_company"), value("deal_value_crore")),
    "partnerships & alliances": (given("companies_involved", nearly("companies_involved", 0.7)), same("sector")),
    "project execution": (name("company"), same("location"), nearly("capacity_or_scale", 0.7)),
    "stock market": (name("company"), nearly("trigger_event", 0.7)),
}


def most_facts(f: Facts, g: Facts, share: float = 0.6, least: float = 0.75) -> bool:
    """Of the facts of ``f`` given on both sides, ``share`` are equal or more than ``least`` alike; none given is no match."""
    both = [k for k in f if f[k] and g.get(k)]
    hits = sum(1 for k in both if _plain(f[k]) == _plain(g[k]) or above(_plain(f[k]), _plain(g[k]), least))
    return bool(both) and hits / len(both) >= share


def same_event(f: Facts | None, g: Facts | None, category: str | None) -> bool:
    """Whether two records of facts match by the rules of their category. Facts that are null or empty count as missing;
    a record without facts matches none."""
    if not f or not g:
        return False
    checks = RULES.get((category or "").lower())
    return all(c(f, g) for c in checks) if checks else most_facts(f, g)


class Records:
    """Facts of many rows, each field as codes of its distinct values, so that a check is asked once for a pair of values."""

    def __init__(self, facts: list[Facts]):
        self.given = np.array([bool(f) for f in facts], dtype=bool)
        self.values: dict[str, list[str | None]] = {}
        self.codes: dict[str, np.ndarray] = {}
        known: dict[str, dict[str | None, int]] = {}
        for row, record in enumerate(facts):
            for field, value in record.items():
                if field not in known:
                    known[field], self.codes[field] = {None: 0}, np.zeros(len(facts), dtype="int64")
                self.codes[field][row] = known[field].setdefault(value, len(known[field]))
        self.values = {field: list(codes) for field, codes in known.items()}

    def ask(self, field: str, check: Callable[[str | None, str | None], bool], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """``check`` of the values of a field in each pair of rows."""
        values = self.values.get(field, [None])
        codes = self.codes.get(field, np.zeros(len(self.given), dtype="int64"))
        pairs, at = np.unique(codes[i] * len(values) + codes[j], return_inverse=True)
        return np.array([bool(check(values[p // len(values)], values[p % len(values)])) for p in pairs.tolist()], dtype=bool)[at]

    def holds(self, check: Check, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if hasattr(check, "parts"):
            return np.any([self.holds(part, i, j) for part in check.parts], axis=0)
        return self.ask(check.field, lambda a, b: check({check.field: a}, {check.field: b}), i, j)

    def same_events(self, category: str, i: np.ndarray, j: np.ndarray, share: float = 0.6, least: float = 0.75) -> np.ndarray:
        """``same_event`` of each pair of rows of one category."""
        open_ = np.nonzero(self.given[i] & self.given[j])[0]
        checks = RULES.get(category.lower())
        if checks:
            for check in checks:
                if len(open_):
                    open_ = open_[self.holds(check, i[open_], j[open_])]
        elif len(open_):
            a, b = i[open_], j[open_]
            both, hits = np.zeros(len(open_), dtype="int64"), np.zeros(len(open_), dtype="int64")
            for field in self.values:
                told = np.nonzero(self.ask(field, lambda x, y: x and y, a, b))[0]
                both[told] += 1
                if len(told):
                    hits[told] += self.ask(field, lambda x, y: _plain(x) == _plain(y) or above(_plain(x), _plain(y), least), a[told], b[told])
            open_ = open_[(both > 0) & (hits / np.maximum(both, 1) >= share)]
        out = np.zeros(len(i), dtype=bool)
        out[open_] = True
        return out


#: Pairs that are decided at a time.
AT_ONCE = 500_000
DAY = 86_400_000_000


def near_pairs(cell: np.ndarray, timeless: np.ndarray, own: np.ndarray, pos: np.ndarray, ts: np.ndarray, dated: np.ndarray, days: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell, the smaller position first, that are at most ``days`` apart or lack a date.

    Own rows meet each other and the guests of their cell. Where own rows are ``timeless`` (they lack a date), they are guests of
    their cell as well, so only guests are met, and each pair of two rows without date once.
    """
    order = np.lexsort((~own, cell))  # own rows first, so that no two guests meet
    ends = np.searchsorted(cell[order], cell[order], side="right")
    active, k = np.nonzero(own[order])[0], 0
    while True:
        k += 1
        active = active[active + k < ends[active]]
        if not len(active):
            return
        a, b = order[active], order[active + k]
        gap = np.abs(np.where(pos[a] < pos[b], ts[a] - ts[b], ts[b] - ts[a]) // DAY)
        ok = np.where(timeless[a], ~own[b] & (dated[b] | (pos[a] < pos[b])), gap <= days)
        a, b = a[ok], b[ok]
        turned = pos[a] > pos[b]
        yield np.where(turned, b, a), np.where(turned, a, b)


def pairs_of_cells(part: dict[str, pa.Array], days: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each pair of the same event in a number of whole cells (columns as in ``event_matches``)."""
    own = part["own"].to_numpy(zero_copy_only=False)
    pos, ts, dated = part["pos"].to_numpy(), part["ts"].fill_null(0).to_numpy(), part["ts"].is_valid().to_numpy(zero_copy_only=False)
    timeless = part["block"].is_null().to_numpy(zero_copy_only=False)
    kinds = part["category"].dictionary_encode()
    names, kind = kinds.dictionary.to_pylist(), kinds.indices.to_numpy()
    keys = [part["tag"].dictionary_encode().indices.to_numpy(), kind, timeless, part["block"].fill_null(0).to_numpy(), part["bucket"].to_numpy()]
    _, cell = np.unique(np.stack([k.astype("int64") for k in keys]), axis=1, return_inverse=True)
    cell = cell.reshape(-1)
    met = (np.bincount(cell, own)[cell] > 0) & (np.bincount(cell)[cell] > 1)
    used = np.nonzero(met)[0]
    records = Records([dict(f or ()) for f in part["facts"].take(pa.array(used, pa.int64())).to_pylist()])

    def decided(near: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i, j = map(np.concatenate, zip(*near))
        for at, name_ in enumerate(names):
            own_kind = np.nonzero(kind[used[i]] == at)[0]
            if len(own_kind):
                hit = own_kind[records.same_events(name_, i[own_kind], j[own_kind])]
                yield used[i[hit]], used[j[hit]]

    near, waiting = [], 0
    for i, j in near_pairs(*(x[used] for x in (cell, timeless, own, pos, ts, dated)), days):
        near.append((i, j))
        waiting += len(i)
        if waiting >= AT_ONCE:
            yield from decided(near)
            near, waiting = [], 0
    if near:
        yield from decided(near)


def may_match(category: Column, f: Column, g: Column) -> Column:
    """False only for pairs that some check of their category surely refuses; decided inside the JVM."""
    refused = F.lit(False)
    for kind, checks in RULES.items():
        for need, field in (c.needs for c in checks if hasattr(c, "needs")):
            a, b = f[field], g[field]
            both = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
            if need == "given":
                bad = ~both
            elif need == "value":
                x, y = a.try_cast("double"), b.try_cast("double")
                bad = both & (x > 0) & (y > 0) & (F.greatest(x, y) < 1e300) & (F.abs(x - y) > 0.1000001 * F.greatest(x, y))
            else:
                bad = both & (F.lower(strip(a)) != F.lower(strip(b))) & F.concat(a, b).rlike(r"^[\x00-\x7f]*$")
            refused = refused | ((F.lower(category) == kind) & F.coalesce(bad, F.lit(False)))
    return ~F.coalesce(refused, F.lit(False))


def match_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs (``pos_i``, ``pos_j``, ``category``, ``facts_i``, ``facts_j`` as maps and other columns) of the same event, without the maps."""
    kept = [c for c in pairs.columns if c not in ("facts_i", "facts_j")]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("facts_i").to_pylist(), batch.column("facts_j").to_pylist(), batch.column("category").to_pylist())
            hit = pa.array([same_event(dict(f or ()), dict(g or ()), c) for f, g, c in rows], pa.bool_())
            yield batch.select(kept).filter(hit)

    able = pairs.filter(may_match(F.col("category"), F.col("facts_i"), F.col("facts_j")))
    return able.mapInArrow(decide, pairs.select(*kept).schema)
