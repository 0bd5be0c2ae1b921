"""Pairs of titles that tell the same story, found in runs of successive positions by operations on whole arrays.

What a likeness can reach at most is bounded twice before it is computed: by
the characters that two titles share, and by the length of their longest
common subsequence, which no matching of blocks exceeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa

#: Kinds of characters: letters, digits, the space, and all others in a few kinds; sharing a kind counts as being equal.
KINDS = 48
#: Longer titles are not bounded by subsequences, and pairs bounded at a time.
LONGEST, AT_ONCE = 256, 16_384
#: From this length on the matcher leaves out frequent characters, so that even equal texts may differ.
FREQUENT_OUT = 200
DAY = 86_400_000_000

_KIND = np.array([37 + c % (KINDS - 37) for c in range(128)], dtype="uint8")
for _at, _character in enumerate("abcdefghijklmnopqrstuvwxyz0123456789 "):
    _KIND[ord(_character)] = _at


def character_kinds(titles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of kinds for each title, filled up with ``KINDS``, and the lengths."""
    lengths = np.array([len(t) for t in titles], dtype="int64")
    codes = np.frombuffer("".join(titles).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    flat = np.where(codes < 128, _KIND[np.minimum(codes, 127)], (37 + codes % (KINDS - 37)).astype("uint8"))
    kinds = np.full((len(titles), int(lengths.max(initial=0))), KINDS, dtype="uint8")
    kinds[np.arange(kinds.shape[1]) < lengths[:, None]] = flat
    return kinds, lengths


def shared_characters(kinds: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each distance 1, 2, ... how many characters each title shares at most with the one so far after it."""
    n = len(lengths)
    rows, _ = np.nonzero(kinds < KINDS)
    small = "uint16" if lengths.max(initial=0) < 30_000 else "int64"
    counts = np.ascontiguousarray(np.bincount(rows * KINDS + kinds[kinds < KINDS], minlength=n * KINDS).reshape(n, KINDS).T.astype(small))
    for k in range(1, n):
        yield k, np.minimum(counts[:, :-k], counts[:, k:]).sum(axis=0, dtype=small).astype("int64")


def common_at_most(kinds: np.ndarray, lengths: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of the kinds of each pair, by a bit for each character; for a title over ``LONGEST``
    the shorter length."""
    found = np.minimum(lengths[first], lengths[second])
    able = np.nonzero((lengths[first] <= LONGEST) & (lengths[second] <= LONGEST))[0]
    if not len(able):
        return found
    patterns, at = np.unique(first[able], return_inverse=True)
    words = max(1, -(-int(lengths[patterns].max()) // 64))
    masks = np.zeros((words, len(patterns), KINDS + 1), dtype="uint64")
    for p in range(int(lengths[patterns].max())):
        own = np.nonzero(lengths[patterns] > p)[0]
        masks[p >> 6, own, kinds[patterns[own], p]] |= np.uint64(1 << (p & 63))
    masks = masks.reshape(words, -1)
    order = np.argsort(lengths[second[able]], kind="stable")
    for start in range(0, len(order), AT_ONCE):
        some = order[start : start + AT_ONCE]
        texts = second[able[some]]
        steps = np.ascontiguousarray(kinds[texts, : int(lengths[texts].max())].T)
        base = at[some] * (KINDS + 1)
        unmatched = [np.full(len(some), ~np.uint64(0)) for _ in range(words)]
        for step in steps:
            where, carry = base + step, None
            for w in range(words):
                v, m = unmatched[w], masks[w].take(where)
                total = v + (v & m)
                over = total < v
                if carry is not None:
                    added = total + carry
                    over |= added < total
                    total = added
                carry = over.astype("uint64")
                unmatched[w] = total | (v & ~m)
        found[able[some]] = sum(np.bitwise_count(~v).astype("int64") for v in unmatched)
    return found


def more_alike(titles: list[str], first: np.ndarray, second: np.ndarray, ratio: float) -> np.ndarray:
    """Whether the likeness (``SequenceMatcher.ratio``) of each pair is more than ``ratio``."""
    matcher, last = SequenceMatcher(None), None
    out = np.zeros(len(first), dtype=bool)
    for at in np.argsort(second, kind="stable").tolist():
        a, b = titles[first[at]], titles[second[at]]
        if a == b and len(b) < FREQUENT_OUT:
            out[at] = ratio < 1
            continue
        if b != last:
            matcher.set_seq2(b)
            last = b
        matcher.set_seq1(a)
        out[at] = matcher.ratio() > ratio
    return out


def _lists(column: pa.Array) -> tuple[list[int], pa.Array]:
    """Where each list of a column begins and ends, and all values."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).tolist(), column.flatten()


def _similar(a: list[float], b: list[float], percent: float = 10.0) -> bool:
    return any(x > 0 and y > 0 and abs(x - y) / max(x, y) * 100 < percent for x in a for y in b)


def named_alike(run: dict[str, pa.Array], first: np.ndarray, second: np.ndarray, days: np.ndarray, percent: int = 60) -> np.ndarray:
    """Of pairs of equal names: similar numbers within 1 day, or ``percent`` of the smaller set of words within 2 days."""
    begins, words = _lists(run["words"])
    words = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).tolist()
    starts, numbers = _lists(run["numbers"])
    numbers = numbers.to_pylist()
    sets: dict[int, set[int]] = {}
    out = np.zeros(len(first), dtype=bool)
    for at, (i, j, apart) in enumerate(zip(first.tolist(), second.tolist(), days.tolist())):
        if apart <= 1 and _similar(numbers[starts[i] : starts[i + 1]], numbers[starts[j] : starts[j + 1]]):
            out[at] = True
            continue
        for row in (i, j):
            if row not in sets:
                sets[row] = set(words[begins[row] : begins[row + 1]])
        smaller = min(len(sets[i]), len(sets[j]))
        out[at] = smaller > 0 and len(sets[i] & sets[j]) * 100 >= smaller * percent
    return out


def pairs_of_run(run: dict[str, pa.Array], own: int, window: int, ratio: float | None, rules: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs whose first row is among the ``own`` first ones of a run (columns as in ``title_matches``, by position)."""
    pos = run["pos"].to_numpy()
    given = run["date"].is_valid().to_numpy(zero_copy_only=False)
    date = run["date"].fill_null(0).to_numpy()
    titles = run["title"].to_pylist()
    kinds, lengths = character_kinds(titles)
    names = run["names"].dictionary_encode()
    blank = np.array([n in ("", "-") for n in names.dictionary.to_pylist()], dtype=bool)
    names = names.indices.to_numpy()
    shared = shared_characters(kinds, lengths) if ratio is not None else ((k, None) for k in range(1, len(pos)))
    named, alike = [], []
    for k, most in shared:
        if k > window:
            break
        heads = slice(0, min(own, len(pos) - k))
        i = np.arange(heads.stop)
        j = i + k
        near = pos[j] - pos[i] <= window
        if not near.any():
            break
        dated = given[i] & given[j]
        days = np.where(dated, np.abs((date[i] - date[j]) // DAY), 0)
        if rules:
            hit = np.nonzero(near & dated & (days <= 2) & (names[i] == names[j]) & ~blank[names[i]])[0]
            named.append((hit, hit + k, days[hit]))
        if ratio is not None:
            whole = np.maximum(lengths[i] + lengths[j], 1)
            able = np.minimum(most[heads], np.minimum(lengths[i], lengths[j]))
            hit = np.nonzero(near & (days <= 3) & (2.0 * able / whole > ratio))[0]
            alike.append((hit, hit + k))
    found = [np.zeros((2, 0), dtype="int64")]
    if named:
        i, j, days = map(np.concatenate, zip(*named))
        kept = named_alike(run, i, j, days)
        found.append(np.stack([i[kept], j[kept]]))
    if alike:
        i, j = map(np.concatenate, zip(*alike))
        kept = 2.0 * common_at_most(kinds, lengths, i, j) / np.maximum(lengths[i] + lengths[j], 1) > ratio
        i, j = i[kept], j[kept]
        kept = more_alike(titles, i, j, ratio)
        found.append(np.stack([i[kept], j[kept]]))
    i, j = np.unique(np.concatenate(found, axis=1), axis=1)
    return pos[i], pos[j]
