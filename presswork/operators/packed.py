"""Several values packed in one field, split into one row per value with its position.

Segmentation is guided by a dictionary: a multi-pattern automaton finds known
whole values in the packed text, and dynamic programming picks the cover of
the text that keeps the most characters inside known or quoted values, so that
a delimiter inside a legitimate value does not split it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of a dictionary that are sent to every worker; a larger one is joined to the fields.
MAX_DICTIONARY = 200_000
#: What separates values. A slash does so only between spaces.
SEPARATORS = ",;|•、，；｜\t\r\n"
#: Opening quotes and what closes each.
QUOTES = {'"': '"', "“": "”", "„": "”", "«": "»"}
BRACKETS = {"[": "]", "{": "}", "(": ")"}

_SLASH = re.compile(r"(?<!\S)/(?!\S)")
#: The same as patterns of the engine, and what may stand around a piece.
_BREAK = r"[,;|•、，；｜\t\r\n]|(?<!\S)/(?!\S)"
_EDGE = r"(?U)^[\s\"“„«\[{(]+|[\s\"”»\]})]+$"
_FIRST = re.compile(r"[,;|•、，；｜\t\r\n\"“„«\[{(]|(?<!\S)/(?!\S)")


def fold(text: str) -> str:
    """Lower case, character by character, so that it does not depend on what stands beside a character."""
    return text.lower() if text.isascii() else "".join(map(str.lower, text))


def dictionary_automaton(values: tuple[str, ...]):
    """Automaton over the known values that hold a separator; the others need no protection."""
    automaton = ahocorasick.Automaton()
    for value in values:
        if any(c in value for c in SEPARATORS) or _SLASH.search(value):
            automaton.add_word(fold(value), len(fold(value)))
    automaton.make_automaton()
    return automaton


def _strip_brackets(text: str) -> str:
    """``text`` without brackets that enclose the whole of it."""
    inner = text.strip()
    close = BRACKETS.get(inner[:1])
    if close and inner.endswith(close) and len(inner) > 1:
        depth = 0
        for at, c in enumerate(inner):
            depth += (c == inner[0]) - (c == close)
            if depth == 0 and at < len(inner) - 1:
                return text
        return inner[1:-1]
    return text


def segment(text: str | None, automaton=None) -> list[str]:
    """The values packed in ``text``, in order; empty pieces are dropped.

    A separator between quotes belongs to the value, and so does one inside a
    known value that stands between two separators (or ends of the text).
    Outer spaces and enclosing quotes are no part of a value. Null gives none.
    """
    if not text or not text.strip():
        return []
    if not _FIRST.search(text):
        return [text.strip()]
    text = _strip_brackets(text)
    size = len(text)
    breaks = {at for at, c in enumerate(text) if c in SEPARATORS} | {m.start() for m in _SLASH.finditer(text)}

    def begins(at: int) -> bool:
        at -= 1
        while at >= 0 and text[at] == " ":
            at -= 1
        return at < 0 or at in breaks

    def ends(at: int) -> bool:
        while at < size and text[at] == " ":
            at += 1
        return at >= size or at in breaks

    #: Spans that one value may fill although separators lie inside: (end, gain) by start.
    spans: dict[int, list[tuple[int, int]]] = {}
    quote = re.compile(r'["“„«]')
    at = 0
    while m := quote.search(text, at):
        end = text.find(QUOTES[m[0]], m.end())
        while end >= 0 and not ends(end + 1):
            end = text.find(QUOTES[m[0]], end + 1)
        if end < 0 or not begins(m.start()):
            at = m.end()
            continue
        spans.setdefault(m.start(), []).append((end + 1, 2 * size))
        at = end + 1
    if automaton is not None and len(automaton):
        lowered = fold(text)
        # where each lower-case character comes from: some characters have two
        origin = range(size) if len(lowered) == size else [at for at, c in enumerate(text) for _ in c.lower()]
        for last, length in automaton.iter(lowered):
            start, end = origin[last + 1 - length], origin[last] + 1
            if begins(start) and ends(end):
                spans.setdefault(start, []).append((end, end - start))
    if not spans:
        cuts = breaks
    else:
        # best[i]: the most protected characters of a cover of text[i:]; step[i]: where the piece at i ends
        best = [0] * (size + 1)
        step = [0] * (size + 1)
        for at in range(size - 1, -1, -1):
            best[at], step[at] = best[at + 1], at + 1
            for end, gain in spans.get(at, ()):
                if gain + best[end] > best[at]:
                    best[at], step[at] = gain + best[end], end
        cuts, at = set(), 0
        while at < size:
            if step[at] == at + 1 and at in breaks:
                cuts.add(at)
            at = step[at]
    pieces, last = [], 0
    for at in [*sorted(cuts), size]:
        piece = text[last:at].strip()
        close = QUOTES.get(piece[:1])
        if close and len(piece) > 1 and piece.endswith(close):
            piece = piece[1:-1].strip()
        if piece:
            pieces.append(piece)
        last = at + 1
    return pieces


def separated(values: DataFrame) -> DataFrame:
    """``value``: the distinct values, without outer spaces, of a one-column frame that hold a separator; the others need no protection."""
    value = F.regexp_replace(F.col(values.columns[0]), r"(?U)^\s+|\s+$", "")
    return values.select(value.alias("value")).filter(F.col("value").rlike(_BREAK)).distinct()


def known_values(dictionary: DataFrame, most: int = MAX_DICTIONARY) -> tuple[str, ...] | DataFrame:
    """The known values that need protection: on the driver if there are at most ``most``, else as the frame ``value``."""
    values = separated(dictionary)
    found = values.limit(most + 1).collect()
    return tuple(sorted(r[0] for r in found)) if len(found) <= most else values


def with_candidates(fields: DataFrame, values: DataFrame) -> DataFrame:
    """``fields`` with ``candidates``: the values whose first piece is a piece of the field, found by an equi-join over distinct fields."""
    pieces = lambda c: F.filter(F.transform(F.split(F.lower(c), _BREAK), lambda p: F.regexp_replace(p, _EDGE, "")), lambda p: p != "")
    texts = fields.filter(F.col("packed").rlike(_BREAK)).select("packed").distinct()
    asked = texts.select("packed", F.explode(F.array_distinct(pieces(F.col("packed")))).alias("piece"))
    heads = values.select("value", F.get(pieces(F.col("value")), F.lit(0)).alias("piece"))
    found = asked.join(heads, "piece").filter(F.length("value") <= F.length("packed")).groupBy("packed").agg(F.collect_set("value").alias("candidates"))
    return fields.join(found, "packed", "left")


def split_packed(fields: DataFrame, known: tuple[str, ...] | DataFrame = (), least: int = 1) -> DataFrame:
    """``field_name``, ``row_id``, ``val_pos`` (from 1), ``item`` of ``fields`` (``field_name``, ``row_id``, ``packed``).

    Only fields that hold ``least`` values or more come out. Null and blank
    fields hold none. There is no shuffle: every row is split where it is read,
    unless ``known`` is a frame of values, which is joined to the fields.
    """
    large = isinstance(known, DataFrame)
    given = () if large else known

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = dictionary_automaton(given)
        memo: dict[str, list[str]] = {}
        for batch in batches:
            take, positions, items = [], [], []
            own = batch.column("candidates").to_pylist() if large else None
            for row, text in enumerate(batch.column("packed").to_pylist()):
                if not text:
                    continue
                values = memo.get(text)
                if values is None:
                    if len(memo) > 50_000:
                        memo.clear()
                    values = memo[text] = segment(text, dictionary_automaton(tuple(own[row] or ())) if large else automaton)
                if len(values) >= least:
                    take.extend([row] * len(values))
                    positions.extend(range(1, len(values) + 1))
                    items.extend(values)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("field_name").take(at), batch.column("row_id").take(at), pa.array(positions, pa.int32()), pa.array(items, pa.string())],
                names=["field_name", "row_id", "val_pos", "item"],
            )

    shaped = fields.select("field_name", F.col("row_id").cast("bigint").alias("row_id"), "packed").filter(F.col("packed").isNotNull())
    shaped = with_candidates(shaped, known) if large else shaped
    return shaped.mapInArrow(split, "field_name string, row_id bigint, val_pos int, item string")
