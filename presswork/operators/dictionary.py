"""Keyword dictionaries, tagging by contained keywords, and resolution of aliases."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.text import quoted_keywords, split_tags, strip

#: A dictionary of more rows than this is refused: it is sent to every worker.
MAX_ENTRIES = 200_000
#: What ``strip`` takes away.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def collect_bounded(df: DataFrame, most: int = MAX_ENTRIES) -> list:
    """All rows of a dictionary, refused beyond ``most``."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a dictionary of more than {most} rows can't be sent to the workers")
    return rows


def keyword_table(dictionary: DataFrame, owner: str, cell: str = "keywords_raw") -> DataFrame:
    """``keyword``, ``owner``: one row per quoted keyword; rows without owner or cell have none."""
    return dictionary.filter(F.col(owner).isNotNull() & F.col(cell).isNotNull()).select(
        F.explode(quoted_keywords(F.col(cell))).alias("keyword"), F.col(owner).alias("owner")
    )


def tag_contained(texts: DataFrame, text: str, keywords: dict[str, list[str]], out: str) -> DataFrame:
    """``texts`` with ``out``: the sorted distinct tags, joined by a comma and a space, of all keywords that the text
    contains (case ignored). One pass per text by a multi-pattern automaton, whatever the number of keywords; no
    shuffle. No keyword and null text give the empty string."""
    lowered: dict[str, set[str]] = {}
    for keyword, tags in keywords.items():
        if keyword:
            lowered.setdefault(keyword.lower(), set()).update(tags)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for keyword, tags in lowered.items():
            automaton.add_word(keyword, tags)
        automaton.make_automaton()
        for batch in batches:
            found = []
            for value in batch.column(text).to_pylist():
                tags = set().union(*(t for _, t in automaton.iter(value.lower()))) if value and lowered else set()
                found.append(", ".join(sorted(tags)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, out])

    from pyspark.sql.types import StringType, StructType

    return texts.mapInArrow(tag, StructType([*texts.schema.fields]).add(out, StringType()))


def keyword_dict(keywords: DataFrame, key: str = "keyword", tag: str | None = None) -> dict[str, list[str]]:
    """A bounded dictionary frame as ``keyword -> tags``; without ``tag`` a keyword tags itself."""
    found: dict[str, list[str]] = {}
    for row in collect_bounded(keywords.select(key, *([tag] if tag else [])).distinct()):
        found.setdefault(row[key], []).append(row[tag] if tag else row[key])
    return found


def alias_table(competitors: DataFrame, order: str = "competitor_id") -> DataFrame:
    """``alias`` (lower case), ``official``, ``first_row``, ``first_place``: each official name and keyword; a later row
    takes over an alias but leaves it its first place (the row's ``order``, and 0 for the name or the number of the
    keyword). Rows without a name are left out."""
    named = competitors.filter(F.col("competitor").isNotNull()).select(
        F.col(order).cast("bigint").alias("at"), strip(F.col("competitor")).alias("official"), F.col("keywords_raw")
    )
    spelled = named.select(
        "official",
        F.posexplode(F.concat(F.array(F.lower("official")), F.transform(quoted_keywords(F.col("keywords_raw")), lambda k: F.lower(strip(k))))).alias("k", "alias"),
        "at",
    ).withColumn("place", F.struct(F.col("at").alias("first_row"), F.col("k").alias("first_place")))
    placed = spelled.groupBy("alias").agg(F.max_by("official", "place").alias("official"), F.min("place").alias("place"))
    return placed.select("alias", "official", "place.first_row", "place.first_place")


def resolve_names(names: DataFrame, aliases: DataFrame, how: str = "both") -> DataFrame:
    """``name``, ``resolved`` of the distinct ``name`` column: by equality (``exact``), by the first alias that contains
    the name or is contained in it (``partial``), or ``both``; null where nothing fits. The alias table is bounded and
    looked up in each worker: aliases inside a name by an automaton, the name inside aliases by one search in all of
    them run together in order."""
    known = alias_list(aliases)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = resolver(known, how)
        for batch in batches:
            out = [look_up(name) for name in batch.column("name").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(out, pa.string())], names=["name", "resolved"])

    return names.select("name").distinct().mapInArrow(resolve, "name string, resolved string")


def alias_list(aliases: DataFrame) -> list[tuple[str, str]]:
    """The bounded alias table as ``(alias, official)`` in order of first places."""
    rows = sorted((r["first_row"], r["first_place"], r["alias"], r["official"]) for r in collect_bounded(aliases))
    return [(alias, official) for _, _, alias, official in rows]


def resolver(known: list[tuple[str, str]], how: str = "both") -> Callable[[str | None], str | None]:
    """The official name that ``resolve_names`` gives a name, as a function."""
    exact = dict(known)
    automaton = ahocorasick.Automaton()
    for rank, (alias, _) in enumerate(known):
        if alias:
            automaton.add_word(alias, rank)
    automaton.make_automaton()
    whole = "\0".join(alias for alias, _ in known)
    starts = list(accumulate((len(alias) + 1 for alias, _ in known), initial=0))
    blank = next((rank for rank, (alias, _) in enumerate(known) if not alias), None)

    def first_fit(key: str) -> str | None:
        ranks = [rank for _, rank in automaton.iter(key)] if len(automaton) else []
        at = whole.find(key) if known and "\0" not in key else -1
        ranks += [bisect_right(starts, at) - 1] if at >= 0 else []
        ranks += [blank] if blank is not None else []
        return known[min(ranks)][1] if ranks else None

    def look_up(name: str | None) -> str | None:
        key = name.strip().lower() if name is not None else None
        found = exact.get(key) if how in ("exact", "both") and key is not None else None
        return first_fit(key) if found is None and how in ("partial", "both") and key is not None else found

    return look_up


def empty_tags(tags: Column) -> Column:
    """Whether a field holds no tag: null, blank, dash or ``None``."""
    return F.coalesce(strip(tags), F.lit("")).isin("", "-", "None")


def with_names_and_tiers(rows: DataFrame, column: str, aliases: DataFrame, tiers: dict[str, int], last_tier: int) -> DataFrame:
    """``rows`` with ``competitor_tagging`` as by ``normalize_tags`` and ``competitor_tier`` as by ``best_tier``, both made in the
    row's own place, without a shuffle; ``tiers`` by official name. Names are resolved once for each batch."""
    from pyspark.sql.types import LongType, StringType, StructType

    known = alias_list(aliases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = resolver(known)
        for batch in batches:
            resolved: dict[str, str] = {}
            tags, best = [], []
            for names in batch.column("_names").to_pylist():
                for name in names or ():
                    if name not in resolved:
                        found = look_up(name)
                        resolved[name] = name if found is None else found
                joined = ", ".join(sorted({resolved[name] for name in names})) if names else "-"
                parts = (part.strip(WHITE_SPACE) for part in joined.split(","))
                tags.append(joined)
                best.append(min((tiers[p] for p in parts if p != "-" and p in tiers), default=last_tier))
            kept = [c for c in batch.schema.names if c != "_names"]
            arrays = [*(batch.column(c) for c in kept), pa.array(tags, pa.string()), pa.array([min(last_tier, t) for t in best], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "competitor_tagging", "competitor_tier"])

    named = rows.withColumn("_names", F.when(~empty_tags(F.col(column)), F.array_distinct(split_tags(F.col(column)))))
    return named.mapInArrow(run, StructType([*rows.schema.fields]).add("competitor_tagging", StringType()).add("competitor_tier", LongType()))


def normalize_tags(tags: DataFrame, row_id: str, column: str, resolver) -> DataFrame:
    """``row_id``, ``normalized``: each tag of the field replaced by ``resolver(names)``'s name or kept, sorted and joined.

    Null, blank, dash and ``None`` give a dash. Distinct names are resolved
    once; their table is joined back by name.
    """
    exploded = tags.filter(~empty_tags(F.col(column))).select(row_id, F.explode(F.array_distinct(split_tags(F.col(column)))).alias("name"))
    resolved = resolver(exploded.select("name"))
    joined = (
        exploded.join(resolved, "name", "left")
        .groupBy(row_id)
        .agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("resolved", "name"))), ", ").alias("normalized"))
    )
    return tags.select(row_id).join(joined, row_id, "left").select(row_id, F.coalesce("normalized", F.lit("-")).alias("normalized"))


def numbered_list(spark: SparkSession, items: list[str], bold: bool) -> str:
    """A list for a prompt: bullets, or numbers with bold names."""
    return "\n".join(f"{i}. **{item}**" if bold else f"- {item}" for i, item in enumerate(items, 1))
