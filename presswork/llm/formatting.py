"""Titles that differ only by formatting, collapsed to one record with its copies.

Byte-identical rows are collapsed first, with their counts. Only the distinct
titles are brought to a canonical text, and grouped again on the whole of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.operators.skew import HOT_ROWS, join_unique
from presswork.session import cut

#: Set off the segments of a title: a spaced dash, a bar, a colon that is not inside a number.
SEGMENT_BREAK = (
    r"(?U)(?<![^\s])[-‐-―−]+(?![^\s])"
    r"|[|¦｜]+"
    r"|(?<!\d)[:：]+|[:：]+(?!\d)"
)
#: Characters without width or ink, which can hide a spaced dash.
INVISIBLE = "[​⁠﻿­]"


def canonical_title(title: Column) -> Column:
    """The canonical text of a title.

    Lower case; segments in sorted order; inside a segment only letters, marks,
    digits, currency signs and decimal points between digits are kept. Null
    gives null; a title of white space only gives null; one of punctuation only
    gives the empty text.
    """
    text = F.regexp_replace(F.lower(title), INVISIBLE, "")
    segments = F.split(text, SEGMENT_BREAK)

    def content(segment: Column) -> Column:
        kept = F.regexp_replace(segment, r"(?<=\d)\.(?=\d)", "\u0001")
        return F.regexp_replace(kept, "[^\\p{L}\\p{M}\\p{N}\\p{Sc}\u0001]+", "")

    canonical = F.array_join(F.array_sort(F.filter(F.transform(segments, content), lambda s: s != "")), "\u001f")
    return F.when(F.regexp_replace(text, r"(?U)\s+", "") != "", canonical)


def title_groups(rows: DataFrame, by: str = "table_name", row_id: str = "row_id", title: str = "news_title") -> DataFrame:
    """One row per distinct raw title: ``by``, ``title``, ``canonical``, ``n`` (copies of the raw title),
    ``keep_id`` (smallest id of the canonical group) and ``n_group`` (all copies of the group).

    Null and blank titles are dropped. An empty table gives no rows.
    """
    distinct = cut(
        rows.select(by, row_id, title)
        .filter(F.col(title).isNotNull() & F.col(row_id).isNotNull())
        .groupBy(by, title)
        .agg(F.count("*").alias("n"), F.min(row_id).alias("first_id"))
        .withColumn("canonical", canonical_title(F.col(title)))
        .filter(F.col("canonical").isNotNull())
    )
    groups = distinct.groupBy(by, "canonical").agg(
        F.min("first_id").alias("keep_id"), F.sum("n").alias("n_group"), F.count("*").alias("n_titles")
    )
    return join_unique(distinct, groups, [by, "canonical"], "n_titles", F.col(title))


def formatting_copies(
    rows: DataFrame, by: str = "table_name", row_id: str = "row_id", title: str = "news_title", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``by``, ``keep_id``, ``copy_id``: one row for each member of a group other than the kept one.

    Ties have no effect, as ids are unique; a repeated row with the same id
    comes out once for each time it stands in the table, unless it is the kept
    one. Other columns of ``rows`` are ignored.
    """
    repeated = cut(title_groups(rows, by, row_id, title).filter(F.col("n_group") > 1).select(by, title, "n", "keep_id"))
    members = rows.select(by, row_id, title).filter(F.col(title).isNotNull())
    found = join_unique(members, repeated, [by, title], "n", F.col(row_id), hot_rows)
    return found.filter(F.col(row_id) != F.col("keep_id")).select(by, "keep_id", F.col(row_id).alias("copy_id"))


def formatting_clusters(rows: DataFrame, by: str = "table_name", row_id: str = "row_id", title: str = "news_title") -> DataFrame:
    """``by``, ``keep_id``, ``copies``, ``spellings``: one record per title with the number of its copies."""
    return (
        title_groups(rows, by, row_id, title)
        .groupBy(by, "keep_id")
        .agg(F.max("n_group").alias("copies"), F.count("*").alias("spellings"))
    )
