"""Pairs of rows that are near in position, in time or by a shared tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How many positions after a row its window holds.
WINDOW = 99
DAY = 86_400_000_000


def days_apart(a: Column, b: Column) -> Column:
    """Whole days between two timestamps, ``a`` minus ``b`` floored, without sign; null if either is null."""
    return F.abs(F.floor((F.unix_micros(a) - F.unix_micros(b)) / DAY)).cast("bigint")


def window_pairs(rows: DataFrame, pos: str = "pos", window: int = WINDOW, columns: tuple[str, ...] = (), same: tuple[str, ...] = ()) -> DataFrame:
    """Each row with the ``window`` rows after it: ``pos_i``, ``pos_j`` and ``columns`` of both.

    Rows are blocked by ``pos div (window + 1)``: a pair lies in one block or
    in two neighbours, so this is an equi-join with a residual and its output
    grows in proportion to the rows. Positions must be dense. With ``same``
    only rows that are equal in these columns are paired.
    """
    block = F.floor((F.col(pos) - 1) / (window + 1))
    left = rows.select(block.alias("block"), *same, F.col(pos).alias("pos_i"), *[F.col(c).alias(f"{c}_i") for c in columns])
    right = rows.select(
        F.explode(F.array(block, block - 1)).alias("block"), *same, F.col(pos).alias("pos_j"), *[F.col(c).alias(f"{c}_j") for c in columns]
    )
    return left.join(right, ["block", *same]).filter((F.col("pos_j") > F.col("pos_i")) & (F.col("pos_j") <= F.col("pos_i") + window)).drop("block", *same)


def tagged_pairs(rows: DataFrame, tags: Column, category: Column, pos: str, date: str, days: int = 3, only: Column | None = None) -> DataFrame:
    """``pos_i``, ``pos_j``, ``group_rank`` of rows with a shared tag and category, at most ``days`` apart.

    ``group_rank`` is the smallest first position among the shared groups; a
    pair comes out once. Rows without tags share the group ``General``. Null
    dates pass. Days are blocked with the group, so that one large group is
    spread over its days; null dates meet all days of their group. ``only``
    (over the lower-cased ``category``) limits the pairs, not the groups: first
    positions are taken from all rows.
    """
    base = rows.select(
        F.col(pos).alias("pos"),
        F.unix_micros(F.col(date)).alias("ts"),
        F.lower(F.coalesce(category, F.lit(""))).alias("category"),
        F.explode(F.when(F.size(tags) > 0, F.array_distinct(tags)).otherwise(F.array(F.lit("General")))).alias("tag"),
    )
    first = base.groupBy("tag").agg(F.min("pos").alias("group_rank"))
    base = base if only is None else base.filter(only)
    width = DAY * (days + 1)
    dated = base.filter("ts is not null").withColumn("block", F.floor(F.col("ts") / width))
    undated = base.filter("ts is null")
    left = dated.select("tag", "category", "block", F.col("pos").alias("p"), F.col("ts").alias("t"))
    right = dated.select(
        "tag", "category", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"), F.col("pos").alias("q"), F.col("ts").alias("u")
    )
    # the row first in position is the later one in time; floored days as in days_apart
    gap = F.abs(F.floor((F.when(F.col("p") < F.col("q"), F.col("t") - F.col("u"))) / DAY))
    near = left.join(right, ["tag", "category", "block"]).filter((F.col("p") < F.col("q")) & (gap <= days)).select("tag", "p", "q")
    beside = undated.select("tag", "category", F.col("pos").alias("a")).join(base.select("tag", "category", F.col("pos").alias("b")), ["tag", "category"])
    open_ = beside.filter("a <> b").select("tag", F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"))
    return (
        near.unionAll(open_)
        .join(first, "tag")
        .groupBy(F.col("p").alias("pos_i"), F.col("q").alias("pos_j"))
        .agg(F.min("group_rank").alias("group_rank"))
    )
