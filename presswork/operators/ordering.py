"""Positions of rows in a total order, without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.session import cut


def with_position(df: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """``df`` with ``name``, the position (from 1) of each row in ``order``.

    The rows are sorted by range, numbered inside each partition, and moved up
    by the number of rows in the partitions before it. ``order`` must be total
    (end in a unique column) for the same result in each run.
    """
    ordered = cut(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    before, total = [], 0
    for row in sizes:  # one row for each partition
        before.append((row["_part"], total))
        total += row["n"]
    moved = df.sparkSession.createDataFrame(before or [(0, 0)], "_part bigint, _before bigint")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(moved), "_part")
        .withColumn(name, (F.col("_before") + inside + 1).cast("bigint"))
        .drop("_at", "_part", "_before")
    )
