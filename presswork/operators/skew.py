"""Joins that keep hot keys from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with this many rows or more is salted.
HOT_ROWS = 100_000
#: Parts into which the rows of a hot key are split.
SALTS = 64


def join_unique(
    rows: DataFrame,
    mapping: DataFrame,
    keys: list[str],
    weight: str,
    spread: Column,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join of ``rows`` with ``mapping``, which has one row per key.

    ``weight`` is a column of ``mapping`` with the number of rows that the key
    has in ``rows``. Keys of ``hot_rows`` or more are split into ``salts``
    parts by ``spread`` (any expression over ``rows`` that varies within a
    key); the mapping row is repeated for each part. The set of hot keys that
    is broadcast holds 8 bytes a key and at most ``rows / hot_rows`` keys.

    Rows with a null key match nothing. ``weight`` is dropped.
    """
    digest = F.xxhash64(*keys)
    hot = mapping.filter(F.col(weight) >= hot_rows).select(digest.alias("_hot")).distinct()

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_digest", digest).join(F.broadcast(hot), F.col("_digest") == F.col("_hot"), "left")

    left = marked(rows).withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    )
    right = marked(mapping).withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(
                F.array(F.lit(0).cast("bigint"))
            )
        ),
    )
    return left.drop("_digest", "_hot").join(right.drop("_digest", "_hot", weight), [*keys, "_salt"]).drop("_salt")
