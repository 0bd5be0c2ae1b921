"""Queries on fields that hold several values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.packed import known_values, split_packed
from presswork.session import table


def quoted_values(dictionary: DataFrame, column: str) -> DataFrame:
    """The values that stand between quotes in a dictionary column."""
    return dictionary.select(F.explode(F.regexp_extract_all(F.col(column), F.lit('["“]([^"”]+)["”]'), F.lit(1))).alias("value"))


def known(spark: SparkSession, sf_dir: str) -> tuple[str, ...] | DataFrame:
    """Known whole values of the dictionary tables: names, and keywords between quotes."""
    names = table(spark, sf_dir, "competitors", "competitor", "keywords_raw")
    units = table(spark, sf_dir, "sbu_keywords", "sbu", "keywords_raw")
    stated = names.select(F.col("competitor").alias("value")).unionAll(units.select("sbu"))
    return known_values(stated.unionAll(quoted_values(names, "keywords_raw")).unionAll(quoted_values(units, "keywords_raw")))


def packed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packed field of the tables as ``field_name``, ``row_id``, ``packed``."""
    parts = []
    for name, source, row_id, column in (
        ("competitor_tagging", "processed_articles", "article_id", "competitor_tagging"),
        ("sbu_tagging", "processed_articles", "article_id", "sbu_tagging"),
        ("raw_sbu", "raw_scraped_articles", "id", "sbu"),
        ("keywords_raw", "competitors", "competitor_id", "keywords_raw"),
    ):
        df = table(spark, sf_dir, source, row_id, column)
        parts.append(df.select(F.lit(name).alias("field_name"), F.col(row_id).cast("bigint").alias("row_id"), F.col(column).alias("packed")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each value of every field that holds two or more."""
    return split_packed(packed_fields(spark, sf_dir), known(spark, sf_dir), least=2)


def p7_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each value occurs in each packed field, single values included."""
    return split_packed(packed_fields(spark, sf_dir), known(spark, sf_dir)).groupBy("field_name", "item").agg(F.count("*").alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p7_found": p7_found, "p7_values": p7_values}
