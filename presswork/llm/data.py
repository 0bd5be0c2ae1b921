"""The article tables in the common shape that the operators of this subpackage read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import table


def both_articles(spark: SparkSession, sf_dir: str, raw: str, processed: str, name: str) -> DataFrame:
    """``table_name``, ``row_id`` and ``name``: column ``raw`` of the queue and ``processed`` of the history."""
    queue = table(spark, sf_dir, "raw_scraped_articles", "id", raw)
    history = table(spark, sf_dir, "processed_articles", "article_id", processed)
    return queue.select(F.lit("raw_scraped_articles").alias("table_name"), F.col("id").alias("row_id"), F.col(raw).alias(name)).unionAll(
        history.select(F.lit("processed_articles").alias("table_name"), F.col("article_id").alias("row_id"), F.col(processed).alias(name))
    )
