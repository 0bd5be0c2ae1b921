"""Queries on amounts in different units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.units import common_units, fit_units, read_rates, wrong_values
from presswork.session import table


def _common(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = table(spark, sf_dir, "processed_articles")
    return common_units(articles, fit_units(articles, read_rates(table(spark, sf_dir, "currency_rates"))))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose title states an amount that the value column lacks or contradicts."""
    return wrong_values(_common(spark, sf_dir))


def p5_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every amount in lakh of rupees, with the unit it was filled in and how it was decided."""
    return _common(spark, sf_dir).select("article_id", "filled_unit", F.round("confidence", 3).alias("confidence"), "value_inr_lakh", "route")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p5_found": p5_found, "p5_units": p5_units}
