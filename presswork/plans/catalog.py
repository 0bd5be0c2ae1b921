"""All core queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presswork.plans import dedup_queries, event_queries, packed_queries, tagging_queries, text_queries, unit_queries

MODULES = (tagging_queries, text_queries, dedup_queries, event_queries, packed_queries, unit_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """``name -> f(spark, sf_dir)`` of every module."""
    return {k: f for m in MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    """The SQL of the queries that SQL can express."""
    return {k: s for m in MODULES if hasattr(m, "oracle_sql") for k, s in m.oracle_sql().items()}
