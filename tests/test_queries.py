"""Every registered query on the smallest data against its SQL, where it has one."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from presswork.operators.pairs import tagged_pairs
from presswork.plans import catalog

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def db(tiny):
    import os

    con = duckdb.connect()
    for file in os.listdir(tiny):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{tiny}/{file}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value.isoformat() if hasattr(value, "isoformat") else float(value) if hasattr(value, "as_tuple") else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tiny, db, name):
    df = entry_module.queries()[name](spark, tiny)
    columns = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=repr)
    result = db.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted([tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()], key=repr)


def test_matches_have_the_group_rank_of_all_articles(spark, tmp_path):
    days = [datetime.datetime(2025, 1, 1, 9 - i) for i in range(4)]
    rows = [(i, d, "Acme wins order", "Acme", c, 0, "") for i, (d, c) in enumerate(zip(days, ("Legal", "Order Wins", "Order Wins", "Legal")), 1)]
    schema = "article_id bigint, published_date timestamp, news_title string, competitor_tagging string, category_tag string, rank_score int, scraped_content string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/processed_articles.parquet")
    queries = entry_module.queries()
    matches = {k: [tuple(r) for r in queries[f"fingerprint_match_{k}"](spark, str(tmp_path)).collect()] for k in ("order_wins", "other")}
    assert matches == {"order_wins": [(2, 3, 1)], "other": [(1, 4, 1)]}


def test_only_limits_pairs_not_groups(spark):
    rows = spark.createDataFrame([(1, "A", "Legal"), (2, "A", "Order Wins"), (3, "A", "Order Wins"), (4, "A", "Legal")], "pos bigint, tag string, cat string")
    dated = rows.withColumn("day", F.lit("2025-01-01").cast("timestamp"))
    pairs = tagged_pairs(dated, F.array("tag"), F.col("cat"), "pos", "day", only=F.col("category") == "order wins")
    assert [tuple(r) for r in pairs.collect()] == [(2, 3, 1)]


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_core_does_not_import_the_corpus_package():
    import pathlib

    root = pathlib.Path(catalog.__file__).resolve().parents[1]
    for source in root.rglob("*.py"):
        if "llm" not in source.relative_to(root).parts:
            assert "presswork.llm" not in source.read_text(), source
