"""Queries of the corpus operators, as ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.boilerplate import page_furniture, page_main_text
from presswork.llm.data import both_articles
from presswork.llm.formatting import formatting_clusters, formatting_copies
from presswork.llm.history import repeats_of_history
from presswork.llm.names import link_spellings, read_officials, spelled_names
from presswork.llm.near_duplicates import near_duplicate_pairs, near_duplicate_report
from presswork.llm.packing import fill_containers
from presswork.llm.reading import reading_levels
from presswork.llm.tokens import count_tokens, encode_texts, round_trips
from presswork.operators.packed import split_packed
from presswork.plans.packed_queries import known
from presswork.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of titles that differ by formatting only."""
    return formatting_copies(both_articles(spark, sf_dir, "news_title", "news_title", "news_title"))


def p1_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per title with its number of copies and of spellings."""
    return formatting_clusters(both_articles(spark, sf_dir, "news_title", "news_title", "news_title"))


def _typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every typed name of both tables: the values of the packed tags, and the queue's single name as a whole."""
    tags = table(spark, sf_dir, "processed_articles", "article_id", "competitor_tagging").select(
        F.lit("processed_articles").alias("field_name"), F.col("article_id").alias("row_id"), F.col("competitor_tagging").alias("packed")
    )
    queue = table(spark, sf_dir, "raw_scraped_articles", "id", "competitor")
    return (
        split_packed(tags, known(spark, sf_dir))
        .select(F.col("field_name").alias("table_name"), "row_id", F.col("item").alias("spelling"))
        .unionAll(queue.select(F.lit("raw_scraped_articles"), F.col("id").alias("row_id"), F.col("competitor").alias("spelling")))
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed competitors that an article names in another spelling than the official one."""
    officials = read_officials(table(spark, sf_dir, "competitors"))
    return spelled_names(spark, _typed_names(spark, sf_dir), officials)


def p2_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct spelling with its number of uses and the official names it means."""
    officials = read_officials(table(spark, sf_dir, "competitors"))
    used = _typed_names(spark, sf_dir).filter(F.trim("spelling") != "").groupBy("spelling").agg(F.count("*").alias("n"))
    return link_spellings(spark, used, officials).select("spelling", "n", F.array_join("competitors", " | ").alias("competitors"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that repeat one of an earlier batch, with the first that they repeat."""
    return repeats_of_history(table(spark, sf_dir, "processed_articles", "article_id", "batch_id", "link", "news_title", "published_date"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "processed_articles", "article_id", "news_title", "source", "scraped_content")
    queue = table(spark, sf_dir, "raw_scraped_articles", "id", "news_title", "source", "content")
    shaped = [
        df.select(F.lit(name).alias("table_name"), F.col(key).alias("row_id"), F.col(page).alias("page"), F.col("news_title").alias("title"), F.trim("source").alias("site"))
        for name, df, key, page in (("processed_articles", history, "article_id", "scraped_content"), ("raw_scraped_articles", queue, "id", "content"))
    ]
    return shaped[0].unionAll(shaped[1]).filter(F.length("page") > 0)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the pages that are not main content."""
    return page_furniture(_pages(spark, sf_dir))


def p4_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return page_main_text(_pages(spark, sf_dir))


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each processed article: its page (kind 0), or lacking it title and summary (kind 1)."""
    articles = table(spark, sf_dir, "processed_articles", "article_id", "news_title", "summary", "scraped_content")
    paged = F.length("scraped_content") > 0
    told = F.concat(F.coalesce("news_title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit("")))
    return articles.select(
        "article_id",
        F.when(paged, 0).otherwise(1).alias("kind"),
        F.when(paged, F.col("scraped_content")).otherwise(told).alias("text"),
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of articles that share 0.70 of their sequences of three words."""
    return near_duplicate_pairs(_stories(spark, sf_dir), least=0.7, words=3)


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each article with its class of equal texts and its links at five words and likeness 0.8."""
    return near_duplicate_report(_stories(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return encode_texts(table(spark, sf_dir, "documents", "doc_id", "text"))


def p8_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every text, and whether decoding gives the text again."""
    return round_trips(table(spark, sf_dir, "documents", "doc_id", "text"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which text, or piece of it, lies in which container of 2,048 tokens."""
    return fill_containers(count_tokens(table(spark, sf_dir, "documents", "doc_id", "text")))


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level of every text, with the measures behind it."""
    return reading_levels(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "reading_labels", "doc_id", "band"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English texts of at least 30 pieces between white space that read as band 4."""
    english = table(spark, sf_dir, "documents", "doc_id", "lang").filter(F.col("lang") == "en").select("doc_id")
    return p10_levels(spark, sf_dir).filter((F.col("band") == 4) & (F.col("n_pieces") >= 30)).join(english, "doc_id", "left_semi").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        (p1_found, p1_clusters, p2_found, p2_spellings, p3_found, p4_found, p4_main, p6_found, p6_classes)
        + (p8_ids, p8_round_trips, p9_containers, p10_found, p10_levels)
    )
    return {f.__name__: f for f in found}
