"""Feeds as they are scanned, and the matching of names and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.similarity import sequence_ratio
from presswork.functions.text import real_tags, strip
from presswork.operators.events import RULES, match_pairs
from presswork.operators.pairs import tagged_pairs
from presswork.plans import pipeline
from presswork.plans.dedup_queries import done
from presswork.plans.registry import Registry
from presswork.plans.text_queries import sql_clean_title
from presswork.session import table
from presswork.sources.feeds import collected

registry = Registry()
queries, oracle_sql = registry.queries, registry.oracle_sql

#: Least likeness of names of which none is part of the other.
LIKE_NAMES = 0.8
ITEM = "title string, link string, pubDate string, description string"


def _escaped(column: str):
    text = F.regexp_replace(F.coalesce(column, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    for given, wanted in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(given), F.lit(wanted))
    return text


#: Titles and outlets as XML gives them: without outer white space, null titles as empty texts.
ITEMS = """(SELECT id, search_keyword, trim(coalesce(news_title, ''), ' \t\n\r') AS news_title, trim(coalesce(source, ''), ' \t\n\r') AS source,
 nullif(trim(link, ' \t\n\r'), '') AS link, published_date FROM raw_scraped_articles)"""
FEED_SCAN = f"""SELECT i.search_keyword, 0 AS feed_ord, i.id AS entry_ord, c.clean_title AS news_title, i.source, i.link,
 coalesce(date_trunc('second', i.published_date), TIMESTAMP '2025-12-31 00:00:00') AS published_date
 FROM {ITEMS} i JOIN ({sql_clean_title().replace("raw_scraped_articles", ITEMS)}) c USING (id)"""


@registry.query("feed_scan", FEED_SCAN)
def feed_scan(spark, sf_dir):
    """Every queued row as an item of a feed, read back from XML, its outlet found and its title cleaned."""
    raw = table(spark, sf_dir, "raw_scraped_articles", "id", "search_keyword", "news_title", "source", "link", "published_date")
    when = F.coalesce(F.date_format("published_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
    font = F.concat(F.lit("&lt;font&gt;"), _escaped("source"), F.lit("&lt;/font&gt;"))
    parts = [("title", _escaped("news_title")), ("link", _escaped("link")), ("pubDate", when), ("description", font)]
    item = F.concat(F.lit("<item>"), *[x for n, c in parts for x in (F.lit(f"<{n}>"), c, F.lit(f"</{n}>"))], F.lit("</item>"))
    read = raw.select("id", "search_keyword", F.from_xml(item, ITEM).alias("e"))
    entries = read.select(
        F.col("search_keyword").alias("keyword"), F.lit(0).alias("feed_ord"), F.col("id").alias("entry_ord"), F.lit(True).alias("success"),
        F.coalesce("e.title", F.lit("")).alias("title"), F.col("e.link").alias("link"),
        F.try_to_timestamp(F.col("e.pubDate"), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("published"), F.col("e.description").alias("description"),
    )
    return collected(entries, F.lit("2025-12-31 00:00:00").cast("timestamp"))


PLAIN = r"regexp_replace(regexp_replace(lower({0}), '^[\s\p{{Z}}\x0b\x1c-\x1f\x85]+', ''), '[\s\p{{Z}}\x0b\x1c-\x1f\x85]+$', '')"


@registry.query(
    "company_match_contained",
    f"""SELECT id, a <> '' AND b <> '' AND (contains(a, b) OR contains(b, a)) AS matched FROM (SELECT id, coalesce({PLAIN.format('competitor')}, '') AS a,
 coalesce({PLAIN.format('search_keyword')}, '') AS b FROM raw_scraped_articles)""",
)
def company_match_contained(spark, sf_dir):
    """Whether one of two names is part of the other."""
    raw = table(spark, sf_dir, "raw_scraped_articles", "id", "competitor", "search_keyword")
    plain = lambda c: F.coalesce(strip(F.lower(c)), F.lit(""))
    named = raw.select("id", plain("competitor").alias("a"), plain("search_keyword").alias("b"))
    return named.select("id", ((F.col("a") != "") & (F.col("b") != "") & (F.contains("a", "b") | F.contains("b", "a"))).alias("matched"))


@registry.query("company_match")
def company_match(spark, sf_dir):
    """Whether two names match: one part of the other, decided inside the JVM, or more than 0.8 alike, asked for the rest only."""
    raw = table(spark, sf_dir, "raw_scraped_articles", "id", "competitor", "search_keyword")
    plain = lambda c: F.coalesce(strip(F.lower(c)), F.lit(""))
    named = raw.select("id", plain("competitor").alias("a"), plain("search_keyword").alias("b")).withColumn(
        "part", (F.col("a") != "") & (F.col("b") != "") & (F.contains("a", "b") | F.contains("b", "a"))
    )
    able = (F.col("a") != "") & (F.col("b") != "") & (2 * F.least(F.length("a"), F.length("b")) > LIKE_NAMES * (F.length("a") + F.length("b")))
    asked = named.filter(~F.col("part") & able).select("id", (sequence_ratio(F.col("a"), F.col("b")) > LIKE_NAMES).alias("matched"))
    return named.filter(F.col("part") | ~able).select("id", F.col("part").alias("matched")).unionAll(asked)


def _matches(category: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = done(spark, sf_dir, "news_title", "competitor_tagging", "category_tag", "rank_score", "scraped_content")
        wanted = lambda c: c == category if category else ~c.isin(*RULES)
        own = rows.filter(wanted(F.lower(F.coalesce("category_tag", F.lit("")))))
        known = pipeline.with_facts(own.withColumnRenamed("scraped_content", "content"))
        tags = real_tags(F.col("competitor_tagging"))
        pairs = tagged_pairs(rows, tags, F.col("category_tag"), "pos", "published_date", only=wanted(F.col("category")))
        facts = known.select("pos", "facts", F.col("category_tag").alias("category"))
        left = facts.select(F.col("pos").alias("pos_i"), F.col("facts").alias("facts_i"), "category")
        right = facts.select(F.col("pos").alias("pos_j"), F.col("facts").alias("facts_j"))
        return match_pairs(pairs.join(left, "pos_i").join(right, "pos_j")).select("pos_i", "pos_j", "group_rank")

    run.__doc__ = f"Pairs of accepted articles that tell of the same event: {category or 'all other categories'}."
    return run


for _category in (*RULES, None):
    _key = (_category or "other").replace(" & ", "_").replace(" ", "_")
    registry.query(f"fingerprint_match_{_key}")(_matches(_category))
