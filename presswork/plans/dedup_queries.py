"""Pairs of rows and order-dependent de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.numbers import extract_numbers, similar_numbers
from presswork.functions.similarity import STOP_WORDS, core_match, title_words
from presswork.functions.text import real_tags
from presswork.operators.dedup import event_dedup, event_matches, first_titles, title_dedup, title_matches
from presswork.operators.ordering import with_position
from presswork.operators.pairs import days_apart, tagged_pairs, window_pairs
from presswork.plans import pipeline
from presswork.plans.registry import Registry
from presswork.plans.tagging_queries import LOAD, loaded
from presswork.plans.text_queries import NUMBERS
from presswork.session import table

registry = Registry()
queries, oracle_sql = registry.queries, registry.oracle_sql

PAIRS = f"""SELECT i.pos AS pos_i, j.pos AS pos_j, i.published_date AS date_i, j.published_date AS date_j, i.news_title AS title_i, j.news_title AS title_j,
 abs(CAST(floor((epoch_us(i.published_date) - epoch_us(j.published_date)) / 86400000000.0) AS BIGINT)) AS days, i.competitor AS competitor_i, j.competitor AS competitor_j
 FROM ({LOAD}) i JOIN ({LOAD}) j ON j.pos > i.pos AND j.pos <= i.pos + 99"""
DONE = "SELECT *, row_number() OVER (ORDER BY published_date DESC NULLS FIRST, article_id) AS pos FROM processed_articles"


def done(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The accepted articles, newest first, with positions."""
    rows = table(spark, sf_dir, "processed_articles", "article_id", "published_date", *columns)
    return with_position(rows, F.desc_nulls_first("published_date"), F.asc("article_id"))


@registry.query("pairs_positional_window", f"SELECT pos_i, pos_j FROM ({PAIRS})")
def pairs_positional_window(spark, sf_dir):
    """Each row with the 99 rows after it."""
    return window_pairs(loaded(spark, sf_dir)).select("pos_i", "pos_j")


@registry.query("pairs_within_days", f"SELECT pos_i, pos_j, days FROM ({PAIRS}) WHERE days IS NULL OR days <= 3")
def pairs_within_days(spark, sf_dir):
    """Rows of a window at most three days apart; a null date passes."""
    pairs = window_pairs(loaded(spark, sf_dir), columns=("published_date",))
    return pairs.select("pos_i", "pos_j", days_apart(F.col("published_date_i"), F.col("published_date_j")).alias("days")).filter("days is null or days <= 3")


@registry.query(
    "similar_numbers_pairs",
    f"""SELECT pos_i, pos_j FROM (SELECT pos_i, pos_j, {NUMBERS.format(t='lower(title_i)')} AS a, {NUMBERS.format(t='lower(title_j)')} AS b FROM ({PAIRS}) WHERE days <= 1)
 WHERE len(list_filter(a, lambda x: len(list_filter(b, lambda y: x > 0 AND y > 0 AND abs(x - y) / greatest(x, y) * 100 < 10)) > 0)) > 0""",
)
def similar_numbers_pairs(spark, sf_dir):
    """Rows of a window, at most one day apart, with similar contract values."""
    rows = loaded(spark, sf_dir, "news_title").select("pos", "published_date", extract_numbers(F.lower("news_title")).alias("n"))
    pairs = window_pairs(rows, columns=("published_date", "n")).filter(days_apart(F.col("published_date_i"), F.col("published_date_j")) <= 1)
    return pairs.filter(similar_numbers(F.col("n_i"), F.col("n_j"))).select("pos_i", "pos_j")


WORDS = "list_filter(list_distinct(regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}]+')), lambda w: w NOT IN (" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "))"


@registry.query(
    "core_match_pairs",
    f"""SELECT pos_i, pos_j FROM (SELECT p.pos_i, p.pos_j, a.w AS a, b.w AS b FROM ({PAIRS}) p JOIN (SELECT pos, {WORDS.format(t='news_title')} AS w FROM ({LOAD})) a ON a.pos = p.pos_i
 JOIN (SELECT pos, {WORDS.format(t='news_title')} AS w FROM ({LOAD})) b ON b.pos = p.pos_j WHERE p.days <= 2)
 WHERE len(a) > 0 AND len(b) > 0 AND len(list_intersect(a, b)) * 100 >= least(len(a), len(b)) * 60""",
)
def core_match_pairs(spark, sf_dir):
    """Rows of a window, at most two days apart, that share the core of their titles."""
    rows = loaded(spark, sf_dir, "news_title").select("pos", "published_date", title_words(F.col("news_title")).alias("w"))
    pairs = window_pairs(rows, columns=("published_date", "w")).filter(days_apart(F.col("published_date_i"), F.col("published_date_j")) <= 2)
    return pairs.filter(core_match(F.col("w_i"), F.col("w_j"))).select("pos_i", "pos_j")


TAGS = "list_distinct(list_filter(list_transform(string_split(coalesce(competitor_tagging, ''), ','), lambda x: trim(x, ' \t\n\r')), lambda x: x NOT IN ('', '-')))"
TAGGED = f"""WITH rows AS (SELECT pos, published_date, lower(coalesce(category_tag, '')) AS category, unnest(CASE WHEN len(t) > 0 THEN t ELSE ['General'] END) AS tag
  FROM (SELECT pos, published_date, category_tag, {TAGS} AS t FROM ({DONE}))), ranks AS (SELECT tag, min(pos) AS group_rank FROM rows GROUP BY tag)
 SELECT i.pos AS pos_i, j.pos AS pos_j, min(group_rank) AS group_rank FROM rows i JOIN rows j ON i.tag = j.tag AND i.category = j.category AND i.pos < j.pos
 AND (i.published_date IS NULL OR j.published_date IS NULL OR abs(CAST(floor((epoch_us(i.published_date) - epoch_us(j.published_date)) / 86400000000.0) AS BIGINT)) <= 3)
 JOIN ranks ON ranks.tag = i.tag GROUP BY i.pos, j.pos"""


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = done(spark, sf_dir, "competitor_tagging", "category_tag")
    return tagged_pairs(rows, real_tags(F.col("competitor_tagging")), F.col("category_tag"), "pos", "published_date")


@registry.query("pairs_by_group", TAGGED)
def pairs_by_group(spark, sf_dir):
    """Pairs of one tag and category at most three days apart, each once, with its first group."""
    return _tagged(spark, sf_dir)


@registry.query("pairs_distinct", f"SELECT count(*) AS pairs, count(DISTINCT group_rank) AS first_groups FROM ({TAGGED})")
def pairs_distinct(spark, sf_dir):
    return _tagged(spark, sf_dir).agg(F.count("*").alias("pairs"), F.count_distinct("group_rank").alias("first_groups"))


@registry.query(
    "pairs_same_category",
    f"""SELECT i.pos AS pos_i, j.pos AS pos_j FROM ({DONE}) i JOIN ({DONE}) j ON j.pos > i.pos AND j.pos <= i.pos + 99
 AND lower(i.category_tag) = lower(j.category_tag)""",
)
def pairs_same_category(spark, sf_dir):
    """Rows of a window with the same category, case ignored."""
    rows = done(spark, sf_dir, "category_tag").withColumn("c", F.lower("category_tag"))
    return window_pairs(rows, columns=("c",)).filter("c_i = c_j").select("pos_i", "pos_j")


EXACT = f"""SELECT min(pos) AS pos FROM (SELECT pos, coalesce(lower(regexp_replace(regexp_replace(news_title, '^[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+', ''), '[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+$', '')), 'none') AS k
 FROM ({LOAD})) GROUP BY k"""


@registry.query("dedup_exact_title", EXACT)
def dedup_exact_title(spark, sf_dir):
    """The first row of each title."""
    return first_titles(loaded(spark, sf_dir, "news_title"))


RULED = f"""WITH RECURSIVE feats AS MATERIALIZED (SELECT pos, published_date, lower(coalesce(competitor, '')) AS names, {NUMBERS.format(t="lower(coalesce(news_title, 'none'))")} AS n,
  {WORDS.format(t="coalesce(news_title, 'none')")} AS w FROM ({LOAD})), firsts AS MATERIALIZED ({EXACT}),
 edges AS MATERIALIZED (SELECT j.pos AS pos_j, list(i.pos) AS smaller FROM feats i JOIN feats j ON j.pos > i.pos AND j.pos <= i.pos + 99 AND i.names = j.names AND i.names NOT IN ('', '-')
  AND abs(CAST(floor((epoch_us(i.published_date) - epoch_us(j.published_date)) / 86400000000.0) AS BIGINT)) <= 2
  WHERE i.pos IN (SELECT pos FROM firsts) AND j.pos IN (SELECT pos FROM firsts) AND (
   (len(i.w) > 0 AND len(j.w) > 0 AND len(list_intersect(i.w, j.w)) * 100 >= least(len(i.w), len(j.w)) * 60)
   OR (abs(CAST(floor((epoch_us(i.published_date) - epoch_us(j.published_date)) / 86400000000.0) AS BIGINT)) <= 1
    AND len(list_filter(i.n, lambda x: len(list_filter(j.n, lambda y: x > 0 AND y > 0 AND abs(x - y) / greatest(x, y) * 100 < 10)) > 0)) > 0)) GROUP BY j.pos),
 steps AS MATERIALIZED (SELECT f.pos, row_number() OVER (ORDER BY f.pos) AS step, coalesce(smaller, []) AS smaller FROM firsts f LEFT JOIN edges ON pos_j = f.pos),
 scan AS (SELECT CAST(0 AS BIGINT) AS step, CAST(NULL AS BIGINT) AS pos, false AS kept, CAST([] AS BIGINT[]) AS recent
  UNION ALL SELECT s.step, s.pos, len(list_intersect(s.smaller, c.recent)) = 0,
   CASE WHEN len(list_intersect(s.smaller, c.recent)) = 0 THEN list_append(list_filter(c.recent, lambda p: p > s.pos - 100), s.pos) ELSE c.recent END
  FROM scan c JOIN steps s ON s.step = c.step + 1)
 SELECT pos FROM scan WHERE kept"""


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(spark, sf_dir, "news_title", "competitor").withColumn("names", F.col("competitor"))


@registry.query("dedup_phase1_rules", RULED)
def dedup_phase1_rules(spark, sf_dir):
    """Survivors of the greedy scan with the rules on names, numbers and core words only."""
    return title_dedup(_named(spark, sf_dir), ratio=None)


@registry.query("dedup_phase1")
def dedup_phase1(spark, sf_dir):
    """Survivors of the greedy scan with all rules."""
    return title_dedup(_named(spark, sf_dir))


@registry.query("seq_ratio_pairs")
def seq_ratio_pairs(spark, sf_dir):
    """Pairs of a window, at most three days apart, whose titles are more than 0.85 alike."""
    return title_matches(_named(spark, sf_dir), rules=False)


@registry.query("title_pairs")
def title_pairs(spark, sf_dir):
    """Pairs of a window, at most three days apart, that match by any rule."""
    return title_matches(_named(spark, sf_dir))


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = done(spark, sf_dir, "news_title", "competitor_tagging", "category_tag", "rank_score", "scraped_content")
    return pipeline.with_facts(rows.withColumnRenamed("scraped_content", "content"))


@registry.query("event_pairs")
def event_pairs(spark, sf_dir):
    """Pairs of accepted articles that tell of the same event."""
    return event_matches(_known(spark, sf_dir)).select("pos_i", "pos_j", "group_rank")


@registry.query("event_survivors")
def event_survivors(spark, sf_dir):
    """Survivors of the comparison of events among all accepted articles."""
    return event_dedup(_known(spark, sf_dir))


@registry.query("dedup_phase2")
def dedup_phase2(spark, sf_dir):
    """Survivors of titles and events among all queued items, through the whole pipeline."""
    steps = pipeline.run(spark, table(spark, sf_dir, "raw_scraped_articles"), table(spark, sf_dir, "competitors"))
    return steps.stored


@registry.query("enrich_queue")
def enrich_queue(spark, sf_dir):
    """The queue scored, and what of it was analysed."""
    done_ = pipeline.analyse(table(spark, sf_dir, "raw_scraped_articles"), table(spark, sf_dir, "competitors"))
    return done_.select("id", "relevance_score", "category_tag", "competitor_tagging", "rank_score")
