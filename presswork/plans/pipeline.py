"""The whole way from queued items to stored articles, one materialised table per step."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.text import coerce_number, first_given, html_to_text, json_object_text, parse_score, real_tags
from presswork.operators.dedup import event_dedup, title_dedup
from presswork.operators.dictionary import alias_table, collect_bounded, keyword_dict, keyword_table, tag_contained, with_names_and_tiers
from presswork.operators.ordering import with_position
from presswork.operators.rank import RULES, best_known, points_of, sum_of
from presswork.plans.services import Model, OfflineModel, call
from presswork.session import cut
from presswork.sources.feeds import collected, fetch_pages, first_per_link
from presswork.sources.sinks import Counts, drain, insert_ignore, stored_columns

#: Least score of an item that is analysed and stored.
RELEVANT = 70
#: Characters of a page that are read, shown to a model and stored.
PAGE, SHOWN, STORED = 3000, 2000, 500
REQUIRED = ("competitor_tagging", "sbu_tagging", "category_tag", "summary", "contract_value_inr_crore", "geography")


@dataclass
class Steps:
    """Tables after each step, for reports and tests. The text of the pages is in ``stored`` only."""

    scored: DataFrame
    analysed: DataFrame
    after_titles: DataFrame
    stored: DataFrame


def analysed_fields(reply):
    """Fields of an analysis reply; an unreadable one, or one that lacks a key, gives an error record."""
    return fields_of(json_object_text(reply))


def fields_of(text: Column) -> Column:
    """As ``analysed_fields``, for the object in a reply."""
    parsed = F.from_json(text, ", ".join(f"{k} string" for k in REQUIRED))
    ok = F.coalesce(F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), F.json_object_keys(text))) == 0, F.lit(False))
    return F.when(ok, parsed).otherwise(
        F.struct(
            F.lit("-").alias("competitor_tagging"), F.lit("None").alias("sbu_tagging"), F.lit("error").alias("category_tag"),
            F.lit("Analysis failed").alias("summary"), F.lit(None).cast("string").alias("contract_value_inr_crore"), F.lit(None).cast("string").alias("geography"),
        )
    )


def paged(rows: DataFrame, fetch: Callable[[str], str]) -> DataFrame:
    """``rows`` with ``html``, the page behind each one's link; null where there is no link."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.join(fetch_pages(rows, fetch, partitions), "link", "left")


#: Columns of an analysed item.
ANALYSED = (
    "id", "news_title", "link", "source", "published_date", "relevance_score", "sbu_tagging", "category_tag", "summary", "geography",
    "contract_value_inr_crore", "competitor_tagging", "competitor_tier", "rank_score",
)


def analyse(queue: DataFrame, competitors: DataFrame, model: Model | None = None, fetch: Callable[[str], str] | None = None) -> DataFrame:
    """The items of the queue with ``relevance_score`` and, where it is high, the columns of the analysis; null elsewhere.

    One pass over the queue without a shuffle. With ``fetch`` the pages of the items to be analysed are fetched in
    between, and ``scraped_content`` says what is stored of them.
    """
    model = model or OfflineModel()
    replied = call(queue if fetch is None else queue.drop("content"), model.score, ["news_title", "competitor"])
    scored = replied.withColumn("relevance_score", parse_score(F.col("reply"))).drop("reply")
    high = F.col("relevance_score") >= RELEVANT
    if fetch is None:
        pages = scored.withColumnRenamed("content", "html")
    else:
        scored = cut(scored)
        pages = paged(scored.filter(high), fetch).unionByName(scored.filter(~high).withColumn("html", F.lit(None).cast("string")))
    texts = pages.withColumn("content", F.when(high, html_to_text(F.col("html"), PAGE))).drop("html")
    shown = texts.withColumn("shown", F.when(F.col("content") != "", F.substring("content", 1, SHOWN)).otherwise(F.col("news_title")))
    asked = call(shown.withColumn("high", high), model.analyse, ["news_title", "shown", "relevance_score"], only="high")
    given = [c for c in scored.columns if c != "content"]
    kept = [] if fetch is None else [F.substring("content", 1, STORED).alias("scraped_content")]
    read = asked.withColumn("json", json_object_text(F.col("reply"))).withColumn("f", F.when(high, fields_of(F.col("json")))).select(
        *given, *kept, F.when(high, first_given(F.col("f.competitor_tagging"), F.col("competitor"), F.lit("-"))).alias("_tags"),
        "f.sbu_tagging", "f.category_tag", "f.summary", "f.geography",
        coerce_number(F.col("f.contract_value_inr_crore")).alias("contract_value_inr_crore"),
    )
    tiers = {r["name"]: r["tier"] for r in collect_bounded(best_known(competitors)) if r["tier"] is not None}
    named = with_names_and_tiers(read, "_tags", alias_table(competitors), tiers, RULES.last_tier).drop("_tags")
    ranked = named.withColumn("rank_score", sum_of([*points_of(tier="competitor_tier").values()]))
    return ranked.withColumns({c: F.when(high, F.col(c)) for c in ("competitor_tagging", "competitor_tier", "rank_score")})


def run(
    spark: SparkSession, queue: DataFrame, competitors: DataFrame, model: Model | None = None, fetch: Callable[[str], str] | None = None
) -> Steps:
    """Score, analyse, rank and de-duplicate the queue (``raw_scraped_articles``). An empty queue gives empty tables.

    ``fetch`` gives the page behind a link; without it the queue's ``content`` is the page. Pages are read for the
    items that are analysed and again for those that are left after titles.
    """
    model = model or OfflineModel()
    done = cut(analyse(queue, competitors, model, fetch))
    high = done.filter(F.col("relevance_score") >= RELEVANT)
    analysed = high.select(*ANALYSED)
    # titles
    titles = analysed.select("id", "news_title", "published_date", F.col("competitor_tagging").alias("names"))
    dense = with_position(titles, F.desc_nulls_first("published_date"), F.asc("id"))
    left = cut(dense.select("id", "pos").join(title_dedup(dense), "pos", "left_semi"))
    after_titles = analysed.join(left, "id")
    # events
    if fetch is None:
        again = after_titles.join(queue.select("id", F.col("content").alias("html")), "id", "left").withColumn("content", html_to_text(F.col("html"), PAGE))
        again = again.withColumn("scraped_content", F.substring("content", 1, STORED))
    else:
        again = paged(high.select(*ANALYSED, "scraped_content").join(left, "id"), fetch).withColumn("content", html_to_text(F.col("html"), PAGE))
    again = again.withColumn("content", F.when(F.col("link").isNotNull(), F.col("content")).otherwise(F.col("scraped_content")))
    known = with_facts(again.drop("html"), model)
    final = known.join(event_dedup(known), "pos", "left_semi")
    return Steps(done.select(*[c for c in queue.columns if c != "content"], "relevance_score"), analysed, after_titles, stored_columns(final))


def with_facts(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """``rows`` with the ``facts``, ``tags`` and ``score`` that the comparison of events reads; ``content`` is the text of the page."""
    model = model or OfflineModel()
    replied = call(rows.withColumn("content", F.substring("content", 1, SHOWN)), model.facts, ["news_title", "content", "category_tag"])
    known = replied.withColumn("facts", F.from_json(json_object_text(F.col("reply")), "map<string,string>")).drop("reply", "content")
    return cut(known.withColumns({"tags": real_tags(F.col("competitor_tagging")), "score": F.col("rank_score")}))


QUEUED = ("id", "search_keyword", "news_title", "source", "link", "published_date", "sbu", "competitor", "content")


def relevant(entries: DataFrame, units: DataFrame, firms: DataFrame, ingested: Column) -> DataFrame:
    """The first entry of each link that names a competitor and a business unit, in the columns of the queue.

    ``units`` (``sbu``) and ``firms`` (``competitor``) are the dictionaries
    with ``keywords_raw``; entries without a date take the time ``ingested``.
    """
    items = collected(entries, ingested).withColumn("text", F.concat(F.coalesce("news_title", F.lit("")), F.lit(" "), F.coalesce("source", F.lit(""))))
    tagged = tag_contained(items, "text", keyword_dict(keyword_table(firms, "competitor"), tag="owner"), "competitor")
    tagged = tag_contained(tagged, "text", keyword_dict(keyword_table(units, "sbu")), "sbu").filter("competitor <> '' and sbu <> ''")
    chosen = with_position(first_per_link(tagged, "feed_ord", "entry_ord"), F.asc("feed_ord"), F.asc("entry_ord"), name="id")
    return chosen.withColumn("content", F.lit(None).cast("string")).select(*QUEUED)


@dataclass(frozen=True)
class Report:
    """What a whole run did."""

    failed_feeds: int
    queued: Counts
    stored: Counts


def cycle(
    spark: SparkSession, entries: DataFrame, units: DataFrame, firms: DataFrame, queue: str, stored: str, ingested: Column,
    model: Model | None = None, fetch: Callable[[str], str] | None = None,
) -> Report:
    """One whole run: collect ``entries`` into the table at ``queue``, process the queue, store at ``stored``, empty the queue.

    A failure of any step is raised and leaves the queue as it is, so nothing
    that was collected is lost; the next run processes it again. Rows that were
    stored before a failure are not stored twice, unless their key has a null.
    """
    entries = cut(entries)
    queued = insert_ignore(spark, relevant(entries, units, firms, ingested), queue, "id")
    waiting = spark.read.parquet(queue)
    done = insert_ignore(spark, run(spark, waiting, firms, model, fetch).stored, stored, "news_title")
    drain(spark, queue, waiting.schema)
    return Report(entries.filter(~F.col("success")).count(), queued, done)
