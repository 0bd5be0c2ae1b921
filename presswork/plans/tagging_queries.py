"""Dictionaries, tagging, alias resolution, filters and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.text import real_tags, split_tags, strip
from presswork.operators.dictionary import alias_table, keyword_dict, keyword_table, normalize_tags, resolve_names, tag_contained
from presswork.operators.ordering import with_position
from presswork.plans.registry import Registry
from presswork.session import table
from presswork.sources.feeds import feed_url, first_per_link
from presswork.sources.sinks import DEFAULTS, STORED, insertable, stored_columns

registry = Registry()
queries, oracle_sql = registry.queries, registry.oracle_sql

KEYWORDS = """SELECT unnest(regexp_extract_all(keywords_raw, '"([^"]+)"', 1)) AS keyword, {owner} AS owner
  FROM {table} WHERE {owner} IS NOT NULL AND keywords_raw IS NOT NULL"""
UNIT_KEYWORDS = KEYWORDS.format(owner="sbu", table="sbu_keywords")
FIRM_KEYWORDS = KEYWORDS.format(owner="competitor", table="competitors")
LOAD = "SELECT *, row_number() OVER (ORDER BY published_date DESC NULLS FIRST, id) AS pos FROM raw_scraped_articles"


def unit_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_table(table(spark, sf_dir, "sbu_keywords"), "sbu")


def firm_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_table(table(spark, sf_dir, "competitors"), "competitor")


def loaded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The queue, newest first (rows without a date before all), with positions."""
    raw = table(spark, sf_dir, "raw_scraped_articles", "id", "published_date", *columns)
    return with_position(raw, F.desc_nulls_first("published_date"), F.asc("id"))


@registry.query("scan_dimension", "SELECT competitor_id, competitor, keywords_raw, tier FROM competitors")
def scan_dimension(spark, sf_dir):
    return table(spark, sf_dir, "competitors", "competitor_id", "competitor", "keywords_raw", "tier")


@registry.query("dim_notnull", "SELECT sbu, keywords_raw FROM sbu_keywords WHERE sbu IS NOT NULL AND keywords_raw IS NOT NULL")
def dim_notnull(spark, sf_dir):
    return table(spark, sf_dir, "sbu_keywords", "sbu", "keywords_raw").dropna()


@registry.query("dim_distinct", "SELECT category, min(ord) AS first_ord FROM categories WHERE category IS NOT NULL GROUP BY category")
def dim_distinct(spark, sf_dir):
    return table(spark, sf_dir, "categories").dropna(subset=["category"]).groupBy("category").agg(F.min("ord").alias("first_ord"))


@registry.query("keywords_explode", f"{UNIT_KEYWORDS} UNION ALL {FIRM_KEYWORDS}")
def keywords_explode(spark, sf_dir):
    return unit_keywords(spark, sf_dir).unionAll(firm_keywords(spark, sf_dir))


@registry.query("keywords_distinct", f"SELECT DISTINCT keyword FROM ({UNIT_KEYWORDS} UNION ALL {FIRM_KEYWORDS})")
def keywords_distinct(spark, sf_dir):
    return unit_keywords(spark, sf_dir).unionAll(firm_keywords(spark, sf_dir)).select("keyword").distinct()


@registry.query(
    "keyword_owners",
    f"SELECT keyword, string_agg(owner, '|' ORDER BY owner) AS owners, count(*) AS n FROM ({FIRM_KEYWORDS}) GROUP BY keyword",
)
def keyword_owners(spark, sf_dir):
    """All owners of each keyword, repeats kept."""
    grouped = firm_keywords(spark, sf_dir).groupBy("keyword").agg(F.sort_array(F.collect_list("owner")).alias("owners"), F.count("*").alias("n"))
    return grouped.select("keyword", F.array_join("owners", "|").alias("owners"), "n")


@registry.query(
    "feed_url",
    f"""SELECT keyword, 'https://news.google.com/rss/search?q=' || replace(url_encode(keyword), '%2F', '/')
 || '+when:15d&hl=en-IN&gl=IN&ceid=IN:en' AS url FROM (SELECT DISTINCT keyword FROM ({UNIT_KEYWORDS} UNION ALL {FIRM_KEYWORDS}))""",
)
def feed_urls(spark, sf_dir):
    return keywords_distinct(spark, sf_dir).select("keyword", feed_url(F.col("keyword")).alias("url"))


@registry.query(
    "load_raw_sorted",
    f"SELECT pos, id, search_keyword, news_title, source, link, published_date, sbu, competitor, content FROM ({LOAD})",
)
def load_raw_sorted(spark, sf_dir):
    columns = ("search_keyword", "news_title", "source", "link", "sbu", "competitor", "content")
    return loaded(spark, sf_dir, *columns).select("pos", "id", "search_keyword", "news_title", "source", "link", "published_date", "sbu", "competitor", "content")


@registry.query("batch_number", f"SELECT pos, id, (pos - 1) // 50 AS score_batch, (pos - 1) // 20 AS analysis_batch FROM ({LOAD})")
def batch_number(spark, sf_dir):
    step = lambda n: F.floor((F.col("pos") - 1) / n)
    return loaded(spark, sf_dir).select("pos", "id", step(50).alias("score_batch"), step(20).alias("analysis_batch"))


HEAD = "lower(coalesce(news_title, '') || ' ' || coalesce(source, ''))"
TAG = """SELECT a.id, coalesce((SELECT string_agg(tag, ', ' ORDER BY tag) FROM
  (SELECT DISTINCT {tag} AS tag FROM ({keywords}) k WHERE contains(a.t, lower(k.keyword)))), '') AS {out}
 FROM (SELECT id, """ + HEAD + """ AS t FROM raw_scraped_articles) a"""


def headed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Title and outlet of each queued row as one text."""
    raw = table(spark, sf_dir, "raw_scraped_articles", "id", "news_title", "source", *columns)
    text = F.concat(F.coalesce("news_title", F.lit("")), F.lit(" "), F.coalesce("source", F.lit("")))
    return raw.select("id", text.alias("text"), *columns)


@registry.query("tag_sbu", TAG.format(tag="keyword", keywords=UNIT_KEYWORDS, out="sbu_keywords"))
def tag_sbu(spark, sf_dir):
    """The unit keywords that title and outlet contain."""
    return tag_contained(headed(spark, sf_dir), "text", keyword_dict(unit_keywords(spark, sf_dir)), "sbu_keywords").drop("text")


@registry.query("tag_competitor", TAG.format(tag="owner", keywords=FIRM_KEYWORDS, out="competitors"))
def tag_competitor(spark, sf_dir):
    """The competitors one of whose keywords title and outlet contain."""
    return tag_contained(headed(spark, sf_dir), "text", keyword_dict(firm_keywords(spark, sf_dir), tag="owner"), "competitors").drop("text")


def _both_tags(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    text = headed(spark, sf_dir, *columns)
    firms = tag_contained(text, "text", keyword_dict(firm_keywords(spark, sf_dir), tag="owner"), "competitors")
    return tag_contained(firms, "text", keyword_dict(unit_keywords(spark, sf_dir)), "sbu_keywords").drop("text")


BOTH_TAGS = f"""SELECT x.id, x.competitors, y.sbu_keywords FROM ({TAG.format(tag="owner", keywords=FIRM_KEYWORDS, out="competitors")}) x
 JOIN ({TAG.format(tag="keyword", keywords=UNIT_KEYWORDS, out="sbu_keywords")}) y USING (id) WHERE x.competitors <> '' AND y.sbu_keywords <> ''"""


@registry.query("filter_dual_match", BOTH_TAGS)
def filter_dual_match(spark, sf_dir):
    """Rows with both kinds of tags."""
    return _both_tags(spark, sf_dir).filter("competitors <> '' and sbu_keywords <> ''")


@registry.query(
    "dedup_link_first",
    f"""SELECT link, min_by(id, id) AS id, count(*) AS copies FROM (SELECT r.link, r.id FROM raw_scraped_articles r
 JOIN ({BOTH_TAGS}) b ON r.id = b.id) GROUP BY link""",
)
def dedup_link_first(spark, sf_dir):
    """The first relevant row of each link: the filters go before the choice."""
    relevant = _both_tags(spark, sf_dir, "link").filter("competitors <> '' and sbu_keywords <> ''").select("link", "id")
    copies = relevant.groupBy(F.col("link").alias("_link")).agg(F.count("*").alias("copies"))
    chosen = first_per_link(relevant, "id")
    return chosen.join(copies, chosen["link"].eqNullSafe(copies["_link"])).select("link", "id", "copies")


@registry.query("filter_relevance", "SELECT article_id, relevance_score FROM processed_articles WHERE relevance_score >= 70")
def filter_relevance(spark, sf_dir):
    return table(spark, sf_dir, "processed_articles", "article_id", "relevance_score").filter("relevance_score >= 70")


ANALYSED = """SELECT r.id, coalesce(p.competitor_tagging, '-') AS competitor_tagging, coalesce(p.sbu_tagging, 'None') AS sbu_tagging,
 coalesce(p.category_tag, 'not_analyzed') AS category_tag, coalesce(p.summary, 'Not analyzed (low relevance)') AS summary
 FROM raw_scraped_articles r LEFT JOIN (SELECT link, min_by(competitor_tagging, article_id) FILTER (competitor_tagging IS NOT NULL) AS competitor_tagging,
  min_by(sbu_tagging, article_id) FILTER (sbu_tagging IS NOT NULL) AS sbu_tagging, min_by(category_tag, article_id) FILTER (category_tag IS NOT NULL) AS category_tag,
  min_by(summary, article_id) FILTER (summary IS NOT NULL) AS summary FROM processed_articles WHERE link IS NOT NULL GROUP BY link) p ON r.link = p.link"""


@registry.query("defaults_unanalyzed", ANALYSED)
def defaults_unanalyzed(spark, sf_dir):
    """Results of the analysis by link, and constants for rows that were not analysed."""
    names = {"competitor_tagging": "-", "sbu_tagging": "None", "category_tag": "not_analyzed", "summary": "Not analyzed (low relevance)"}
    done = table(spark, sf_dir, "processed_articles", "article_id", "link", *names).dropna(subset=["link"])
    first = done.groupBy("link").agg(*[F.min_by(n, F.when(F.col(n).isNotNull(), F.col("article_id"))).alias(n) for n in names])
    raw = table(spark, sf_dir, "raw_scraped_articles", "id", "link")
    return raw.join(first, "link", "left").select("id", *[F.coalesce(n, F.lit(d)).alias(n) for n, d in names.items()])


CONFLICT = """SELECT {columns} FROM raw_scraped_articles r WHERE link IS NULL OR published_date IS NULL OR (
 NOT EXISTS (SELECT 1 FROM processed_articles p WHERE p.link = r.link AND p.published_date = r.published_date)
 AND id = (SELECT min(id) FROM raw_scraped_articles q WHERE q.link = r.link AND q.published_date = r.published_date))"""


@registry.query("sink_insert_ignore", CONFLICT.format(columns="id, link, published_date, news_title"))
def sink_insert_ignore(spark, sf_dir):
    """Queued rows that conflict neither with the stored ones nor with each other."""
    batch = table(spark, sf_dir, "raw_scraped_articles", "id", "link", "published_date", "news_title")
    return insertable(batch, table(spark, sf_dir, "processed_articles", "link", "published_date"), "id")


@registry.query(
    "sink_processed_defaults",
    "SELECT "
    + ", ".join(
        f"r.{c}" if c in ("published_date", "news_title", "link", "source") else "CAST(" + (f"'{DEFAULTS[c]}'" if isinstance(DEFAULTS.get(c), str) else str(DEFAULTS.get(c, "NULL"))) + f" AS {'VARCHAR' if k == 'string' else k.upper()}) AS {c}"
        for c, k in STORED.items()
    )
    + f" FROM raw_scraped_articles r JOIN ({CONFLICT.format(columns='id')}) k USING (id)",
)
def sink_processed_defaults(spark, sf_dir):
    """The columns as they are stored, with defaults for those the batch lacks."""
    batch = table(spark, sf_dir, "raw_scraped_articles", "id", "link", "published_date", "news_title", "source")
    return stored_columns(insertable(batch, table(spark, sf_dir, "processed_articles", "link", "published_date"), "id"))


ALIASES = """SELECT alias, official, place.r AS first_row, place.k AS first_place FROM (SELECT lower(a) AS alias, arg_max(official, place) AS official, min(place) AS place FROM (
 SELECT official, unnest(list_concat([lower(official)], list_transform(coalesce(regexp_extract_all(keywords_raw, '"([^"]+)"', 1), []), lambda k: lower(trim(k))))) AS a,
  {'r': CAST(competitor_id AS BIGINT), 'k': CAST(unnest(range(0, 1 + len(coalesce(regexp_extract_all(keywords_raw, '"([^"]+)"', 1), [])))) AS INT)} AS place
 FROM (SELECT competitor_id, trim(competitor) AS official, keywords_raw FROM competitors WHERE competitor IS NOT NULL)) GROUP BY lower(a))"""


@registry.query("alias_map", ALIASES)
def alias_map(spark, sf_dir):
    """Aliases in order of their first appearance, each with the name that claimed it last."""
    return alias_table(table(spark, sf_dir, "competitors"))


NAMES = """SELECT DISTINCT name FROM (SELECT trim(unnest(string_split(competitor_tagging, ',')), ' \t\n\r') AS name FROM processed_articles
 WHERE trim(coalesce(competitor_tagging, ''), ' \t\n\r') NOT IN ('', '-', 'None'))"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = table(spark, sf_dir, "processed_articles", "competitor_tagging")
    given = tags.filter(~F.coalesce(strip(F.col("competitor_tagging")), F.lit("")).isin("", "-", "None"))
    return given.select(F.explode(split_tags(F.col("competitor_tagging"))).alias("name")).distinct()


@registry.query("normalize_exact", f"SELECT n.name, a.official AS resolved FROM ({NAMES}) n LEFT JOIN ({ALIASES}) a ON lower(n.name) = a.alias")
def normalize_exact(spark, sf_dir):
    return resolve_names(_names(spark, sf_dir), alias_table(table(spark, sf_dir, "competitors")), "exact")


PARTIAL = f"""SELECT n.name, arg_min(a.official, {{'r': a.first_row, 'k': a.first_place}}) AS resolved FROM ({NAMES}) n
 LEFT JOIN ({ALIASES}) a ON contains(lower(n.name), a.alias) OR contains(a.alias, lower(n.name)) GROUP BY n.name"""


@registry.query("normalize_partial", PARTIAL)
def normalize_partial(spark, sf_dir):
    return resolve_names(_names(spark, sf_dir), alias_table(table(spark, sf_dir, "competitors")), "partial")


@registry.query(
    "normalize_competitors",
    f"""WITH names AS ({NAMES}), aliases AS ({ALIASES}), part AS (SELECT n.name, arg_min(a.official, {{'r': a.first_row, 'k': a.first_place}}) AS resolved FROM names n
  LEFT JOIN aliases a ON contains(lower(n.name), a.alias) OR contains(a.alias, lower(n.name)) GROUP BY n.name),
 resolved AS (SELECT n.name, coalesce(a.official, p.resolved, n.name) AS official FROM names n LEFT JOIN aliases a ON lower(n.name) = a.alias JOIN part p ON p.name = n.name),
 rows AS (SELECT article_id, trim(unnest(string_split(competitor_tagging, ',')), ' \t\n\r') AS name FROM processed_articles
  WHERE trim(coalesce(competitor_tagging, ''), ' \t\n\r') NOT IN ('', '-', 'None'))
 SELECT p.article_id, coalesce(t.normalized, '-') AS normalized FROM processed_articles p LEFT JOIN
 (SELECT article_id, string_agg(DISTINCT official, ', ' ORDER BY official) AS normalized FROM rows JOIN resolved USING (name) GROUP BY article_id) t USING (article_id)""",
)
def normalize_competitors(spark, sf_dir):
    """Each name of the tag field replaced by the official one that it equals or partly matches, else kept."""
    aliases = alias_table(table(spark, sf_dir, "competitors"))
    tags = table(spark, sf_dir, "processed_articles", "article_id", "competitor_tagging")
    return normalize_tags(tags, "article_id", "competitor_tagging", lambda names: resolve_names(names, aliases))


@registry.query(
    "split_tags",
    """SELECT article_id, count(*) AS n, string_agg(t, '|' ORDER BY t) AS tags FROM (SELECT article_id, trim(unnest(string_split(competitor_tagging, ',')), ' \t\n\r') AS t
 FROM processed_articles) WHERE t NOT IN ('', '-') GROUP BY article_id""",
)
def split_tag_fields(spark, sf_dir):
    """Comma-separated tags without empty ones and dashes."""
    tags = table(spark, sf_dir, "processed_articles", "article_id", "competitor_tagging").withColumn("t", real_tags(F.col("competitor_tagging")))
    return tags.filter(F.size("t") > 0).select("article_id", F.size("t").cast("bigint").alias("n"), F.array_join(F.array_sort("t"), "|").alias("tags"))


@registry.query(
    "competitor_groups",
    f"""SELECT tag, min(pos) AS first_pos, count(*) AS n, sum(pos) AS pos_sum FROM (SELECT DISTINCT pos, unnest(CASE WHEN len(t) > 0 THEN t ELSE ['General'] END) AS tag
 FROM (SELECT pos, list_filter(list_transform(string_split(coalesce(competitor, ''), ','), lambda x: trim(x, ' \t\n\r')), lambda x: x NOT IN ('', '-')) AS t FROM ({LOAD}))) GROUP BY tag""",
)
def competitor_groups(spark, sf_dir):
    """Groups by tagged name in order of their first row; positions are summed up, not collected."""
    tags = real_tags(F.col("competitor"))
    rows = loaded(spark, sf_dir, "competitor").select("pos", F.explode(F.when(F.size(tags) > 0, F.array_distinct(tags)).otherwise(F.array(F.lit("General")))).alias("tag"))
    return rows.groupBy("tag").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n"), F.sum("pos").alias("pos_sum"))


@registry.query(
    "prompt_lists",
    """SELECT (SELECT string_agg('- ' || trim(competitor), chr(10) ORDER BY competitor_id) FROM competitors) AS competitor_list,
 (SELECT string_agg(ord || '. **' || category || '**', chr(10) ORDER BY ord) FROM categories) AS category_list""",
)
def prompt_lists(spark, sf_dir):
    """The bounded dictionaries as bullet and numbered lists."""
    from presswork.operators.dictionary import collect_bounded, numbered_list

    names = [r[0].strip() for r in collect_bounded(table(spark, sf_dir, "competitors", "competitor", "competitor_id").orderBy("competitor_id")) if r[0]]
    categories = [r[0] for r in collect_bounded(table(spark, sf_dir, "categories", "category", "ord").orderBy("ord"))]
    return spark.createDataFrame([(numbered_list(spark, names, False), numbered_list(spark, categories, True))], "competitor_list string, category_list string")
