"""Text cleaning, reply parsing, numbers, ranking and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.numbers import extract_numbers, values_similar
from presswork.functions.pages import with_visible_text
from presswork.functions.text import clean_title, coerce_number, font_source, html_to_text, json_object_text, parse_score, strip
from presswork.operators.events import FACTS, OTHER_FACTS
from presswork.operators.rank import RULES, best_tier, category_points, place_points, rank_score, value_points
from presswork.plans.registry import Registry
from presswork.session import table

registry = Registry()
queries, oracle_sql = registry.queries, registry.oracle_sql

WS = "' \t\n\r'"


def raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "raw_scraped_articles", "id", *columns)


def processed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "processed_articles", "article_id", *columns)


STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\p{{Z}}\x1c-\x1f\x85]+', ''), '[\s\p{{Z}}\x1c-\x1f\x85]+$', '')"


def sql_clean_title() -> str:
    ends = "".join(
        f"WHEN coalesce(source, '') <> '' AND ends_with(t, '{s}' || source) THEN {STRIP.format(f'left(t, length(t) - length(source) - {len(s)})')} "
        for s in (" - ", " | ", " – ", "- ", "| ")
    )
    cut = "t"
    for s in (" - ", " [|] ", " – "):
        cut = f"regexp_replace({cut}, '(?s)^(.*){s}.*$', '\\1')"
    return (
        f"SELECT id, CASE WHEN c = t THEN {STRIP.format(cut)} ELSE c END AS clean_title FROM "
        f"(SELECT id, t, CASE {ends} ELSE t END AS c FROM (SELECT id, news_title AS t, source FROM raw_scraped_articles))"
    )


@registry.query("clean_title", sql_clean_title())
def clean_titles(spark, sf_dir):
    return raw(spark, sf_dir, "news_title", "source").select("id", clean_title(F.col("news_title"), F.col("source")).alias("clean_title"))


ENTRY = """'<a href="' || coalesce(link, '') || '">' || coalesce(news_title, '') || '</a>&nbsp;<font color="#6f6f6f"> ' || coalesce(source, '') || ' </font>'"""


@registry.query("font_source", f"SELECT id, trim(regexp_replace(regexp_extract({ENTRY}, '(?is)<font\\b[^>]*>(.*?)</font>', 1), '(?s)<[^>]*>', '', 'g')) AS source FROM raw_scraped_articles")
def font_sources(spark, sf_dir):
    """The outlet named in the HTML of a feed entry."""
    html = F.expr(ENTRY)
    return raw(spark, sf_dir, "link", "news_title", "source").select("id", font_source(html).alias("source"))


PAGE = """'<html><head><title>' || coalesce(news_title, '') || '</title><style>p {0}</style></head><body><header>Top</header><nav>Home > News</nav><!-- start --><p>'
 || replace(coalesce(content, ''), chr(10), '</p><p>') || '</p><aside>More &amp; more</aside><script>x = 1 < 2;</script><footer>End</footer></body></html>'"""
PAGE_SQL = PAGE.replace("{0}", "{}")


def _sql_html_to_text() -> str:
    text = PAGE_SQL
    for element in ("script", "style", "nav", "footer", "aside", "header", "iframe"):
        text = f"regexp_replace({text}, '(?is)<{element}\\b[^>]*>.*?</{element}\\s*>', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for reference, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{reference}', '{character}')"
    return f"regexp_replace({text}, '[\\s\\p{{Z}}\\x0b\\x1c-\\x1f\\x85]+', ' ', 'g')"


@registry.query("html_to_text", f"SELECT id, left(trim({_sql_html_to_text()}), 3000) AS text FROM raw_scraped_articles")
def html_texts(spark, sf_dir):
    """Visible text of whole pages, of which the stored part is cut at 3,000 characters as specified."""
    html = F.expr(PAGE_SQL.replace("chr(10)", "char(10)"))
    return raw(spark, sf_dir, "news_title", "content").select("id", html_to_text(html, 3000).alias("text"))


@registry.query("html_to_text_dom", f"SELECT id, left(trim({_sql_html_to_text()}), 3000) AS text FROM raw_scraped_articles")
def html_texts_by_tree(spark, sf_dir):
    """The same by the element tree, for pages that patterns can't follow."""
    pages = raw(spark, sf_dir, "news_title", "content").select("id", F.expr(PAGE_SQL.replace("chr(10)", "char(10)")).alias("html"))
    return with_visible_text(pages, "html", "text", 3000).drop("html")


@registry.query("truncate_content", "SELECT article_id, left(scraped_content, 500) AS stored, left(scraped_content, 2000) AS shown FROM processed_articles")
def truncate_content(spark, sf_dir):
    """The stored and the shown part of a page's text, at their specified lengths."""
    return processed(spark, sf_dir, "scraped_content").select(
        "article_id", F.substring("scraped_content", 1, 500).alias("stored"), F.substring("scraped_content", 1, 2000).alias("shown")
    )


REPLY = """CASE article_id % 7 WHEN 0 THEN 'Score: ' || relevance_score || '/100' WHEN 1 THEN CAST(relevance_score AS {s}) WHEN 2 THEN '-5' WHEN 3 THEN '85.7 of 100'
 WHEN 4 THEN 'none' WHEN 5 THEN 'about 150' ELSE NULL END"""


@registry.query(
    "parse_score",
    f"SELECT article_id, CAST(least(100, coalesce(try_cast(regexp_extract({REPLY.format(s='VARCHAR')}, '([0-9]+)', 1) AS INTEGER), 0)) AS INTEGER) AS score FROM processed_articles",
)
def parse_scores(spark, sf_dir):
    return processed(spark, sf_dir, "relevance_score").select("article_id", parse_score(F.expr(REPLY.format(s="STRING"))).alias("score"))


JSON = """CASE WHEN article_id % 5 = 0 THEN 'no object here' ELSE 'Here it is: ```json' || {nl} || '{{"category_tag": "' || coalesce(category_tag, '') || '", "summary": null'
 || CASE WHEN article_id % 3 = 0 THEN '' ELSE ', "geography": "' || coalesce(replace(geography, '"', ''), '') || '"' END
 || ', "contract_value_inr_crore": ' || CASE WHEN contract_value_inr_crore IS NULL THEN 'null' ELSE '"' || CAST(CAST(floor(contract_value_inr_crore) AS BIGINT) AS {s}) || '"' END || '}}' || {nl} || '```' END"""
SPARK_JSON, SQL_JSON = JSON.format(nl="char(10)", s="STRING"), JSON.format(nl="chr(10)", s="VARCHAR")
OBJECT = f"nullif(regexp_extract(regexp_replace({SQL_JSON}, '```(json)?', '', 'g'), '(?s)(\\{{.*\\}})', 1), '')"


@registry.query(
    "parse_json_reply",
    f"""SELECT article_id, json_extract_string(j, '$.category_tag') AS category_tag, json_extract_string(j, '$.geography') AS geography,
 try_cast(json_extract_string(j, '$.contract_value_inr_crore') AS DOUBLE) AS contract_value FROM (SELECT article_id, CAST({OBJECT} AS JSON) AS j FROM processed_articles)""",
)
def parse_json_reply(spark, sf_dir):
    """Fields of the object in a reply; all null where there is none."""
    replies = processed(spark, sf_dir, "category_tag", "geography", "contract_value_inr_crore").withColumn("reply", F.expr(SPARK_JSON))
    facts = F.from_json(json_object_text(F.col("reply")), "category_tag string, geography string, contract_value_inr_crore string")
    return replies.select("article_id", facts.alias("f")).select(
        "article_id", "f.category_tag", "f.geography", coerce_number(F.col("f.contract_value_inr_crore")).alias("contract_value")
    )


@registry.query(
    "json_required_fields",
    f"""SELECT article_id, CASE WHEN j IS NULL THEN 'error' WHEN list_has_all(json_keys(j), ['category_tag', 'summary', 'geography', 'contract_value_inr_crore']) THEN 'ok' ELSE 'error' END AS status
 FROM (SELECT article_id, CAST({OBJECT} AS JSON) AS j FROM processed_articles)""",
)
def json_required_fields(spark, sf_dir):
    """Whether a reply has all required keys; a key with a null value counts as there."""
    required = F.array(*[F.lit(k) for k in ("category_tag", "summary", "geography", "contract_value_inr_crore")])
    replies = processed(spark, sf_dir, "category_tag", "geography", "contract_value_inr_crore").withColumn("reply", F.expr(SPARK_JSON))
    keys = F.json_object_keys(json_object_text(F.col("reply")))
    return replies.select("article_id", F.when(F.size(F.array_except(required, keys)) == 0, "ok").otherwise("error").alias("status"))


NUMBER = """CASE article_id % 8 WHEN 0 THEN '1,200' WHEN 1 THEN '12d' WHEN 2 THEN '  7.5 ' WHEN 3 THEN '1e3' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'about 5'
 ELSE CAST(CAST(floor(contract_value_inr_crore) AS BIGINT) AS {s}) END"""


@registry.query(
    "coerce_value",
    f"""SELECT article_id, CASE WHEN regexp_full_match(trim(t), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(trim(t) AS DOUBLE) END AS number
 FROM (SELECT article_id, {NUMBER.format(s='VARCHAR')} AS t FROM processed_articles)""",
)
def coerce_values(spark, sf_dir):
    return processed(spark, sf_dir, "contract_value_inr_crore").select("article_id", coerce_number(F.expr(NUMBER.format(s="STRING"))).alias("number"))


NUMBERS = r"""list_filter(list_concat(
 list_transform(regexp_extract_all({t}, '(?i)(?:rs|₹|inr)\.?\s*([\d,]+)', 1), lambda m: round(CASE WHEN try_cast(replace(m, ',', '') AS DOUBLE) > 100000 THEN try_cast(replace(m, ',', '') AS DOUBLE) / 10000000 ELSE try_cast(replace(m, ',', '') AS DOUBLE) END, 2)),
 list_transform(regexp_extract_all({t}, '(?i)(?:rs|₹|inr)?\.?\s*(\d+(?:[,.]\d+)*)\s*(?:crore|cr)', 1), lambda m: round(try_cast(replace(m, ',', '') AS DOUBLE), 2)),
 list_transform(regexp_extract_all({t}, '(?i)(?:rs|₹|inr)?\.?\s*(\d+(?:[,.]\d+)*)\s*(?:lakh|lac)', 1), lambda m: round(try_cast(replace(m, ',', '') AS DOUBLE) * 0.01, 2)),
 list_transform(regexp_extract_all({t}, '(?i)(\d+(?:[,.]\d+)*)\s*(?:million|mn)', 1), lambda m: round(try_cast(replace(m, ',', '') AS DOUBLE) * 8.5, 2))), lambda n: n IS NOT NULL)"""


@registry.query(
    "extract_numbers",
    f"SELECT id, len(n) AS n_numbers, list_sum(n) AS total, n[1] AS first_number FROM (SELECT id, {NUMBERS.format(t='lower(news_title)')} AS n FROM raw_scraped_articles) WHERE len(n) > 0",
)
def extracted_numbers(spark, sf_dir):
    found = raw(spark, sf_dir, "news_title").select("id", extract_numbers(F.lower("news_title")).alias("n")).filter(F.size("n") > 0)
    total = F.aggregate("n", F.lit(0.0), lambda t, x: t + x)
    return found.select("id", F.size("n").cast("bigint").alias("n_numbers"), total.alias("total"), F.get("n", F.lit(0)).alias("first_number"))


@registry.query(
    "values_similar",
    """SELECT article_id, coalesce(CASE WHEN a = 0 AND b = 0 THEN true WHEN a = 0 OR b = 0 THEN false ELSE abs(a - b) / greatest(a, b) <= 0.1 END, false) AS alike
 FROM (SELECT article_id, contract_value_inr_crore AS a, CASE WHEN article_id % 4 = 0 THEN 0 ELSE round(contract_value_inr_crore * (0.85 + (article_id % 10) * 0.03), 1) END AS b FROM processed_articles)""",
)
def similar_values(spark, sf_dir):
    b = F.when(F.col("article_id") % 4 == 0, F.lit(0.0)).otherwise(F.round(F.col("contract_value_inr_crore") * (0.85 + (F.col("article_id") % 10) * 0.03), 1))
    return processed(spark, sf_dir, "contract_value_inr_crore").select("article_id", values_similar(F.col("contract_value_inr_crore"), b).alias("alike"))


@registry.query(
    "fingerprint_fields",
    "SELECT p.article_id, coalesce(f.fields, '" + ", ".join(OTHER_FACTS) + "') AS fields FROM processed_articles p LEFT JOIN (VALUES "
    + ", ".join(f"('{c}', '{', '.join(f)}')" for c, f in FACTS.items()) + ") f(category, fields) ON lower(p.category_tag) = f.category",
)
def fingerprint_fields(spark, sf_dir):
    """The facts to be extracted for the category of each article."""
    fields = F.create_map(*[F.lit(x) for c, f in FACTS.items() for x in (c, ", ".join(f))])
    return processed(spark, sf_dir, "category_tag").select(
        "article_id", F.coalesce(F.try_element_at(fields, F.coalesce(F.lower("category_tag"), F.lit(""))), F.lit(", ".join(OTHER_FACTS))).alias("fields")
    )


def _sql_category() -> str:
    return "CAST(CASE lower(category_tag) " + "".join(f"WHEN '{c}' THEN {w * RULES.category_factor} " for c, w in RULES.category_weight.items()) + "ELSE 0 END AS BIGINT)"


def _sql_place() -> str:
    out = "CASE "
    for units, steps in RULES.places:
        unit = " OR ".join(f"contains(lower(coalesce(sbu_tagging, '')), '{u}')" for u in units)
        inner = "".join(f"WHEN {' OR '.join(f'''contains(lower(coalesce(geography, '')), '{t}')''' for t in terms)} THEN {p * RULES.place_factor} " for terms, p in steps)
        out += f"WHEN {unit} THEN CASE {inner} ELSE 0 END "
    return f"CAST({out} ELSE 0 END AS BIGINT)"


def _sql_value() -> str:
    v = "contract_value_inr_crore"
    inner = "".join(
        f"WHEN '{c}' THEN CASE WHEN {v} >= {h} THEN 4 WHEN {v} >= {m} THEN 3 WHEN {v} >= {lo} THEN 2 ELSE 1 END " for c, (lo, m, h) in RULES.value_steps.items()
    )
    return f"CAST(CASE WHEN {v} IS NOT NULL AND NOT isnan({v}) AND {v} > 0 THEN CASE lower(category_tag) {inner} ELSE 0 END ELSE 0 END * {RULES.value_factor} AS BIGINT)"


TIER = f"""SELECT p.article_id, least(3, coalesce(t.tier, 3)) AS tier FROM processed_articles p LEFT JOIN (SELECT n.article_id, min(c.tier) AS tier FROM
 (SELECT article_id, trim(unnest(string_split(competitor_tagging, ',')), {WS}) AS name FROM processed_articles) n
 JOIN (SELECT trim(competitor) AS name, max(tier) AS tier FROM competitors WHERE competitor IS NOT NULL GROUP BY 1) c USING (name) WHERE name <> '-' GROUP BY n.article_id) t USING (article_id)"""


@registry.query("rank_category_points", f"SELECT article_id, {_sql_category()} AS category_points FROM processed_articles")
def rank_category(spark, sf_dir):
    return processed(spark, sf_dir, "category_tag").select("article_id", category_points(F.col("category_tag")).cast("bigint").alias("category_points"))


@registry.query("rank_geography_points", f"SELECT article_id, {_sql_place()} AS geography_points FROM processed_articles")
def rank_geography(spark, sf_dir):
    return processed(spark, sf_dir, "sbu_tagging", "geography").select("article_id", place_points(F.col("sbu_tagging"), F.col("geography")).cast("bigint").alias("geography_points"))


@registry.query("rank_value_points", f"SELECT article_id, {_sql_value()} AS value_points FROM processed_articles")
def rank_value(spark, sf_dir):
    return processed(spark, sf_dir, "category_tag", "contract_value_inr_crore").select(
        "article_id", value_points(F.col("category_tag"), F.col("contract_value_inr_crore")).cast("bigint").alias("value_points")
    )


@registry.query("best_tier", f"SELECT article_id, CAST(tier AS BIGINT) AS competitor_tier FROM ({TIER})")
def best_tiers(spark, sf_dir):
    tiers = best_tier(processed(spark, sf_dir, "competitor_tagging"), "article_id", "competitor_tagging", table(spark, sf_dir, "competitors", "competitor", "tier"))
    return tiers.select("article_id", F.col("competitor_tier").cast("bigint").alias("competitor_tier"))


@registry.query(
    "rank_score",
    f"""SELECT *, category_points + relevance_points + competitor_points + geography_points + value_points AS rank_score FROM (SELECT article_id, CAST(tier AS BIGINT) AS competitor_tier,
 {_sql_category()} AS category_points, CAST(coalesce(relevance_score, 70) AS BIGINT) AS relevance_points, CAST((4 - tier) * 10 AS BIGINT) AS competitor_points,
 {_sql_place()} AS geography_points, {_sql_value()} AS value_points FROM processed_articles JOIN ({TIER}) USING (article_id))""",
)
def rank_scores(spark, sf_dir):
    """The flagship: all factors and their sum."""
    columns = ("relevance_score", "category_tag", "competitor_tagging", "sbu_tagging", "geography", "contract_value_inr_crore")
    return rank_score(processed(spark, sf_dir, *columns), "article_id", table(spark, sf_dir, "competitors", "competitor", "tier"))


@registry.query(
    "report_counts",
    """SELECT count(*) AS total, count_if(relevance_score >= 70) AS high, CAST(count_if(relevance_score >= 70) AS DOUBLE) / count(*) * 100 AS high_percent,
 count_if(contract_value_inr_crore IS NOT NULL) AS valued FROM processed_articles""",
)
def report_counts(spark, sf_dir):
    high = F.count_if(F.col("relevance_score") >= 70)
    return processed(spark, sf_dir, "relevance_score", "contract_value_inr_crore").agg(
        F.count("*").alias("total"), high.alias("high"), F.try_divide(high * 100.0, F.count("*")).alias("high_percent"), F.count("contract_value_inr_crore").alias("valued")
    )


@registry.query("report_avg_relevance", "SELECT avg(relevance_score) AS avg_relevance FROM processed_articles WHERE relevance_score >= 70")
def report_avg_relevance(spark, sf_dir):
    return processed(spark, sf_dir, "relevance_score").filter("relevance_score >= 70").agg(F.avg("relevance_score").alias("avg_relevance"))


def _top(column: str, source: str) -> str:
    return f"SELECT {column}, count(*) AS n, min(article_id) AS first_id FROM {source} WHERE {column} IS NOT NULL AND relevance_score >= 70 GROUP BY {column} ORDER BY n DESC, first_id LIMIT 5"


def top_values(articles: DataFrame, column: str, most: int = 5) -> DataFrame:
    """The most frequent values, first seen first at equality; null is no value."""
    counted = articles.filter("relevance_score >= 70").dropna(subset=[column]).groupBy(column)
    return counted.agg(F.count("*").alias("n"), F.min("article_id").alias("first_id")).orderBy(F.desc("n"), "first_id").limit(most)


@registry.query("top_categories", _top("category_tag", "processed_articles"))
def top_categories(spark, sf_dir):
    return top_values(processed(spark, sf_dir, "category_tag", "relevance_score"), "category_tag")


@registry.query("top_sbus", _top("sbu_tagging", "processed_articles"))
def top_sbus(spark, sf_dir):
    return top_values(processed(spark, sf_dir, "sbu_tagging", "relevance_score"), "sbu_tagging")


@registry.query("top_competitors", f"SELECT * FROM ({_top('competitor_tagging', 'processed_articles')}) WHERE competitor_tagging <> '-'")
def top_competitors(spark, sf_dir):
    """The dash is dropped after the cut, so fewer than five may be left."""
    return top_values(processed(spark, sf_dir, "competitor_tagging", "relevance_score"), "competitor_tagging").filter("competitor_tagging <> '-'")


@registry.query(
    "cost_estimate",
    f"""SELECT *, score_calls * 200 + analysis_calls * 7500 + fact_calls * 500 AS tokens, (score_calls * 200 + analysis_calls * 7500 + fact_calls * 500) / 1000000.0 * 3.0 AS cost FROM
 (SELECT (SELECT count(*) FROM raw_scraped_articles) AS score_calls, count_if(relevance_score >= 70) AS analysis_calls, count(DISTINCT lower({STRIP.format("news_title")})) AS fact_calls FROM processed_articles)""",
)
def cost_estimate(spark, sf_dir):
    """Calls, tokens and cost of the model steps."""
    done = processed(spark, sf_dir, "relevance_score", "news_title").agg(
        F.count_if(F.col("relevance_score") >= 70).alias("analysis_calls"), F.count_distinct(F.lower(strip(F.col("news_title")))).alias("fact_calls")
    )
    calls = raw(spark, sf_dir).agg(F.count("*").alias("score_calls")).join(done)
    tokens = F.col("score_calls") * 200 + F.col("analysis_calls") * 7500 + F.col("fact_calls") * 500
    return calls.select("score_calls", "analysis_calls", "fact_calls", tokens.alias("tokens"), (tokens / 1e6 * 3.0).alias("cost"))
