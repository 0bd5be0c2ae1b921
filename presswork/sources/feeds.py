"""Feeds: their addresses, an offline reader, and what is collected from their entries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from presswork.functions.text import clean_title, font_source, quote_url

#: Address of a feed of search results (fixed value); the keyword and the span of days are filled in.
ADDRESS = "https://news.google.com/rss/search?q={q}+when:{days}d&hl=en-IN&gl=IN&ceid=IN:en"
#: Seconds that one feed may take.
TIMEOUT = 30.0
ENTRY_SCHEMA = "keyword string, feed_ord int, entry_ord int, success boolean, title string, link string, published timestamp, description string"


def feed_url(keyword: Column, days: int = 15) -> Column:
    """Address of the feed of a keyword over the last ``days``."""
    before, after = ADDRESS.replace("{days}", str(days)).split("{q}")
    return F.concat(F.lit(before), quote_url(keyword), F.lit(after))


def parse_feed(content: str) -> list[dict]:
    """Title, link, date and description of each item of a feed; a broken feed raises ``ParseError``."""
    from email.utils import parsedate_to_datetime

    out = []
    for item in ElementTree.fromstring(content).iter("item"):
        text = {tag: (item.findtext(tag) or None) for tag in ("title", "link", "pubDate", "description")}
        try:
            when = parsedate_to_datetime(text["pubDate"]) if text["pubDate"] else None
        except (TypeError, ValueError):
            when = None
        out.append({"title": text["title"] or "", "link": text["link"] or "", "published": when, "description": text["description"]})
    return out


class FeedPartition(InputPartition):
    def __init__(self, number: int, keyword: str):
        super().__init__(number)
        self.number, self.keyword = number, keyword


class FeedReader(DataSourceReader):
    """One partition for each keyword; a feed that can't be had or read gives one row that says so.

    ``where`` is a folder of saved feeds, or an address in which ``{q}`` stands
    for the quoted keyword; whatever an address answers is read, its status
    does not count.
    """

    def __init__(self, keywords: list[str], where: str, timeout: float = TIMEOUT):
        self.keywords, self.where, self.timeout = keywords, where, timeout

    def content(self, keyword: str) -> str:
        from urllib.error import HTTPError
        from urllib.parse import quote
        from urllib.request import urlopen

        if "{q}" not in self.where:
            with open(f"{self.where}/{keyword}.xml", encoding="utf-8") as file:
                return file.read()
        try:
            with urlopen(self.where.replace("{q}", quote(keyword)), timeout=self.timeout) as answer:
                return answer.read().decode("utf-8", "replace")
        except HTTPError as answer:
            return answer.read().decode("utf-8", "replace")

    def partitions(self):
        return [FeedPartition(i, k) for i, k in enumerate(self.keywords)]

    def read(self, partition):
        try:
            entries = parse_feed(self.content(partition.keyword))
        except Exception:  # noqa: BLE001 - any failure of one feed is that feed's alone
            yield (partition.keyword, partition.number, 0, False, None, None, None, None)
            return
        for at, e in enumerate(entries):
            when = e["published"]
            yield (partition.keyword, partition.number, at, True, e["title"], e["link"], when, e["description"])


class FeedSource(DataSource):
    """``spark.read.format("feeds")``: options ``keywords`` (one per line), ``where`` (a folder of saved feeds, or an address
    with ``{q}`` for the keyword) and ``timeout`` (seconds for one feed)."""

    @classmethod
    def name(cls):
        return "feeds"

    def schema(self):
        return ENTRY_SCHEMA

    def reader(self, schema):
        keywords = sorted({k for k in self.options["keywords"].split("\n") if k})
        return FeedReader(keywords, self.options["where"], float(self.options.get("timeout", TIMEOUT)))


def read_feeds(spark: SparkSession, keywords: list[str], where: str, timeout: float = TIMEOUT) -> DataFrame:
    """Entries of the feeds of all keywords, in alphabetical order of the keywords; ``where`` as in ``FeedReader``."""
    spark.dataSource.register(FeedSource)
    return spark.read.format("feeds").option("keywords", "\n".join(keywords)).option("where", where).option("timeout", str(timeout)).load()


def http_page(link: str, timeout: float = 10.0) -> str:
    """The page behind a link, for ``fetch_pages``."""
    from urllib.request import Request, urlopen

    with urlopen(Request(link, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as answer:
        return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")


def fetch_pages(links: DataFrame, fetch: Callable[[str], str], partitions: int) -> DataFrame:
    """``link``, ``html`` of distinct links by a pluggable ``fetch``; any failure gives the empty text."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = []
            for link in batch.column("link").to_pylist():
                try:
                    pages.append(fetch(link) or "")
                except Exception:  # noqa: BLE001 - one page must not end the batch
                    pages.append("")
            yield pa.RecordBatch.from_arrays([batch.column("link"), pa.array(pages, pa.string())], names=["link", "html"])

    return links.select("link").dropna().distinct().repartition(partitions).mapInArrow(run, "link string, html string")


def collected(entries: DataFrame, ingested: Column) -> DataFrame:
    """Entries of successful feeds with their outlet, cleaned title and date (``ingested`` where none is given)."""
    source = font_source(F.col("description"))
    return entries.filter(F.col("success") & F.col("title").isNotNull()).select(
        F.col("keyword").alias("search_keyword"),
        "feed_ord",
        "entry_ord",
        clean_title(F.col("title"), source).alias("news_title"),
        source.alias("source"),
        "link",
        F.coalesce("published", ingested).alias("published_date"),
    )


def first_per_link(rows: DataFrame, *order: str) -> DataFrame:
    """The first row (by ``order``) of each link; rows are reduced before they are shuffled. Null links count as one link."""
    return rows.groupBy("link").agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_row.*")
