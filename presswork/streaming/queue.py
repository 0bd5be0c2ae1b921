"""The collection queue as a stream: an extension, the batch form stays the measure of results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from presswork.sources.sinks import insert_ignore

QUEUE_SCHEMA = (
    "id bigint, search_keyword string, news_title string, source string, link string, published_date timestamp, sbu string, competitor string, content string"
)


def queue_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Items as their files arrive in ``path``."""
    return spark.readStream.schema(QUEUE_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_links(items: DataFrame, ingested: Column, late: str = "3 days") -> DataFrame:
    """The first item of each link; the links seen are kept for ``late`` after their arrival. Items without a date take
    the time ``ingested``, which the caller states, so that a repeated run gives the same.

    The watermark is on the time of arrival, so no item is dropped for its date. A link that comes again later than
    ``late`` passes; ``insert_ignore`` settles it.
    """
    dated = items.withColumns({"published_date": F.coalesce("published_date", ingested), "_arrived": F.current_timestamp()})
    return dated.withWatermark("_arrived", late).dropDuplicatesWithinWatermark(["link"]).drop("_arrived")


def counts_by_day(items: DataFrame, late: str = "3 days") -> DataFrame:
    """Items and distinct-link estimate by keyword and day; a day is final once the watermark has passed it."""
    day = F.window("published_date", "1 day")
    return (
        items.withWatermark("published_date", late)
        .groupBy(day.alias("day"), "search_keyword")
        .agg(F.count("*").alias("items"), F.approx_count_distinct("link").alias("links"))
        .select(F.col("day.start").alias("day"), "search_keyword", "items", "links")
    )


def store_available(
    items: DataFrame, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None, order: str = "id"
) -> StreamingQuery:
    """Store what has arrived so far, without conflicting rows, and end. A batch that is repeated after a failure inserts nothing twice."""

    def store(batch: DataFrame, number: int) -> None:
        insert_ignore(batch.sparkSession, prepare(batch) if prepare else batch, target, order, number=number)

    return items.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
