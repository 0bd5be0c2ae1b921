"""The queue as a stream gives what the batch form gives."""

import datetime

from pyspark.sql import functions as F

from presswork.sources import sinks
from presswork.streaming import queue

DAY = datetime.datetime(2025, 1, 1)


def write(spark, path, rows):
    spark.createDataFrame([(i, "k", t, "s", link, d, None, None, None) for i, t, link, d in rows], queue.QUEUE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_store_available_ignores_conflicts_between_batches(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))
    write(spark, source, [(1, "a", "x", DAY), (2, "b", "x", DAY), (3, "c", None, DAY)])
    queue.store_available(queue.queue_stream(spark, source), target, state).awaitTermination()
    write(spark, source, [(4, "d", "x", DAY), (5, "e", "y", DAY), (6, "f", None, DAY)])
    queue.store_available(queue.queue_stream(spark, source), target, state).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 3, 5, 6]


def test_a_repeated_batch_inserts_nothing_twice(spark, tmp_path):
    target = str(tmp_path / "target")
    rows = spark.createDataFrame([(1, "x", DAY), (2, "y", None), (3, None, DAY)], "id bigint, link string, published_date timestamp")
    assert sinks.insert_ignore(spark, rows, target, "id", number=0) == sinks.Counts(3, 0)
    sinks.insert_ignore(spark, rows, target, "id", number=0)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    assert sinks.insert_ignore(spark, rows, target, "id", number=1) == sinks.Counts(2, 1)


def test_first_links_and_counts(spark, tmp_path):
    source = str(tmp_path / "source")
    write(spark, source, [(1, "a", "x", DAY), (2, "b", "x", DAY + datetime.timedelta(hours=2)), (3, "c", "y", DAY + datetime.timedelta(days=1))])
    for name, stream in (("links", queue.first_links(queue.queue_stream(spark, source), F.lit("2025-06-01 00:00:00").cast("timestamp"))), ("days", queue.counts_by_day(queue.queue_stream(spark, source)))):
        mode = "append" if name == "links" else "complete"
        query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r["link"] for r in spark.table("links").collect()) == ["x", "y"]
    assert {r["day"]: r["items"] for r in spark.table("days").collect()} == {DAY: 2, DAY + datetime.timedelta(days=1): 1}


def test_first_links_keep_late_items_after_an_undated_one(spark, tmp_path):
    source = str(tmp_path / "source")
    files = ([(1, "a", "x", None), (2, "b", "y", DAY)], [(3, "c", "z", DAY)], [(4, "d", "w", DAY), (5, "e", "y", DAY)], [(6, "f", "v", DAY - datetime.timedelta(days=90))])
    for rows in files:
        write(spark, source, rows)
    links = queue.first_links(queue.queue_stream(spark, source, files_per_trigger=1), F.lit("2025-06-01 00:00:00").cast("timestamp"))
    links.writeStream.format("memory").queryName("late").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["id"] for r in spark.table("late").collect()) == [1, 2, 3, 4, 6]
    assert links.columns == queue.queue_stream(spark, source).columns
