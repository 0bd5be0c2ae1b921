"""Sinks that ignore conflicting rows, and the drain of the work queue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import cut

#: What a stored row gets for a column that the batch lacks altogether (fixed values).
DEFAULTS = {
    "source": "", "relevance_score": 0, "competitor_tagging": "-", "sbu_tagging": "", "category_tag": "", "summary": "",
    "scraped_content": "", "rank_score": 0,
}
STORED = {
    "published_date": "timestamp", "news_title": "string", "link": "string", "source": "string", "relevance_score": "int",
    "competitor_tagging": "string", "sbu_tagging": "string", "category_tag": "string", "summary": "string", "scraped_content": "string",
    "contract_value_inr_crore": "double", "geography": "string", "competitor_tier": "int", "rank_score": "int",
}
KEY = ("link", "published_date")


def insertable(batch: DataFrame, target: DataFrame, order: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """Rows of ``batch`` that conflict neither with ``target`` nor with an earlier row (by ``order``) of the batch.

    A row with a null in its key conflicts with nothing. Equal keys inside the
    batch are settled by partial aggregation, so a key that holds much of the
    batch is reduced before it is shuffled.
    """
    complete = F.lit(True)
    for column in key:
        complete = complete & F.col(column).isNotNull()
    whole = F.struct(*batch.columns)
    first = batch.filter(complete).groupBy(*key).agg(F.min_by(whole, order).alias("_row")).select("_row.*")
    fresh = first.join(target.select(*key).dropna().distinct(), list(key), "left_anti").select(*batch.columns)
    return fresh.unionAll(batch.filter(~complete))


def stored_columns(batch: DataFrame) -> DataFrame:
    """The columns of the stored table: those of the batch, a default where the column is absent; nulls stay as they are."""

    def column(name: str, kind: str) -> Column:
        given = F.col(name) if name in batch.columns else F.lit(DEFAULTS.get(name))
        return given.cast(kind).alias(name)

    return batch.select(*[column(n, k) for n, k in STORED.items()])


@dataclass(frozen=True)
class Counts:
    """What became of the rows of a batch."""

    saved: int
    skipped: int


def _finish(spark: SparkSession, path: str, number: int, fresh: Callable[[], DataFrame]) -> None:
    """Rows of batch ``number`` moved into the table once: they are staged whole in a hidden folder, and the moves of a
    staged batch can be repeated."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path
    staged = at(f"{path}/_batches/{number}")
    files = staged.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(at(staged, "_DONE")):
        return
    if not files.exists(at(staged, "_SUCCESS")):
        fresh().write.mode("overwrite").parquet(staged.toString())
    for found in files.listStatus(staged):
        name = found.getPath().getName()
        if name.startswith("part-"):
            files.rename(found.getPath(), at(path, f"batch-{number}-{name}"))
    files.create(at(staged, "_DONE")).close()


def insert_ignore(spark: SparkSession, batch: DataFrame, path: str, order: str, key: tuple[str, ...] = KEY, number: int | None = None) -> Counts:
    """Append what does not conflict to the table at ``path``; how many rows were really saved, and how many not.

    With a ``number`` the batch is stored once, however often it is repeated,
    rows with nulls in their key included.
    """
    try:
        target = spark.read.parquet(path)
    except Exception as error:  # noqa: BLE001 - an absent table is an empty one
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        target = batch.limit(0)
    # only stored rows of the batch's own dates can conflict
    if "published_date" in key and "published_date" in target.columns:
        span = batch.agg(F.min("published_date"), F.max("published_date")).first()
        target = target.filter(F.col("published_date").between(F.lit(span[0]), F.lit(span[1])))
    fresh = cut(insertable(batch, target, order, key))
    if number is None:
        fresh.write.mode("append").parquet(path)
    else:
        _finish(spark, path, number, lambda: fresh)
    saved = fresh.count()
    return Counts(saved, batch.count() - saved)


def drain(spark: SparkSession, path: str, schema) -> None:
    """Empty the queue at ``path``. Call it only after the batch has been stored."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
