"""Tables of a relational database as sources and sinks."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import cut
from presswork.sources.sinks import KEY, Counts, insertable


@dataclass(frozen=True)
class Database:
    """A connection; ``url`` defaults to ``$DATABASE_URL`` and must be known."""

    url: str = ""
    properties: dict = field(default_factory=dict)

    @property
    def address(self) -> str:
        url = self.url or os.environ.get("DATABASE_URL", "")
        if not url:
            raise ValueError("no database: give a url or set DATABASE_URL")
        return url if url.startswith("jdbc:") else f"jdbc:{url.replace('postgres://', 'postgresql://', 1)}"

    def read(self, spark: SparkSession, table: str, by: str | None = None, parts: int = 16) -> DataFrame:
        """A table, read by ranges of the number column ``by`` in ``parts`` tasks (in one, if none is given)."""
        if by is None:
            return spark.read.jdbc(self.address, table, properties=self.properties)
        quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.address).quoteIdentifier(by)
        span = spark.read.jdbc(self.address, f"(select min({quoted}) as lo, max({quoted}) as hi from {table}) span", properties=self.properties).first()
        if span[0] is None:
            return spark.read.jdbc(self.address, table, properties=self.properties)
        return spark.read.jdbc(self.address, table, by, int(span[0]), int(span[1]) + 1, parts, properties=self.properties)

    def append(self, rows: DataFrame, table: str) -> None:
        rows.write.jdbc(self.address, table, mode="append", properties=self.properties)

    def insert_ignore(self, batch: DataFrame, table: str, order: str, key: tuple[str, ...] = KEY) -> Counts:
        """Append what conflicts neither with stored rows nor inside the batch. Only keys of the batch's own span are read."""
        first = key[-1]
        span = batch.agg(F.min(first).alias("lo"), F.max(first).alias("hi")).first()
        target = self.read(batch.sparkSession, table).select(*key)
        if span["lo"] is not None:
            target = target.filter(F.col(first).between(F.lit(span["lo"]), F.lit(span["hi"])))
        fresh = cut(insertable(batch, target, order, key))
        self.append(fresh, table)
        saved = fresh.count()
        return Counts(saved, batch.count() - saved)

    def drain(self, spark: SparkSession, table: str) -> None:
        """Empty a table and keep its definition. Call it only after its rows have been stored elsewhere."""
        self.read(spark, table).limit(0).write.option("truncate", "true").jdbc(self.address, table, mode="overwrite", properties=self.properties)
