"""Texts put into containers of fixed capacity, whole unless longer than one.

Only the histogram of lengths is packed, on the driver (it has at most one
entry per unit of capacity): longest lengths first, each into patterns with
exactly the room, else into the pattern filled least (shortest pack first),
else into a new one. The patterns with their counts are then joined back to
the texts by the rank of a text among those of its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.session import cut

#: Capacity of a container, in tokens.
CAPACITY = 2048
#: About how many texts of one length are ranked in one task.
PART_ROWS = 100_000


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns ``(count, ((length, how many), ...))`` that hold every item of the histogram.

    Lengths are placed from the longest. ``open_`` keeps the patterns by the
    room they have left; a pattern of which only some packs get an item is
    split in two.
    """
    open_: dict[int, list[list]] = {}
    rooms: list[int] = []  # rooms in use, kept sorted

    def put(room: int, count: int, items: tuple) -> None:
        if room not in open_:
            open_[room] = []
            at = int(np.searchsorted(rooms, room))
            rooms.insert(at, room)
        open_[room].append([count, items])

    def take(room: int) -> list:
        found = open_[room].pop()
        if not open_[room]:
            del open_[room]
            rooms.remove(room)
        return found

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if length < 1 or length > capacity:
            raise ValueError(f"an item of length {length} has no place in a container of {capacity}")
        while left:
            room = length if length in open_ else rooms[-1] if rooms and rooms[-1] >= length else None
            if room is None:
                # as many packs as are needed if each takes what fits
                each = min(capacity // length, left)
                put(capacity - each * length, left // each, (length,) * each)
                left -= left // each * each
                continue
            count, items = take(room)
            each = min(room // length, max(1, left // count))
            packs = min(count, left // each)
            if packs < count:
                put(room, count - packs, items)
            put(room - each * length, packs, (*items, *(length,) * each))
            left -= packs * each
    return [(count, tuple(sorted(Counter(items).items(), reverse=True))) for room in sorted(open_) for count, items in open_[room]]


class Slots:
    """Where each rank of each length goes: runs of ranks with the first container and the items per container."""

    def __init__(self, patterns: list[tuple[int, tuple[tuple[int, int], ...]]]):
        placed: dict[int, list[tuple[int, int, int]]] = {}
        reached: Counter = Counter()
        offset: dict[tuple[int, int], int] = {}
        self.containers = 0
        for number, (count, items) in enumerate(patterns):
            begin = 0
            for length, many in items:
                placed.setdefault(length, []).append((reached[length], self.containers, many))
                offset[length, len(placed[length]) - 1] = begin
                reached[length] += count * many
                begin += length * many
            self.containers += count
        self.first = {n: np.array([p[0] for p in v], np.int64) for n, v in placed.items()}
        self.container = {n: np.array([p[1] for p in v], np.int64) for n, v in placed.items()}
        self.many = {n: np.array([p[2] for p in v], np.int64) for n, v in placed.items()}
        self.offset = {n: np.array([offset[n, i] for i in range(len(v))], np.int64) for n, v in placed.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Container and position in it of items with these ranks (from 0) among those of their length."""
        container, position = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            at = np.searchsorted(self.first[n], rank[own], "right") - 1
            within = rank[own] - self.first[n][at]
            container[own] = self.container[n][at] + within // self.many[n][at]
            position[own] = self.offset[n][at] + within % self.many[n][at] * n
        return container, position


def pieces_of(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece`` (from 0), ``start``, ``size``: a text longer than the capacity is cut into full pieces and a rest."""
    count = F.greatest(F.ceil(F.col("n_tokens") / capacity).cast("int"), F.lit(1))
    return (
        sized.filter(F.col("n_tokens").isNotNull())
        .select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
        .select(
            "doc_id",
            "piece",
            (F.col("piece").cast("bigint") * capacity).alias("start"),
            F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece").cast("bigint") * capacity).cast("int").alias("size"),
        )
    )


def ranked(pieces: DataFrame, histogram: dict[int, int], part_rows: int = PART_ROWS) -> DataFrame:
    """``pieces`` with ``rank`` (from 0) among those of the same size. No size is ranked in one task: each is split by a hash
    into parts of about ``part_rows``, and ranks inside a part are moved up by what the parts before it hold."""
    spark = pieces.sparkSession
    # one row for each size: at most the capacity
    parts = spark.createDataFrame([(n, -(-count // part_rows)) for n, count in sorted(histogram.items())] or [(0, 1)], "size int, parts bigint")
    marked = pieces.join(F.broadcast(parts), "size").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("parts"))).drop("parts")
    inside = marked.withColumn("inner", F.row_number().over(Window.partitionBy("size", "part").orderBy("doc_id", "piece")) - 1)
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy("size", "part").agg(F.count("*").alias("n"))
    moved = counts.select("size", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("moved"))
    return inside.join(moved, ["size", "part"]).withColumn("rank", F.col("inner") + F.col("moved")).drop("part", "inner", "moved")


def fill_containers(sized: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """``doc_id``, ``piece``, ``start`` (of the piece in the text), ``size``, ``container_id``, ``position`` (in the container).

    ``sized`` has ``doc_id`` and ``n_tokens``. A text of no tokens takes no
    room: it comes out once, with null container and position. Null sizes take
    no part. Equal sizes are ranked by a hash of the id, so the result is the
    same for any partitioning.
    """
    pieces = cut(pieces_of(sized, capacity))
    filled = pieces.filter("size > 0")
    histogram = {r["size"]: r["n"] for r in filled.groupBy("size").agg(F.count("*").alias("n")).collect()}
    slots = Slots(pack_histogram(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            container, position = slots.place(batch.column("size").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "size")), pa.array(container), pa.array(position)], names=names
            )

    names = ["doc_id", "piece", "start", "size", "container_id", "position"]
    schema = "doc_id bigint, piece int, start bigint, size int, container_id bigint, position bigint"
    placed = ranked(filled, histogram, part_rows).select("doc_id", "piece", "start", "size", F.col("rank").cast("bigint").alias("rank")).mapInArrow(place, schema)
    empty = pieces.filter("size <= 0").select(
        "doc_id", "piece", "start", "size", F.lit(None).cast("bigint").alias("container_id"), F.lit(None).cast("bigint").alias("position")
    )
    return placed.unionAll(empty)
