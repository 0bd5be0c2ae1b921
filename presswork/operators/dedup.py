"""Greedy de-duplication whose outcome depends on the order of rows, done in parallel.

A scan that keeps a row unless an earlier kept row matches it keeps the
lexicographically first maximal independent set of the match graph. It is
found in rounds: a row without undecided smaller neighbour is kept, and the
neighbours of kept rows are dropped. Where the later row may win, and a row
already dropped goes on eliminating within its scan, the scan is replayed
along chains of matches inside each connected component.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.numbers import extract_numbers
from presswork.functions.similarity import title_words
from presswork.functions.text import strip
from presswork.operators.alike import pairs_of_run
from presswork.operators.events import pairs_of_cells
from presswork.operators.pairs import DAY, WINDOW
from presswork.session import cut, release

#: Positions in one run, in which pairs of titles are found.
RUN = 4_000
#: Buckets for the guests of rows without a date, and parts of cells for each partition of a shuffle.
BUCKETS, PARTS = 8, 8


def first_titles(rows: DataFrame, pos: str = "pos", title: str = "news_title") -> DataFrame:
    """``pos`` of the first row of each title (stripped, case ignored). Null titles are equal to each other."""
    key = F.coalesce(F.lower(strip(F.col(title))), F.lit("none"))
    return rows.groupBy(key.alias("_key")).agg(F.min(pos).alias("pos")).select("pos")


def first_independent(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``pos`` of the rows that a greedy scan in order of ``pos`` keeps; ``edges`` has ``pos_i`` < ``pos_j``.

    Each round decides every row whose smaller neighbours are decided; the
    undecided edges shrink until none is left.
    """
    open_ = cut(edges.select("pos_i", "pos_j").distinct())
    dropped: list[DataFrame] = []
    while not open_.isEmpty():
        # heads: endpoints that no open edge reaches from a smaller row; each round decides at least the smallest open row
        heads = open_.select("pos_i").distinct().join(open_.select(F.col("pos_j").alias("pos_i")).distinct(), "pos_i", "left_anti")
        gone = cut(open_.join(heads, "pos_i", "left_semi").select(F.col("pos_j").alias("pos")).distinct())
        dropped.append(gone)
        before = open_
        # a head's edges all lead to rows that are gone now
        rest = open_.join(gone.select(F.col("pos").alias("pos_j")), "pos_j", "left_anti")
        open_ = cut(rest.join(gone.select(F.col("pos").alias("pos_i")), "pos_i", "left_anti").select("pos_i", "pos_j"))
        release(before)
    rows = vertices.select("pos")
    return rows.join(reduce(DataFrame.unionAll, dropped), "pos", "left_anti") if dropped else rows


def title_matches(rows: DataFrame, ratio: float | None = 0.85, window: int = WINDOW, rules: bool = True) -> DataFrame:
    """``pos_i``, ``pos_j`` of rows in one window that tell the same story.

    At most 3 days apart, and more than ``ratio`` alike in their titles, or
    with the same names and similar numbers within 1 day, or the same names
    and core words within 2 days. ``rows`` has ``pos``, ``news_title``,
    ``names`` (as one text) and ``published_date``. Rows go to runs of
    positions, each with the rows that the windows of its last ones hold, and
    the pairs of a run are found in one place, so that none is shuffled.
    ``ratio=None`` leaves the ratio out, ``rules=False`` the rules on names. A
    null date passes the 3 days but none of the shorter spans.
    """
    low = F.lower(F.coalesce("news_title", F.lit("none")))
    size = max(RUN, window + 1)
    run = F.floor((F.col("pos") - 1) / size)
    # a run also has the rows that the windows of its last rows hold
    runs = F.array_compact(F.array(run, F.when((F.col("pos") - 1) % size < window, run - 1)))
    featured = rows.select(
        F.explode(runs).alias("run"),
        "pos",
        low.alias("title"),
        F.unix_micros("published_date").alias("date"),
        F.lower(F.coalesce("names", F.lit(""))).alias("names"),
        *([extract_numbers(low).alias("numbers"), title_words(low).alias("words")] if rules else []),
    )

    def matched(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        columns = {c: pa.concat_arrays(table.column(c).chunks) for c in table.column_names}
        own = int(((columns["pos"].to_numpy() - 1) // size == columns["run"][0].as_py()).sum())
        pos_i, pos_j = pairs_of_run(columns, own, window, ratio, rules)
        return pa.table({"pos_i": pa.array(pos_i, pa.int64()), "pos_j": pa.array(pos_j, pa.int64())})

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return featured.repartition(partitions, "run").groupBy("run").applyInArrow(matched, "pos_i bigint, pos_j bigint")


def title_dedup(rows: DataFrame, ratio: float | None = 0.85, window: int = WINDOW) -> DataFrame:
    """``pos`` of the rows that survive exact titles and then the greedy scan over ``title_matches``.

    Rows dropped for their exact title keep their place in the windows but
    neither lead nor are dropped again.
    """
    kept = cut(first_titles(rows))
    return first_independent(kept, title_matches(rows.join(kept, "pos", "left_semi"), ratio, window))


def components(edges: DataFrame) -> DataFrame:
    """``pos``, ``component`` (smallest position) of all endpoints, by alternating large-star and small-star steps."""
    stars = cut(edges.select(F.least("pos_i", "pos_j").alias("a"), F.greatest("pos_i", "pos_j").alias("b")).filter("a <> b").distinct())
    before = None
    while True:  # the two steps make progress until every component is one star
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours go to the smallest neighbour
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        # small star: a row and its smaller neighbours go to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        last = stars
        stars = cut(small.unionAll(large.join(low, "b").select(F.col("m").alias("a"), "b")).filter("a <> b").distinct())
        release(last)
        state = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return stars.select(F.col("b").alias("pos"), F.col("a").alias("component")).unionAll(
        stars.select(F.col("a").alias("pos"), F.col("a").alias("component")).distinct()
    )


def replay(edges: list[tuple[int, int, int, float, float]]) -> set[int]:
    """Positions dropped by the scan over ``(group_rank, i, j, score_i, score_j)`` in order: the lower score goes, the
    later row at equality. Whether ``i`` is gone is asked once at the start of its turn in a group."""
    dropped: set[int] = set()
    turn, skip = None, False
    for group, i, j, score_i, score_j in sorted(edges):
        if turn != (group, i):
            turn, skip = (group, i), i in dropped
        if not skip and j not in dropped:
            dropped.add(j if score_i >= score_j else i)
    return dropped


def event_matches(rows: DataFrame, days: int = 3) -> DataFrame:
    """``pos_i``, ``pos_j``, ``group_rank``, ``score_i``, ``score_j`` of rows of one tag and category, at most ``days`` apart,
    that tell of the same event. ``rows`` as in ``event_dedup``.

    ``group_rank`` is as in ``tagged_pairs``. Rows are put into cells, and the pairs of a cell are formed and decided in one place,
    so that neither they nor the facts of their rows are shuffled."""
    base = rows.select(
        "pos",
        F.unix_micros("published_date").alias("ts"),
        F.lower(F.coalesce("category_tag", F.lit(""))).alias("category"),
        F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("score"),
        "facts",
        F.explode(F.when(F.size("tags") > 0, F.array_distinct("tags")).otherwise(F.array(F.lit("General")))).alias("tag"),
    )
    first = base.groupBy("tag").agg(F.min("pos").alias("group_rank"))
    # a cell has some days of a tag and category as its own rows, and those of the next ones as guests; the rows without a date
    # own cells in which all rows are guests, each in one of a number of buckets
    block = F.floor(F.col("ts") / (DAY * (days + 1)))
    none, bucket = F.lit(None).cast("bigint"), F.pmod("pos", F.lit(BUCKETS)).cast("int")

    def cell(block: Column, bucket: Column, own: bool) -> Column:
        return F.struct(block.alias("block"), bucket.alias("bucket"), F.lit(own).alias("own"))

    guest = cell(none, bucket, False)
    dated = F.array(cell(block, F.lit(0), True), cell(block - 1, F.lit(0), False), guest)
    undated = F.array(*[cell(none, F.lit(b), True) for b in range(BUCKETS)], guest)
    placed = base.withColumn("cell", F.explode(F.when(F.col("ts").isNotNull(), dated).otherwise(undated))).select(
        *base.columns, "cell.*"
    )
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("tag", "category", "block", "bucket"), F.lit(partitions * PARTS))

    def matched(table: pa.Table) -> pa.Table:
        columns = {c: pa.concat_arrays(table.column(c).chunks) for c in table.column_names}
        pos, score, tag = columns["pos"].to_numpy(), columns["score"].to_numpy(), columns["tag"]
        found = [pa.table([pos[i], pos[j], tag.take(pa.array(i)), score[i], score[j]], schema=schema) for i, j in pairs_of_cells(columns, days)]
        return pa.concat_tables(found) if found else schema.empty_table()

    schema = pa.schema([("pos_i", pa.int64()), ("pos_j", pa.int64()), ("tag", pa.string()), ("score_i", pa.float64()), ("score_j", pa.float64())])
    told = placed.withColumn("part", part).repartition(partitions, "part").groupBy("part")
    pairs = told.applyInArrow(matched, "pos_i bigint, pos_j bigint, tag string, score_i double, score_j double").join(first, "tag")
    return pairs.groupBy("pos_i", "pos_j").agg(F.min("group_rank").alias("group_rank"), F.first("score_i").alias("score_i"), F.first("score_j").alias("score_j"))


def event_dedup(rows: DataFrame, days: int = 3) -> DataFrame:
    """``pos`` of the rows that survive the comparison of events within groups.

    ``rows`` has ``pos``, ``tags`` (array), ``category_tag``, ``published_date``,
    ``score`` and ``facts`` (map). Only rows of one tag and category at most
    ``days`` apart are compared; null and NaN scores count as 0. A component of
    matches is replayed in one place, and matches join only reports of the same
    event.
    """
    matched = cut(event_matches(rows, days))
    owned = matched.join(components(matched).select(F.col("pos").alias("pos_i"), "component"), "pos_i")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        edges = list(group[["group_rank", "pos_i", "pos_j", "score_i", "score_j"]].itertuples(index=False, name=None))
        return pd.DataFrame({"pos": sorted(replay(edges))}, dtype="int64")

    # several components at a time: they don't touch each other, so one scan over their matches is each one's scan
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("component"), F.lit(partitions * PARTS)).alias("part")
    gone = owned.groupBy(part).applyInPandas(run, "pos bigint")
    return rows.select("pos").join(gone, "pos", "left_anti")
