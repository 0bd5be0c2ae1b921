"""New batches checked for repeats against all accepted history, which is kept as an index.

The text of a record is the sorted sequence of the hashed distinct words of
its title; a second text holds the canonical link. For each batch an immutable
segment is stored: the suffixes of its concatenated texts, cut at the
guaranteed match length and sorted; the texts themselves; and the articles
that can be a first one. Segments of equal level are merged, all at once with
the batch that completes them, so there are O(log batches) of them. A new batch
reads the part of the index near its dates and never the articles of earlier
batches: its own suffixes are sorted, and the stored ones are looked up among
them by binary search. The long matches are counted for each pair of records
(their coverage), and pairs covered enough are compared by their whole sets of
hashed words. Links found so are the same page
only if their canonical texts are equal.

Guaranteed match length: two sorted word sequences with ``s`` shared words and
``d`` others agree, somewhere, in a run of ``ceil(s / (d + 1))`` shared words.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.operators.skew import HOT_ROWS, join_unique
from presswork.session import cut, ensure_checkpoint_dir, release

#: Least likeness of the words of two titles.
LIKENESS = 0.85
#: Most hours between the dates of a repeat by title.
HOURS = 72
#: Words of texts that one shard of a lookup holds, about.
SHARD_WORDS = 2_000_000
#: Candidate pairs looked at together in a shard.
CHUNK = 2_000_000
#: Runs of a batch up to which they are sent to the stored ones (28 bytes each); a tenth as many pairs are broadcast.
FEW = 1_000_000
#: Bits of the map of asked runs by which the stored ones are thinned out: 1 MB.
BITS = 1 << 23
#: Rows of one text in a batch up to which all are kept as possible firsts; of more only those that can be one.
ALL_KEPT = 100
#: Parts into which the rows of a hot text are split.
SALTS = 16
#: The bucket of all links; those of titles are spans of time.
LINKS = -(2**30)
#: Texts of more words than this share the match length of this many.
TOP = 120

#: Host prefixes of the same page, and parameters that do not identify a story.
HOST_PREFIX = r"^(?:(?:www\d?|m|mobile|amp|lite|touch|wap)\.)+"
LIGHT_PATH = r"(?:/(?:amp|lite|mobile|print))+/*$|\.amp$"
PASSING_PARAMETER = (
    r"(?i)^(?:utm_\w+|\w*clid|ref|referr?er|ref_src|from|src|source|share|shared|cmp|cmpid|campaign|mc_\w+|amp|output(?:type)?"
    r"|spm|via|igshid|ncid|feed|rss|medium|trk|s?cid)(?:=|$)"
)


def canonical_link(link: Column) -> Column:
    """What links to the same page agree in: host, path and the parameters that identify the story.

    Null, blank and hostless links give null.
    """
    text = F.regexp_replace(F.trim(link), r"(?s)#.*$", "")
    text = F.regexp_replace(text, r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//", "")

    def parts(text: Column) -> Column:
        host = F.lower(F.regexp_extract(text, r"^([^/?]*)", 1))
        host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)$", ""), HOST_PREFIX, "")
        path = F.regexp_extract(text, r"^[^/?]*([^?]*)", 1)
        path = F.regexp_replace(F.regexp_replace(path, r"/+$", ""), LIGHT_PATH, "")
        path = F.regexp_replace(F.regexp_replace(path, r"^/(?:amp|lite|m|mobile)(?=/)", ""), r"/+$", "")
        query = F.regexp_extract(text, r"^[^?]*\?(.*)$", 1)
        kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(PASSING_PARAMETER)))
        return F.struct(host.alias("host"), path.alias("path"), F.when(F.contains(text, F.lit("?")), F.array_join(kept, "&")).otherwise("").alias("query"))

    def whole(p: Column) -> Column:
        return F.when(p["host"] != "", F.concat(p["host"], p["path"], F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(F.lit(""))))

    return _once(_once(text, parts), whole)


def _once(value: Column, then) -> Column:
    """``then(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def distinct_words(text: Column) -> Column:
    """The distinct words (runs of letters and digits, lower-cased) of a text; null gives null."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def link_tokens(page: Column) -> Column:
    """The text of a canonical link in the index: three independent hashes, the first 96 bits of its SHA-256."""
    digest = F.sha2(page, 256)
    return F.array(*[(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") - 2**31).cast("int") for i in range(3)])


def match_length(n: int, least: float = LIKENESS) -> int:
    """The run of shared words that a text of ``n`` words surely has with every text at least so alike."""
    found = n
    for other in range(max(1, int(np.ceil(least * n - 1e-9))), int(n / least + 1e-9) + 1):
        for shared in range(1, min(n, other) + 1):
            if shared >= least * (n + other - shared) - 1e-9:
                found = min(found, -(-shared // (n + other - 2 * shared + 1)))
    return found


def class_lengths(least: float = LIKENESS, classes: int = 128) -> list[int]:
    """The match length of each class of sizes; sizes of one class differ by less than the factor 1 / ``least``, so texts so
    alike are of one class or of neighbours, and share a run of the length of either's class."""
    by_size = [0] + [match_length(n, least) for n in range(1, TOP + 1)]
    # beyond TOP the run only grows towards least / (1 - least)
    by_size[TOP] = min(by_size[TOP // 2 :])
    step = math.log(1 / least)
    found: dict[int, int] = {}
    for n in range(1, TOP + 1):
        c = int(math.log(n) / step + 1e-9)
        found[c] = min(found.get(c, n), by_size[n])
    return [found.get(c, 1 if c < max(found) else by_size[TOP]) for c in range(classes)]


def _class(n: Column, least: float) -> Column:
    return F.floor(F.log(n) / F.lit(math.log(1 / least)) + F.lit(1e-9)).cast("int")


def _lengths(of: Column, least: float, beside: tuple[int, ...] = (0,)) -> Column:
    """The distinct match lengths of class ``of`` and of those ``beside`` it, as far as a text of ``size`` words has them."""
    known = F.array(*map(F.lit, class_lengths(least)))
    found = [F.when(of + k >= 0, F.element_at(known, of + k + 1)) for k in beside]
    return F.filter(F.array_distinct(F.array(*found)), lambda n: n <= F.col("size"))


def _suffixes(bucket: Column) -> Column:
    """The suffixes of a text's ``tokens``, cut at ``length``, as hashes that include the bucket."""
    starts = F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)
    return F.explode(F.array_distinct(F.transform(starts, lambda i: F.xxhash64(bucket, F.slice("tokens", i, F.col("length")), F.col("length"))))).alias("run")


ASKED = ("run", "text_id", "sign", "size")


def in_order(asked: pa.Table) -> dict[str, np.ndarray]:
    """The columns of ``ASKED``, sorted by run."""
    order = np.argsort(asked.column("run").to_numpy(), kind="stable")
    return {c: asked.column(c).to_numpy()[order] for c in ASKED}


def long_matches(asked: dict[str, np.ndarray], held: pa.Table | pa.RecordBatch, least: float = LIKENESS) -> Iterator[pa.RecordBatch]:
    """Pairs of ``asked`` (in order) and ``held`` texts with the number of runs they share, without those whose signatures
    exclude it. Each held suffix is looked up among the sorted asked ones by binary search."""
    names = ["query_id", "text_id", "asked_size", "held_size", "runs"]
    run = held.column("run").to_numpy()
    first, last = np.searchsorted(asked["run"], run, "left"), np.searchsorted(asked["run"], run, "right")
    hits = last - first
    some = np.flatnonzero(hits > 0)
    if not len(some):
        return
    held_id, held_sign, held_size = (held.column(c).to_numpy() for c in ("text_id", "sign", "size"))
    bounds, begin = np.cumsum(hits[some]), 0
    while begin < len(some):
        end = max(begin + 1, int(np.searchsorted(bounds, (bounds[begin - 1] if begin else 0) + CHUNK, "right")))
        part = some[begin:end]
        n = hits[part]
        q = np.repeat(first[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        h = np.repeat(part, n)
        total = asked["size"][q] + held_size[h]
        differ = np.bitwise_count((asked["sign"][q] ^ held_sign[h]).view(np.uint64))
        near = differ <= total - 2 * np.ceil(least * total / (1 + least) - 1e-9)
        q, h = q[near], h[near]
        pair = np.empty(len(q), [("q", np.int64), ("h", np.int64), ("m", np.int64), ("n", np.int64)])
        pair["q"], pair["h"], pair["m"], pair["n"] = asked["text_id"][q], held_id[h], asked["size"][q], held_size[h]
        pair, count = np.unique(pair, return_counts=True)
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(pair[c])) for c in "qhmn"), pa.array(count.astype(np.int64))], names=names)
        begin = end


def prepared(articles: DataFrame, hours: int = HOURS) -> DataFrame:
    """``article_id``, ``ts``, ``bucket``, ``side``, ``tokens``, ``page``, ``text_id``: a row for the title and one for the link of each article.

    A bucket of titles is twice ``hours`` wide, so what is near a row lies in
    its bucket and in the one before (``side`` -1) or after it (1).
    """
    micros = hours * 3_600_000_000
    # each link and title is taken apart once: both rows come from one array
    base = articles.filter(F.col("article_id").isNotNull()).select(
        "article_id",
        F.unix_micros(F.col("published_date").cast("timestamp")).alias("ts"),
        canonical_link(F.col("link")).alias("page"),
        distinct_words(F.col("news_title")).alias("words"),
    )
    titled = F.struct(
        F.col("ts").alias("ts"),
        F.floor(F.col("ts") / (2 * micros)).cast("int").alias("bucket"),
        (F.pmod(F.floor(F.col("ts") / micros), F.lit(2)) * 2 - 1).cast("int").alias("side"),
        F.array_sort(F.array_distinct(F.transform("words", lambda w: F.hash(w)))).alias("tokens"),
        F.lit("").alias("page"),
        F.when(F.col("ts").isNotNull() & (F.size("words") > 0), F.array_join(F.array_sort("words"), " ")).alias("key"),
    )
    linked = F.struct(
        F.lit(None).cast("bigint").alias("ts"),
        F.lit(LINKS).alias("bucket"),
        F.lit(0).alias("side"),
        link_tokens(F.col("page")).alias("tokens"),
        F.col("page").alias("page"),
        F.col("page").alias("key"),
    )
    both = base.select("article_id", F.explode(F.array(titled, linked)).alias("row")).filter(F.col("row.key").isNotNull())
    return both.select("article_id", "row.ts", "row.bucket", "row.side", "row.tokens", "row.page", F.xxhash64("row.key", "row.bucket", F.lit(7)).alias("text_id"))


def _staircase(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of which no earlier one, or no later one, has a smaller id: the rest is never the smallest in a reach of time."""
    before = Window.partitionBy(*by).orderBy(F.asc("ts"), F.asc("article_id")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc("ts"), F.asc("article_id")).rowsBetween(Window.unboundedPreceding, -1)
    earlier, later = F.min("article_id").over(before), F.min("article_id").over(after)
    return (
        rows.withColumn("_earlier", earlier)
        .withColumn("_later", later)
        .filter(F.col("_earlier").isNull() | F.col("_later").isNull() | (F.col("article_id") < F.col("_earlier")) | (F.col("article_id") < F.col("_later")))
        .drop("_earlier", "_later")
    )


class HistoryIndex:
    """The stored index at ``path``, a folder that all executors share.

    A segment is a folder ``first-last-level-words`` of three parts: ``runs``
    (suffixes in sorted files), ``texts`` and ``firsts`` (articles that can be a first
    one: of each text the smallest ids over time, a logarithmic number for ids
    in any usual order). ``shards`` fixes the number of shards of a lookup. A
    batch of at most ``few`` runs is sent to the index, a larger one meets it in shards.
    """

    SCHEMA = "bucket int, run bigint, text_id bigint, sign bigint, size int, page string, tokens array<int>, article_id bigint, ts bigint, part string"

    def __init__(self, spark: SparkSession, path: str, least: float = LIKENESS, hours: int = HOURS, shards: int | None = None, hot_rows: int = HOT_ROWS, few: int = FEW):
        self.spark, self.path, self.least, self.hours, self.shards, self.hot_rows, self.few = spark, path, least, hours, shards, hot_rows, few
        at = spark._jvm.org.apache.hadoop.fs.Path
        self._at, self._files = at, at(path).getFileSystem(spark._jsc.hadoopConfiguration())
        found = self._files.listStatus(at(path)) if self._files.exists(at(path)) else []
        names = sorted(f.getPath().getName() for f in found if self._files.exists(at(f.getPath(), "_SUCCESS")))
        # a merge that was cut off leaves the segments that it stands for
        self.segments = [n for n in names if not any(m != n and _span(m)[0] <= _span(n)[0] and _span(n)[1] <= _span(m)[1] for m in names)]

    def _read(self, segments: list[str]) -> DataFrame:
        return reduce(DataFrame.unionAll, [self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/{s}") for s in segments])

    def _write(self, name: str, rows: DataFrame) -> None:
        rows.sortWithinPartitions("part", "bucket", "run", "text_id").write.partitionBy("part").mode("overwrite").parquet(f"{self.path}/{name}")

    def _tasks(self, words: int) -> int:
        return self.shards or max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * words // SHARD_WORDS))

    def accept(self, batch: DataFrame) -> DataFrame:
        """``first_id``, ``article_id``: the articles of ``batch`` that repeat one of the index, with the smallest id that
        each repeats. Then the batch is part of the index. ``batch`` has ``article_id``, ``link``, ``news_title`` and
        ``published_date``; null ids take no part; null links, titles without words and null dates match nothing."""
        rows = cut(prepared(batch, self.hours))
        texts = cut(
            rows.groupBy("text_id", "page")
            .agg(F.first("bucket").alias("bucket"), F.first("tokens").alias("tokens"), F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high"))
            .withColumn("size", F.size("tokens"))
            .withColumn("sign", F.expr("aggregate(tokens, 0L, (a, t) -> a | shiftleft(1L, int(pmod(hash(t), 64))))"))
        )
        own = F.when(F.col("bucket") != LINKS, F.col("bucket"))
        counts = [F.sum("size"), F.max("n"), F.sum(self._asks())]
        first, last, words, most, asks = texts.agg(F.min(own), F.max(own), *(F.coalesce(c, F.lit(0)) for c in counts)).first()
        hot = most >= self.hot_rows
        found = self.spark.createDataFrame([], "first_id bigint, article_id bigint")
        self._sent = []
        if self.segments:
            found = cut(self._lookup(rows, texts, (first, last), words, hot, asks))
        self._add(rows, texts, words, most)
        release(rows, texts, *([self._covered] if self._sent else []))
        for value in self._sent:
            value.destroy()
        return found

    def _send(self, value):
        """A broadcast that lives until the batch is done."""
        self._sent.append(self.spark.sparkContext.broadcast(value))
        return self._sent[-1]

    def _probes(self) -> tuple[Column, Column]:
        """The match lengths and the steps to other buckets that a text of a batch is looked up with."""
        # a text so alike is of the same class of sizes or a neighbouring one
        lengths = _lengths(_class(F.col("size"), self.least), self.least, (-1, 0, 1))
        return lengths, F.array_distinct(F.array(F.col("low"), F.lit(0), F.col("high")))

    def _asks(self) -> Column:
        """The number of runs that a text is looked up with, repeated ones counted each time."""
        lengths, steps = self._probes()
        return F.aggregate(lengths, F.lit(0), lambda n, length: n + F.col("size") - length + 1) * F.size(steps)

    def _lookup(self, rows: DataFrame, texts: DataFrame, span: tuple[int | None, int | None], words: int, hot: bool, asks: int) -> DataFrame:
        """The repeats among ``rows``; ``span`` has the first and last bucket of their titles, ``asks`` is at least the number of their runs."""
        near = F.col("bucket") == LINKS
        if span[0] is not None:
            near = near | F.col("bucket").between(span[0] - 1, span[1] + 1)
        held = self._read(self.segments).filter(near)
        lengths, steps = self._probes()
        probes = texts.withColumn("length", F.explode(lengths)).withColumn("step", F.explode(steps))
        asked = probes.select(_suffixes(F.col("bucket") + F.col("step")), "text_id", "sign", "size")
        runs = held.filter(F.col("part") == "runs").select(*ASKED)
        least = self.least
        schema = "query_id bigint, text_id bigint, asked_size bigint, held_size bigint, runs bigint"
        if asks <= self.few:
            # the batch goes to the stored suffixes, which stay where they are
            known = self._send(in_order(asked.toArrow()))

            def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield from long_matches(known.value, batch, least)

            pairs = runs.mapInArrow(look_up, schema)
        else:
            shard = F.pmod(F.col("run"), F.lit(self._tasks(words + sum(_span(s)[3] for s in self.segments)))).cast("int").alias("shard")
            runs = runs.mapInArrow(_maybe_asked(asked, self._send), runs.schema)

            def search(left: pa.Table, right: pa.Table) -> pa.Table:
                return pa.Table.from_batches(list(long_matches(in_order(left), right, least)), _arrow(schema))

            pairs = asked.select("*", shard).groupBy("shard").cogroup(runs.select("*", shard).groupBy("shard")).applyInArrow(search, schema)
        # coverage: the runs that all matches of a pair hold together, and the least that texts so alike have
        total = F.col("asked_size") + F.col("held_size")
        shared = F.ceil(F.lit(least) * total / (1 + least) - 1e-9)
        length = F.element_at(F.array(*map(F.lit, class_lengths(least))), _class(F.col("held_size"), least) + 1)
        covered = pairs.groupBy("query_id", "text_id", "asked_size", "held_size").agg(F.sum("runs").alias("runs"))
        covered = self._covered = cut(covered.filter(F.col("runs") >= shared - (total - 2 * shared + 1) * (length - 1)).select("query_id", "text_id"))
        small = F.broadcast if covered.count() <= self.few // 10 else lambda df: df
        both = F.size(F.array_intersect("tokens", "held_tokens"))
        held_texts = held.filter(F.col("part") == "texts").select("text_id", F.col("page").alias("held_page"), F.col("tokens").alias("held_tokens"))
        wanted = texts.select(F.col("text_id").alias("query_id"), "page", "tokens", "n").join(small(covered), "query_id")
        alike = (
            held_texts.join(small(wanted), "text_id")
            .filter((F.col("page") == F.col("held_page")) & (both >= F.lit(least) * (F.size("tokens") + F.size("held_tokens") - both) - 1e-9))
            .select("query_id", "text_id", "page", "n")
        )
        firsts = held.filter(F.col("part") == "firsts").select("text_id", "page", "bucket", "article_id", "ts")
        before = firsts.join(small(alike), ["text_id", "page"]).drop("text_id")
        # of one bucket a reach of time holds the beginning, the end or all
        before = _staircase(before, "query_id", "page", "bucket") if hot else before
        mapping = before.select(F.col("query_id").alias("text_id"), "page", F.col("article_id").alias("first_id"), F.col("ts").alias("first_ts"), "n")
        slim, keys = rows.select("text_id", "page", "article_id", "ts"), ["text_id", "page"]
        joined = join_unique(slim, mapping, keys, "n", F.col("article_id"), self.hot_rows) if hot else slim.join(mapping.drop("n"), keys)
        return (
            joined.filter(F.col("ts").isNull() | (F.abs(F.col("ts") - F.col("first_ts")) <= self.hours * 3_600_000_000))
            .groupBy("article_id")
            .agg(F.min("first_id").alias("first_id"))
            .select("first_id", "article_id")
        )

    def _add(self, rows: DataFrame, texts: DataFrame, words: int, most: int) -> None:
        number = max((_span(s)[1] for s in self.segments), default=0) + 1
        firsts = rows.groupBy("text_id", "page", "bucket", "ts").agg(F.min("article_id").alias("article_id"))
        if most >= self.hot_rows:
            salted = firsts.withColumn("salt", F.pmod(F.xxhash64("article_id"), F.lit(SALTS)))
            firsts = _staircase(salted, "text_id", "page", "salt").drop("salt")
        if most > ALL_KEPT:
            firsts = _staircase(firsts, "text_id", "page")
        firsts = firsts.withColumn("part", F.lit("firsts"))
        long = texts.withColumn("length", F.explode(_lengths(_class(F.col("size"), self.least), self.least)))
        runs = long.select(F.lit("runs").alias("part"), "bucket", "text_id", "sign", "size", _suffixes(F.col("bucket")))
        kept = texts.select(F.lit("texts").alias("part"), "bucket", "text_id", "page", "tokens")
        new, begin, level, taken = runs.unionByName(kept, True).unionByName(firsts, True), number, 0, []
        # the segments that merge, each of the level that those after it have reached, are written once with the batch
        for old in reversed(self.segments):
            if _span(old)[2] != level:
                break
            taken.append(old)
            begin, level, words = _span(old)[0], level + 1, words + _span(old)[3]
        name = f"{begin:06d}-{number:06d}-{level}-{words}"
        self._write(name, new.unionByName(self._read(taken), True).coalesce(self._tasks(words)) if taken else new)
        self.segments = [*self.segments[: len(self.segments) - len(taken)], name]
        for old in taken:
            self._files.delete(self._at(f"{self.path}/{old}"), True)


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")])


def _maybe_asked(asked: DataFrame, send):
    """A filter of stored runs by a bitmap of the asked ones (``BITS`` bits, whatever their number), which loses none."""
    bit = F.pmod(F.col("run"), F.lit(BITS)) + 1
    marks = asked.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    whole = np.zeros((BITS // 32768, 4096), np.uint8)
    for row in marks.collect():  # at most BITS / 32,768 rows
        whole[row["at"] - 1] = np.frombuffer(row["bits"], np.uint8)
    known = send(whole.ravel())

    def keep(batches):
        for batch in batches:
            bit = batch.column("run").to_numpy() % BITS
            yield batch.filter(pa.array(known.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0))

    return keep


def _span(segment: str) -> tuple[int, ...]:
    """First batch, last batch, level and number of words of a segment."""
    return tuple(map(int, segment.split("-")))


def repeats_of_history(articles: DataFrame, path: str | None = None, **settings) -> DataFrame:
    """``first_id``, ``article_id``: articles that repeat an earlier batch, with the first article they repeat.

    ``articles`` has ``article_id``, ``batch_id``, ``link``, ``news_title`` and
    ``published_date``. A repeat has the same page behind its link, or a title
    whose words are at least ``least`` alike and a date at most ``hours`` away.
    The batches are accepted in order, each against the index of those before
    it; the index is kept at ``path``, or dropped if none is given. Null
    batches take no part.
    """
    spark = articles.sparkSession
    index = HistoryIndex(spark, path or f"{ensure_checkpoint_dir(spark)}/presswork-history-{uuid.uuid4()}", **settings)
    # one row for each batch
    batches = sorted(r[0] for r in articles.select("batch_id").distinct().collect() if r[0] is not None)
    found = [index.accept(articles.filter(F.col("batch_id") == b)) for b in batches]
    if path is None:
        index._files.delete(index._at(index.path), True)
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], "first_id bigint, article_id bigint")
