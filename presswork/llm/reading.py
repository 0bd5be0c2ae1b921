"""Reading level of each text, on the scale of reviewers' labels.

Words are ranked by their frequency in the whole corpus. For a share of a
text's words, the coverage rank is the size of the smallest frequency-ranked
vocabulary that covers it: specialist texts need rare words even for half of
their text. Coverage ranks and the length of sentences are calibrated in SQL:
for each labelled band the median and the median deviation of each measure,
which a few wrong labels don't move. A text belongs to the band it is nearest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.operators.skew import HOT_ROWS, join_unique
from presswork.session import cut

#: Shares of a text's words for which coverage ranks are taken.
SHARES = (0.5, 0.75, 0.9)
COVERS = ("cover_50", "cover_75", "cover_90")
SENTENCES = ("sentence_words", "word_letters", "long_words")
MEASURES = COVERS + SENTENCES
#: Letters from which a word counts as long.
LONG = 10
#: Most words of the head of the vocabulary that is sent to the workers (16 bytes each); beyond it ranks are joined.
HEAD = 200_000
#: Most labelled texts that the bands are calibrated on.
MAX_LABELLED = 200_000
#: Distinct words that a task counts before it hands its counts on, and whose hashes it remembers.
FLUSH = 500_000
#: Most that one measure counts against a band, in deviations.
FARTHEST = 3.0
#: Least spread of a measure inside a band.
LEAST_SPREAD = 0.02
#: Most bands of a scale.
MAX_BANDS = 100

_WORD = regex.compile(r"\p{L}+(?:['’-]\p{L}+)*")
_SENTENCE = regex.compile(r"[.!?।。！？]+(?=\s|$)|\n\s*\n")

PROFILE = (
    "doc_id bigint, n_words bigint, n_pieces bigint, sentence_words double, word_letters double, long_words double, "
    "words array<bigint>, uses array<int>, word string, n bigint"
)


def words_in(text: str) -> list[str]:
    """Lower-case words: runs of letters, also joined by apostrophes and hyphens."""
    return _WORD.findall(text.lower())


def word_hash(word: str) -> int:
    """The hash of a word that Spark's ``xxhash64`` gives."""
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def profile(documents: DataFrame) -> DataFrame:
    """What all later steps need, by one pass over the texts.

    Rows with a ``doc_id`` are texts with words: their number of words and of
    pieces between white space, the measures of sentences and words, and the
    distinct words (as hashes) with their uses. Rows without are counts of
    ``word`` (``n`` uses), one or a few for each word and task.
    """
    names = [part.split()[0] for part in PROFILE.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string(), pa.int64()]

    def batch_of(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def counts_of(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for begin in range(0, len(words), 50_000):
            part = words[begin : begin + 50_000]
            yield batch_of([[None] * len(part)] * 8 + [part, [counts[w] for w in part]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        hashes: dict[str, int] = {}
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = words_in(text) if text else ()
                if not found:
                    continue
                uses = Counter(found)
                counts.update(uses)
                for w in uses:
                    if w not in hashes:
                        hashes[w] = word_hash(w)
                letters = np.fromiter(map(len, uses), np.int64, len(uses))
                weight = np.fromiter(uses.values(), np.int64, len(uses))
                sentences = sum(1 for part in _SENTENCE.split(text) if part.strip())
                row = (
                    doc_id, len(found), len(text.split()), float(np.log(len(found) / max(1, sentences))),
                    float(np.log((letters * weight).sum() / len(found))), float(weight[letters >= LONG].sum() / len(found)),
                    [hashes[w] for w in uses], list(uses.values()), None, None,
                )
                for column, value in zip(out, row):
                    column.append(value)
                if len(hashes) > FLUSH:
                    hashes.clear()
            yield batch_of(out)
            if len(counts) > FLUSH:
                yield from counts_of(counts)
                counts.clear()
        yield from counts_of(counts)

    return documents.select("doc_id", "text").filter(F.col("text").isNotNull()).mapInArrow(run, PROFILE)


def vocabulary(profiled: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``word``, ``n`` (uses in all texts), ``rank`` (from 1; equal counts share the first rank) and ``last_rank`` (of the equal ones).

    Ranks come from the histogram of counts, so no task sorts the vocabulary;
    the words of one count, as those used once, are joined to it in parts.
    """
    words = cut(profiled.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")))
    levels = words.groupBy("n").agg(F.count("*").alias("words"))
    # one row for each distinct count: at most the square root of twice the corpus
    down = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = levels.withColumn("last_rank", F.sum("words").over(down)).withColumn("rank", F.col("last_rank") - F.col("words") + 1)
    return join_unique(words, ranks, ["n"], "words", F.col("word"), hot_rows).select("word", "n", "rank", "last_rank")


def coverage(profiled: DataFrame, ranked: DataFrame, head: int = HEAD, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_pieces`` and the measures of each text with words: logarithms of the coverage ranks, of
    words per sentence and of letters per word, and the share of long words.

    The words ranked up to ``head`` are sent to the workers; a text whose
    coverage needs rarer words gets its ranks by a join.
    """
    spark = profiled.sparkSession
    texts = profiled.filter(F.col("doc_id").isNotNull())
    top = sorted((word_hash(r["word"]), r["rank"]) for r in ranked.filter(F.col("last_rank") <= head).select("word", "rank").collect())
    known = spark.sparkContext.broadcast((np.array([h for h, _ in top], np.int64), np.array([r for _, r in top], np.int64)))
    beyond = len(top) + 1
    kept = ["doc_id", "n_words", "n_pieces", *SENTENCES]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = known.value
        for batch in batches:
            words, uses = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("words", "uses"))
            sizes = batch.column("words").value_lengths().to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(hashes, words), max(len(hashes) - 1, 0))
            found = np.where(hashes[at] == words, ranks[at], beyond) if len(hashes) else np.full(len(words), beyond)
            covers: list[list] = [[] for _ in SHARES]
            ends = np.cumsum(sizes)
            for begin, end in zip(ends - sizes, ends):
                order = np.argsort(found[begin:end], kind="stable")
                reached = np.cumsum(uses[begin:end][order])
                for column, share in zip(covers, SHARES):
                    rank = int(found[begin:end][order[np.searchsorted(reached, max(1, np.ceil(share * reached[-1])))]])
                    column.append(None if rank == beyond else float(np.log(rank)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, pa.float64()) for c in covers)], names=[*kept, *COVERS])

    schema = "doc_id bigint, n_words bigint, n_pieces bigint, " + ", ".join(f"{m} double" for m in (*SENTENCES, *COVERS))
    measured = texts.select(*kept, "words", "uses").mapInArrow(measure, schema)
    if not ranked.filter(F.col("last_rank") > head).limit(1).count():
        return measured
    measured = cut(measured)
    rare = " or ".join(f"{m} is null" for m in COVERS)
    exact = exact_coverage(texts.join(measured.filter(rare).select("doc_id"), "doc_id", "left_semi"), ranked, hot_rows)
    both = measured.join(exact, "doc_id", "left")
    return both.select(*kept, *[F.coalesce(m, f"exact_{m}").alias(m) for m in COVERS])


def exact_coverage(texts: DataFrame, ranked: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id`` and the coverage measures (as ``exact_...``) by joining each distinct word of a text to its rank; words of
    many texts are split."""
    pairs = texts.select("doc_id", F.explode(F.arrays_zip("words", "uses")).alias("w")).select("doc_id", F.col("w.words").alias("hash"), F.col("w.uses").alias("uses"))
    by_hash = ranked.select(F.xxhash64("word").alias("hash"), "rank", "n").groupBy("hash").agg(F.min("rank").alias("rank"), F.sum("n").alias("n"))
    by_rank = join_unique(pairs, by_hash, ["hash"], "n", F.col("doc_id"), hot_rows).groupBy("doc_id", "rank").agg(F.sum("uses").alias("uses"))
    up = Window.partitionBy("doc_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("uses").over(Window.partitionBy("doc_id"))
    reached = by_rank.select("doc_id", "rank", F.sum("uses").over(up).alias("covered"), total.alias("total"))
    return reached.groupBy("doc_id").agg(
        *[
            F.log(F.min(F.when(F.col("covered") >= F.greatest(F.ceil(F.col("total") * share), F.lit(1)), F.col("rank")))).alias(f"exact_{m}")
            for m, share in zip(COVERS, SHARES)
        ]
    )


def calibrate(measured: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[dict]:
    """For each labelled band the median and the median deviation of each measure, counted in SQL over about ``most`` labels,
    chosen by a hash of the text's id (all of them if there are no more)."""
    given = labels.filter(F.col("band").isNotNull()).select("doc_id", "band")
    total = given.count()
    if total > most:
        given = given.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / total))
    labelled = cut(measured.join(given, "doc_id"))
    middles = labelled.groupBy("band").agg(F.count("*").alias("n"), *[F.percentile(m, 0.5).alias(f"mid_{m}") for m in MEASURES])
    spread = (
        labelled.join(F.broadcast(middles), "band")
        .groupBy("band")
        .agg(
            *[F.first(f"mid_{m}").alias(f"mid_{m}") for m in MEASURES],
            *[(F.percentile(F.abs(F.col(m) - F.col(f"mid_{m}")), 0.5) * 1.4826 + LEAST_SPREAD).alias(f"dev_{m}") for m in MEASURES],
        )
    )
    rows = spread.limit(MAX_BANDS + 1).collect()
    if len(rows) > MAX_BANDS:
        raise ValueError(f"a scale of more than {MAX_BANDS} bands")
    return sorted((r.asDict() for r in rows), key=lambda r: r["band"])


def reading_levels(documents: DataFrame, labels: DataFrame, head: int = HEAD) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_pieces``, the measures and ``band`` of each text; ``band`` is the nearest of the labelled bands.

    Texts without words (null, empty, blank) come out with null measures and
    band; without any labels all bands are null. Equal distances take the
    lower band.
    """
    profiled = cut(profile(documents))
    measured = cut(coverage(profiled, vocabulary(profiled), head))
    scale = calibrate(measured, labels)

    def distance(band: dict):
        total = F.lit(0.0)
        for m in MEASURES:
            off = F.least(F.abs(F.col(m) - F.lit(band[f"mid_{m}"])) / F.lit(band[f"dev_{m}"]), F.lit(FARTHEST))
            total = total + off * off + F.lit(2 * float(np.log(band[f"dev_{m}"])))
        return total

    nearest = (
        F.array_min(F.array(*[F.struct(distance(b).alias("d"), F.lit(b["band"]).alias("band")) for b in scale]))["band"]
        if scale
        else F.lit(None).cast("int")
    )
    levels = measured.withColumn("band", F.when(F.col("n_words") > 0, nearest))
    return documents.select("doc_id").join(levels, "doc_id", "left")
