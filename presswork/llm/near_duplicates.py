"""Near-duplicate texts above a stated likeness of their word sequences.

Equal texts are collapsed first. Each other text gets a sketch by fast
similarity sketching: in round after round every element is thrown into a
hashed bin with a hashed value, until all bins are filled; after as many
rounds as bins, each further round fills one named bin, so no bin stays empty
and the share of equal coordinates is concentrated around the likeness. Bands
of coordinates name the candidates, a bit signature thins them, and the whole
sets of word sequences decide exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.operators.skew import HOT_ROWS, join_unique
from presswork.session import cut

#: Words in a sequence, and least likeness, unless a caller states others.
WORDS, LIKENESS = 5, 0.8
#: Coordinates in a band, and bands, at likeness 0.7: a pair just there is missed with probability 0.002, one at 0.75 with 0.00006.
ROWS, BANDS = 6, 50
#: One-bit coordinates of the signature.
BITS = 256
#: Ids (8 bytes each) up to which they are sent to the texts instead of shuffling these.
FEW = 1_000_000
#: Rows of one band, or copies of one text, beyond which their pairs are found in several tasks.
BLOCK = 5_000


def hashed_words(text: Column) -> Column:
    """Hashes of the words (runs of letters and digits, lower-cased) of a text, in order."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.xxhash64(w))


def word_sequences(tokens: Column, words: int) -> Column:
    """The distinct sequences of ``words`` successive words; a shorter text is one sequence, an empty one has none."""
    runs = F.transform(F.sequence(F.lit(0), F.size(tokens) - words), lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(words)]))
    return F.when(F.size(tokens) >= words, F.array_distinct(runs)).when(F.size(tokens) > 0, F.array(F.xxhash64(tokens))).otherwise(
        F.array().cast("array<bigint>")
    )


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit values under a seed."""
    x = x + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def sequences_of(tokens: np.ndarray, sizes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed sequences of flat token lists: the element and its text, sorted by text."""
    starts = np.cumsum(sizes) - sizes
    counts = np.where(sizes >= words, sizes - words + 1, (sizes > 0).astype(np.int64))
    text = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[text] + offset
    code = np.zeros(len(text), np.uint64)
    for k in range(words):
        inside = offset + k < sizes[text]
        token = np.where(inside, tokens[np.minimum(at + k, max(len(tokens) - 1, 0))] if len(tokens) else 0, 0).astype(np.uint64)
        code = mix(code ^ token, k)
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    return code[new], text[new]


def similarity_sketch(code: np.ndarray, text: np.ndarray, texts: int, bins: int) -> np.ndarray:
    """Sketch of each text: for each bin the round that filled it and the least value of that round.

    ``text`` is sorted. A text without elements keeps all ones.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(texts * bins, empty, np.uint64)
    for number in range(2 * bins):
        if not len(code):
            break
        h = mix(code, number)
        value = np.uint64(number << 40) | (h & np.uint64(0xFFFFFFFFFF))
        bin_ = (h >> np.uint64(40)) % np.uint64(bins) if number < bins else np.full(len(h), number - bins, np.uint64)
        np.minimum.at(sketch, text * bins + bin_.astype(np.int64), value)
        if number < 4 or number % 4 == 0:
            open_ = (sketch.reshape(texts, bins) == empty).any(1)
            keep = open_[text]
            code, text = code[keep], text[keep]
    return sketch.reshape(texts, bins)


def band_keys(sketch: np.ndarray, kind: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; texts of different kinds share none."""
    bands = sketch.shape[1] // rows
    keys = mix(np.repeat(kind.astype(np.uint64)[:, None], bands, 1) * np.uint64(1 << 32) + np.arange(bands, dtype=np.uint64), 1000)
    for r in range(rows):
        keys = mix(keys ^ sketch[:, r : bands * rows : rows], r)
    return keys.view(np.int64)


def bit_signature(sketch: np.ndarray, bits: int = BITS) -> np.ndarray:
    """One bit of each of the first coordinates, packed into 64-bit words."""
    parity = (mix(sketch[:, :bits], 77) & np.uint64(1)).astype(np.uint8)
    return np.packbits(parity, axis=1).view(np.int64)


def bits_alike(least: float, bits: int = BITS) -> int:
    """Equal bits that a pair at likeness ``least`` has but for chances below one in ten milliards."""
    share = (1 + least) / 2
    return int(bits * share - 6.5 * (bits * share * (1 - share)) ** 0.5)


def _only(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi- or anti-join on ``article_id``. The planner doesn't know the size of computed ids, so it is counted here: up to
    ``FEW`` they go to the texts, beyond that both are shuffled."""
    return df.join(F.broadcast(ids) if ids.count() <= FEW else ids, "article_id", how)


def _pairs_by(rows: DataFrame, key: str, columns: tuple[str, ...], block: int) -> DataFrame:
    """Pairs of rows of one ``key``: ``columns`` as ``..._a`` and ``..._b``, with ``rep_a`` < ``rep_b``.

    ``n`` is the number of rows of the key. Keys of more than ``block`` rows
    are split: one side into parts of about that size, to each of which the
    other side is sent.
    """
    parts = F.ceil(F.col("n") / block).cast("int")
    many = rows.filter(F.col("n") > 1)
    left = many.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int")).select(key, "part", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = many.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(key, "part", *[F.col(c).alias(f"{c}_b") for c in columns])
    return left.join(right, [key, "part"]).filter(F.col("rep_a") < F.col("rep_b")).drop("part")


def equal_texts(texts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rep``, ``article_id``, ``n`` of all texts that occur more than once (``n`` times; the smallest id stands for all)."""
    keyed = texts.select("article_id", F.xxhash64("kind", "text").alias("k1"), F.hash("text", F.length("text")).alias("k2"))
    classes = keyed.groupBy("k1", "k2").agg(F.min("article_id").alias("rep"), F.count("*").alias("n")).filter(F.col("n") > 1)
    classes = classes.withColumn("weight", F.col("n"))
    return join_unique(keyed, classes, ["k1", "k2"], "weight", F.col("article_id"), hot_rows).select("rep", "article_id", "n")


def sketches(texts: DataFrame, words: int, rows: int, bands: int) -> DataFrame:
    """``rep``, ``size`` (distinct sequences), ``bits`` (signature) and ``bands`` (keys) of each text with words."""
    bins = rows * bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                values = batch.column("tokens")
                sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                tokens = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                code, text = sequences_of(tokens, sizes, words)
                sketch = similarity_sketch(code, text, len(sizes), bins)
                keys = band_keys(sketch, batch.column("kind").to_numpy(), rows)
                signature = bit_signature(sketch, min(BITS, bins // 64 * 64))
                some = np.flatnonzero(sizes > 0)
                width = [np.arange(0, (len(some) + 1) * n, n, dtype=np.int32) for n in (signature.shape[1], bands)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("article_id").take(pa.array(some)),
                        pa.array(np.bincount(text, minlength=len(sizes))[some].astype(np.int32)),
                        pa.ListArray.from_arrays(width[0], signature[some].ravel()),
                        pa.ListArray.from_arrays(width[1], keys[some].ravel()),
                    ],
                    names=["rep", "size", "bits", "bands"],
                )

    tokenised = texts.select("article_id", F.col("kind").cast("bigint").alias("kind"), hashed_words(F.col("text")).alias("tokens"))
    return tokenised.mapInArrow(run, "rep bigint, size int, bits array<bigint>, bands array<bigint>")


def candidate_pairs(sketched: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``: pairs that share a band, whose sizes allow the likeness and whose signatures are near it."""
    banded = sketched.select("rep", "size", F.explode("bands").alias("band")).withColumn("n", F.count("*").over(Window.partitionBy("band")))
    fits = F.least("size_a", "size_b") >= F.lit(least) * F.greatest("size_a", "size_b") - 1e-6
    pairs = _pairs_by(banded, "band", ("rep", "size"), block).filter(fits).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    signed = sketched.select("rep", "bits")
    joined = pairs.join(signed.select(F.col("rep").alias("a"), F.col("bits").alias("bits_a")), "a").join(
        signed.select(F.col("rep").alias("b"), F.col("bits").alias("bits_b")), "b"
    )
    differ = F.aggregate(
        F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda total, n: total + n
    )
    bits = 64 * F.size("bits_a")
    # the share of equal bits at the least likeness, less 6.5 standard deviations
    share = (1 + least) / 2
    needed = bits * share - F.sqrt(bits) * (6.5 * (share * (1 - share)) ** 0.5)
    return joined.filter(bits - differ >= F.floor(needed)).select("a", "b")


def near_duplicate_classes(
    texts: DataFrame,
    least: float = LIKENESS,
    words: int = WORDS,
    rows: int = ROWS,
    bands: int = BANDS,
    hot_rows: int = HOT_ROWS,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Links between different texts (``a``, ``b``, ``likeness``), and membership of equal ones (``rep``, ``article_id``).

    ``texts`` has ``article_id``, ``kind`` (only texts of one kind are
    compared) and ``text``. Null texts take no part; one without words is like
    no other; one shorter than ``words`` counts as a single sequence.
    """
    texts = texts.select("article_id", "kind", "text").filter(F.col("text").isNotNull())
    members = cut(equal_texts(texts, hot_rows))
    copies = members.filter(F.col("rep") != F.col("article_id")).select("article_id")
    distinct = _only(texts, copies, "left_anti")
    sketched = cut(sketches(distinct, words, rows, bands))
    pairs = cut(candidate_pairs(sketched, least, block))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("article_id")).distinct()
    tokens = _only(distinct, wanted, "left_semi").select("article_id", hashed_words(F.col("text")).alias("tokens"))
    sets = tokens.select("article_id", word_sequences(F.col("tokens"), words).alias("s"))
    both = F.size(F.array_intersect("sa", "sb"))
    links = (
        pairs.join(sets.select(F.col("article_id").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("article_id").alias("b"), F.col("s").alias("sb")), "b")
        .withColumn("both", both)
        .select("a", "b", (F.col("both") / (F.size("sa") + F.size("sb") - F.col("both"))).alias("likeness"))
        .filter(F.col("likeness") >= least - 1e-12)
    )
    return links, members


def near_duplicate_pairs(texts: DataFrame, **settings) -> DataFrame:
    """``article_a``, ``article_b`` (smaller id first): all pairs at least so alike, equal texts with words included."""
    links, members = near_duplicate_classes(texts, **settings)
    links = links.select("a", "b")
    # members of a class: itself, or all its copies
    of_a = links.join(members.select(F.col("rep").alias("a"), F.col("article_id").alias("copy_a")), "a", "left")
    of_both = of_a.join(members.select(F.col("rep").alias("b"), F.col("article_id").alias("copy_b")), "b", "left")
    different = of_both.select(F.coalesce("copy_a", "a").alias("x"), F.coalesce("copy_b", "b").alias("y"))
    worded = members.join(
        texts.filter(F.col("text").rlike(r"[\p{L}\p{N}]")).select(F.col("article_id")), "article_id", "left_semi"
    )
    copies = worded.select(F.col("rep").alias("key"), F.col("article_id").alias("rep"), "n")
    equal = _pairs_by(copies, "key", ("rep",), settings.get("block", BLOCK)).select(F.col("rep_a").alias("x"), F.col("rep_b").alias("y"))
    return different.unionAll(equal.select("x", "y")).select(F.least("x", "y").alias("article_a"), F.greatest("x", "y").alias("article_b"))


def near_duplicate_report(texts: DataFrame, **settings) -> DataFrame:
    """``article_id``, ``class_id``, ``links``: one row per text with its class of equal texts and the number of
    different texts (classes) that are at least so alike."""
    links, members = near_duplicate_classes(texts, **settings)
    members = members.drop("n")
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    rows = texts.filter(F.col("text").isNotNull()).select("article_id").join(members, "article_id", "left")
    return (
        rows.select("article_id", F.coalesce("rep", "article_id").alias("class_id"))
        .join(degree, "class_id", "left")
        .select("article_id", "class_id", F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
    )
