"""Encoding, packing and reading levels."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from presswork.llm.packing import Slots, fill_containers, pack_histogram
from presswork.llm.reading import calibrate, profile, reading_levels, vocabulary, word_hash
from presswork.llm.tokens import MergeAutomaton, count_tokens, encode_texts, load_automaton, round_trips, vocabulary_path

DOCS = "doc_id bigint, text string, ids string, n_tokens int"


@pytest.fixture(scope="module")
def automaton():
    with open(vocabulary_path(), "rb") as file:
        return load_automaton(file.read())


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(vocabulary_path())
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_same_ids_as_the_library(automaton, library):
    rng = random.Random(3)
    letters = "aaabbéñ日本 \n\tहिन्दीxyzTHEtheing0123<|endoftext|>😀's₹,."
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += ["a" * n for n in range(0, 150, 7)] + ["-" * n for n in range(0, 200, 9)] + [" " * 40, "\u0000", "ab" * 3000, "<|endoftext|>"]
    for text in texts:
        ids = automaton.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert automaton.decode(ids) == text


def test_arcs_hold_exactly_where_no_merge_crosses(automaton, library):
    rng = random.Random(5)
    labels = [t for t in automaton.ids if t.isalpha()]
    for _ in range(3000):
        a, b = rng.choice(labels), rng.choice(labels)
        if len(a + b) and automaton.encode_word(a + b) != [automaton.ids[a], automaton.ids[b]]:
            assert not automaton.arc(a, b) or (a + b) in automaton.ids
        else:
            assert automaton.arc(a, b)


def test_small_vocabulary_with_equal_ranks():
    tokens = {b"x": 0, b"xx": 1, b"y": 2}
    small = MergeAutomaton(tokens, [(b"x", b"x")])
    assert [small.encode_word(b"x" * n) for n in (1, 2, 3, 4, 5)] == [[0], [1], [1, 0], [1, 1], [1, 1, 0]]
    with pytest.raises(ValueError):
        small.encode_word(b"z")


def test_whole_tables(spark, library, tiny):
    from presswork.session import table

    documents = table(spark, tiny, "documents", "doc_id", "text", "lang")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = {r["doc_id"]: list(r["ids"]) for r in encode_texts(documents).collect()}
    assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(documents).collect()} == {i: len(x) for i, x in got.items()}
    assert all(r["same"] for r in round_trips(documents).collect())


def test_null_empty_blank(spark):
    rows = spark.createDataFrame([(1, None, "", 0), (2, "", "", 0), (3, "  ", "", 0)], DOCS)
    got = {r["doc_id"]: r["ids"] for r in encode_texts(rows).collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) > 0
    assert encode_texts(rows.limit(0)).count() == 0


def test_patterns_hold_everything_once():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([5, 10, 100, 2048])
        histogram = Counter(min(capacity, int(rng.expovariate(10 / capacity)) + 1) for _ in range(rng.randint(0, 2000)))
        patterns, back = pack_histogram(dict(histogram), capacity), Counter()
        for count, items in patterns:
            assert sum(n * m for n, m in items) <= capacity
            for n, m in items:
                back[n] += count * m
        assert back == histogram
        slots, used = Slots(patterns), {}
        for n, k in histogram.items():
            container, position = slots.place(np.full(k, n), np.arange(k))
            for c, p in zip(container.tolist(), position.tolist()):
                used.setdefault(c, []).append((p, p + n))
        for spans in used.values():
            spans.sort()
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= capacity


def test_fill_containers(spark):
    rng = random.Random(2)
    sizes = [0, 1, 10, 10, 11, 25, 40] + [rng.choice([3, 3, 3, 7, 9]) for _ in range(300)]
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)] + [(999, None, "x")], "doc_id bigint, n_tokens bigint, rank string")
    got = fill_containers(df, 10).collect()
    pieces, use = {}, Counter()
    for r in got:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["size"]))
        if r["container_id"] is not None:
            use[r["container_id"]] += r["size"]
    for i, n in enumerate(sizes):
        parts = sorted(pieces[i])
        assert sum(p[2] for p in parts) == n and [p[1] for p in parts] == [10 * k for k in range(len(parts))]
        assert len(parts) == max(1, -(-n // 10))
    assert 999 not in pieces and max(use.values()) <= 10
    # full pieces, nines alone, sevens with a three each, the other threes by three, and the few odd sizes
    full = sum(n // 10 for n in sizes)
    best = full + sizes.count(9) + sizes.count(7) + -(-(sizes.count(3) - sizes.count(7)) // 3)
    assert len(use) <= best + 1
    again = fill_containers(df.repartition(3), 10)
    split = fill_containers(df, 10, part_rows=7).collect()
    assert len({r["container_id"] for r in split}) == len({r["container_id"] for r in got}) and len(split) == len(got)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    assert fill_containers(df.limit(0), 10).count() == 0


def test_vocabulary_ranks(spark):
    df = spark.createDataFrame([(1, "a a a b b c C d"), (2, None), (3, ""), (4, "12 !")], "doc_id bigint, text string")
    got = {r["word"]: (r["n"], r["rank"], r["last_rank"]) for r in vocabulary(profile(df), hot_rows=2).collect()}
    assert got == {"a": (3, 1, 1), "b": (2, 2, 3), "c": (2, 2, 3), "d": (1, 4, 4)}


def test_levels_and_the_exact_way_agree(spark):
    from presswork.session import table

    sf = "/root/testdata/sf0.01"
    documents = table(spark, sf, "documents", "doc_id", "text", "lang")
    labels = table(spark, sf, "reading_labels", "doc_id", "band")
    with_head = {r["doc_id"]: r for r in reading_levels(documents, labels).collect()}
    joined = {r["doc_id"]: r for r in reading_levels(documents, labels, head=50).collect()}
    assert with_head.keys() == joined.keys() and len(with_head) == documents.count()
    for i, r in with_head.items():
        assert r["band"] == joined[i]["band"]
        for m in ("cover_50", "cover_90"):
            assert r[m] == joined[i][m] if r[m] is None else r[m] == pytest.approx(joined[i][m])
    held_out = labels.filter("doc_id % 2 = 0").collect()
    half = {r["doc_id"]: r["band"] for r in reading_levels(documents, labels.filter("doc_id % 2 = 1")).collect()}
    right = sum(half[r["doc_id"]] == r["band"] for r in held_out if half[r["doc_id"]] is not None)
    assert right >= 0.9 * len(held_out)


def test_levels_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, band int")
    assert {r["doc_id"]: r["band"] for r in reading_levels(df, none).collect()} == {1: None, 2: None}
    assert reading_levels(df.limit(0), none).count() == 0


def test_word_hash_is_that_of_the_engine(spark):
    words = ["a", "plural", "été", "मार्च", "don't"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()
    assert [r[0] for r in got] == [word_hash(w) for w in words]


def test_calibration_takes_a_bounded_sample_of_labels(spark):
    from presswork.llm.reading import MEASURES

    rows = [(i, i % 3, *[float(i % 3)] * len(MEASURES)) for i in range(3000)]
    measured = spark.createDataFrame(rows, "doc_id bigint, band int, " + ", ".join(f"{m} double" for m in MEASURES))
    scale = calibrate(measured.drop("band"), measured.select("doc_id", "band"), most=300)
    assert [(b["band"], b["mid_cover_50"]) for b in scale] == [(0, 0.0), (1, 1.0), (2, 2.0)]
