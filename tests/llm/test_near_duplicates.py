"""Near-duplicates by sketches."""

import random

import numpy as np
import pytest

from presswork.llm.near_duplicates import near_duplicate_pairs, near_duplicate_report, sequences_of, similarity_sketch

SCHEMA = "article_id bigint, kind int, text string, size int, rep string"


def sets(rows, words):
    out = {}
    for i, kind, text, *_ in rows:
        w = text.lower().split() if text else []
        if w:
            out[i] = (kind, frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) or frozenset([tuple(w)]))
    return out


def brute(rows, words, least):
    s = sets(rows, words)
    return sorted((a, b) for a in s for b in s if a < b and s[a][0] == s[b][0] and len(s[a][1] & s[b][1]) / len(s[a][1] | s[b][1]) >= least)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 30, 120, 200]))] for _ in range(25)]
    out = []
    for i in range(1, 260):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(text) // 14))):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            text = base[0]
        out.append((i, rng.choice([0, 0, 0, 1]), " ".join(text), 1, "x"))
    return out + [(900, 0, None, 1, "x"), (901, 0, "", 1, "x"), (902, 0, "!!", 1, "x"), (903, 0, "!!", 1, "x")]


def test_pairs_against_brute_force(spark, rows):
    got = near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), least=0.7, words=3, hot_rows=20, block=4)
    found, wanted = sorted(map(tuple, got.collect())), brute(rows, 3, 0.7)
    assert len(set(found)) == len(found)
    assert set(found) <= set(wanted)
    assert len(found) >= 0.995 * len(wanted)


def test_report_has_one_row_per_text(spark, rows):
    got = {r["article_id"]: r for r in near_duplicate_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = [r for r in rows if r[2] is not None]
    assert set(got) == {r[0] for r in texts}
    first = {}
    for i, kind, text, *_ in texts:
        assert got[i]["class_id"] == first.setdefault((kind, text), i)
    classes = [r for r in texts if got[r[0]]["class_id"] == r[0]]
    links = brute(classes, 5, 0.8)
    for i in (r[0] for r in classes):
        assert got[i]["links"] == sum(i in pair for pair in links)


def test_empty(spark):
    assert near_duplicate_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_duplicate_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_fills_every_bin_and_estimates_likeness():
    rng = np.random.default_rng(2)
    estimates = []
    for trial in range(60):
        shared, own = 70, 15
        numbers = rng.integers(0, 1 << 62, shared + 2 * own).astype(np.uint64)
        a, b = np.sort(numbers[: shared + own]), np.sort(np.concatenate([numbers[:shared], numbers[shared + own :]]))
        sketch = similarity_sketch(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 256)
        assert (sketch != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        estimates.append((sketch[0] == sketch[1]).mean())
    assert abs(np.mean(estimates) - 0.7) < 0.01 and np.std(estimates) < 0.04
    one = similarity_sketch(np.array([5], np.uint64), np.array([0]), 2, 64)
    assert (one[0] != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (one[1] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_sequences_are_distinct_and_sorted_by_text():
    tokens = np.array([1, 2, 1, 2, 1, 7, 8], np.uint64)
    code, text = sequences_of(tokens, np.array([5, 2, 0]), 2)
    assert text.tolist() == [0, 0, 1]
    code, text = sequences_of(tokens, np.array([5, 2, 0]), 3)
    assert text.tolist() == [0, 0, 1] and len(set(code.tolist())) == 3
