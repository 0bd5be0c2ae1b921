"""Repeats of accepted history."""

import datetime
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presswork.llm.history import HistoryIndex, canonical_link, class_lengths, in_order, long_matches, match_length, repeats_of_history

SCHEMA = "article_id bigint, batch_id int, link string, news_title string, published_date timestamp, tokens int, text_id string"
DAY = datetime.datetime(2025, 3, 1)


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("https://a.example/story?id=3", "http://WWW.A.example/story/?id=3&utm_source=x#top", True),
        ("https://a.example/p-1", "https://m.a.example/p-1/amp", True),
        ("https://amp.a.example/p-1/?ref=home&fbclid=1", "https://a.example/p-1", True),
        ("https://a.example/story?id=3", "https://a.example/story?id=4", False),
        ("https://a.example/P-1", "https://a.example/p-1", False),
        ("https://a.example/x?b=1&a=2", "https://a.example/x?a=2&b=1", True),
    ],
)
def test_canonical_link(spark, a, b, same):
    x, y = (r[0] for r in spark.createDataFrame([(a,), (b,)], "l string").select(canonical_link(F.col("l"))).collect())
    assert (x == y) is same


def test_canonical_link_of_nothing(spark):
    rows = spark.createDataFrame([(None,), ("",), ("  ",), ("/path",)], "l string").select(canonical_link(F.col("l"))).collect()
    assert [r[0] for r in rows] == [None] * 4


def test_match_length_is_guaranteed():
    rng = random.Random(3)
    for _ in range(4000):
        n = rng.randint(1, 30)
        words = rng.sample(range(1000), n)
        other = set(words)
        for _ in range(rng.randint(0, 5)):
            other.symmetric_difference_update({rng.choice(words) if rng.random() < 0.5 else rng.randrange(1000)})
        if not other or len(other & set(words)) < 0.85 * len(other | set(words)):
            continue
        a, b = sorted(words), sorted(other)
        length = match_length(n)
        runs = {tuple(b[i : i + length]) for i in range(len(b))}
        assert any(tuple(a[i : i + length]) in runs for i in range(len(a) - length + 1))


def test_class_lengths_hold_for_texts_so_alike():
    lengths, step = class_lengths(), math.log(1 / 0.85)
    for n in range(1, 119):
        assert lengths[int(math.log(n) / step + 1e-9)] <= match_length(n)


def test_long_matches_find_all_runs():
    rng = np.random.default_rng(1)
    held = {"run": rng.integers(0, 40, 300), "text_id": rng.integers(0, 90, 300), "sign": np.zeros(300, np.int64), "size": np.full(300, 9)}
    asked = {"run": rng.integers(0, 50, 80), "text_id": rng.integers(100, 140, 80), "sign": np.zeros(80, np.int64), "size": np.full(80, 9)}
    got = [r for b in long_matches(in_order(pa.table(asked)), pa.table(held)) for r in b.to_pylist()]
    wanted = Counter((q, h) for r, q in zip(asked["run"], asked["text_id"]) for k, h in zip(held["run"], held["text_id"]) if r == k)
    assert {(r["query_id"], r["text_id"]): r["runs"] for r in got} == wanted and len(got) == len(wanted)
    far = {**asked, "sign": np.full(80, -1, np.int64)}
    assert sum(b.num_rows for b in long_matches(in_order(pa.table(far)), pa.table(held))) == 0


def brute(rows):
    out = {}
    words = [frozenset(re.findall(r"[^\W_]+", r[3].lower())) if r[3] else frozenset() for r in rows]
    page = [re.sub(r"^https?://(www\.)?", "", r[2]).rstrip("/") if r[2] else None for r in rows]
    for i, b in enumerate(rows):
        for k, a in enumerate(rows):
            if a[1] is None or b[1] is None or not a[1] < b[1]:
                continue
            near = a[4] and b[4] and abs(a[4] - b[4]) <= datetime.timedelta(hours=72) and words[i] and words[k]
            alike = near and len(words[i] & words[k]) / len(words[i] | words[k]) >= 0.85
            if alike or page[i] and page[i] == page[k]:
                out[b[0]] = min(out.get(b[0], a[0]), a[0])
    return sorted((v, k) for k, v in out.items())


@pytest.mark.parametrize(("shards", "few"), [(None, 1_000_000), (5, 0)])
def test_repeats_against_brute_force(spark, shards, few, monkeypatch):
    monkeypatch.setattr("presswork.llm.history.ALL_KEPT", 100 if shards is None else 3)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    stories = [rng.sample(vocabulary, rng.randint(1, 18)) for _ in range(25)]
    rows = []
    for i in range(1, 500):
        story = list(rng.choice(stories))
        if rng.random() < 0.4:
            story[rng.randrange(len(story))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            rng.shuffle(story)
        title = None if rng.random() < 0.03 else "" if rng.random() < 0.02 else "hot title of all" if rng.random() < 0.3 else " ".join(story)
        link = None if rng.random() < 0.1 else f"https://{rng.choice(['', 'www.'])}a.example/{rng.randrange(400)}{rng.choice(['', '/'])}"
        date = None if rng.random() < 0.05 else DAY + datetime.timedelta(hours=rng.randrange(600))
        rows.append((i, 1 + i * 7 // 500, link, title, date, 1, "x"))
    got = repeats_of_history(spark.createDataFrame(rows, SCHEMA), shards=shards, hot_rows=40, few=few)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_empty_and_long(spark):
    assert repeats_of_history(spark.createDataFrame([], SCHEMA)).count() == 0
    long = " ".join(f"word{i}" for i in range(5000))
    rows = [(1, 1, None, long, DAY, 0, ""), (2, 2, None, long + " more", DAY, 0, ""), (3, None, None, long, DAY, 0, "")]
    assert [tuple(r) for r in repeats_of_history(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 2)]


#: Different pages of one value of Spark's hash.
SAME_HASH = ("a.example/story-102100", "a.example/story-562426")


def test_pages_of_one_hash_are_no_repeats(spark):
    pages = spark.createDataFrame([(p,) for p in SAME_HASH], "page string")
    assert len({r[0] for r in pages.select(F.hash("page")).collect()}) == 1
    one, other = (f"https://{p}" for p in SAME_HASH)
    rows = [(1, 1, one, None, DAY, 0, ""), (2, 2, other, None, DAY, 0, ""), (3, 3, other + "/", None, DAY, 0, "")]
    assert [tuple(r) for r in repeats_of_history(spark.createDataFrame(rows, SCHEMA)).collect()] == [(2, 3)]


def test_the_text_of_a_link_decides(spark, monkeypatch):
    monkeypatch.setattr("presswork.llm.history.link_tokens", lambda page: F.array(*map(F.lit, (1, 2, 3))))
    rows = [(i, i, f"https://a.example/{i % 4}", None, DAY, 0, "") for i in range(1, 12)]
    got = repeats_of_history(spark.createDataFrame(rows, SCHEMA), hot_rows=2)
    assert sorted(map(tuple, got.collect())) == sorted((i - 4 if i < 9 else i - 8, i) for i in range(5, 12))


def made_history(n, batches):
    rng = random.Random(2)
    stories = [[f"w{rng.randrange(80)}" for _ in range(rng.randint(3, 14))] for _ in range(15)]
    rows = []
    for i in range(1, n + 1):
        story = list(rng.choice(stories))
        if rng.random() < 0.5:
            story[rng.randrange(len(story))] = f"w{rng.randrange(80)}"
        link = f"https://a.example/{rng.randrange(n)}"
        rows.append((i, 1 + i * batches // (n + 1), link, " ".join(story), DAY + datetime.timedelta(hours=rng.randrange(300)), 1, "x"))
    return rows


def test_the_index_is_kept_and_articles_are_not_read_again(spark, tmp_path):
    rows = made_history(200, 6)
    path, found = str(tmp_path / "index"), []
    for b in range(1, 7):
        # the articles of earlier batches are gone: only the stored index is left
        batch = spark.createDataFrame([r for r in rows if r[1] == b], SCHEMA)
        found += HistoryIndex(spark, path, shards=3).accept(batch).collect()
    assert sorted(map(tuple, found)) == brute(rows)
    index = HistoryIndex(spark, path)
    assert [tuple(map(int, s.split("-")[:3])) for s in index.segments] == [(1, 4, 2), (5, 6, 1)]
    assert "news_title" not in index._read(index.segments).columns


def test_a_merge_that_was_cut_off_changes_nothing(spark, tmp_path):
    rows = made_history(120, 3)
    path = str(tmp_path / "index")
    index = HistoryIndex(spark, path)
    for b in (1, 2):
        index.accept(spark.createDataFrame([r for r in rows if r[1] == b], SCHEMA))
    half = tmp_path / "index" / "000001-000004-2-9"
    half.mkdir()  # no mark that it is whole
    got = HistoryIndex(spark, path).accept(spark.createDataFrame([r for r in rows if r[1] == 3], SCHEMA))
    assert sorted(map(tuple, got.collect())) == [r for r in brute(rows) if r[1] in {x[0] for x in rows if x[1] == 3}]


def test_a_batch_without_texts(spark):
    story = [(1, 1, None, "one title of a story", DAY, 0, "")]
    rows = [*story, (2, 2, None, None, None, 0, ""), (3, 3, None, "one title of a story", DAY, 0, "")]
    assert [tuple(r) for r in repeats_of_history(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 3)]


def test_segments_that_merge_are_written_once(spark, tmp_path, monkeypatch):
    write, written = HistoryIndex._write, []
    monkeypatch.setattr(HistoryIndex, "_write", lambda self, name, rows: (written.append(name), write(self, name, rows)))
    rows, found = made_history(200, 8), []
    index = HistoryIndex(spark, str(tmp_path / "index"))
    for b in range(1, 9):
        found += index.accept(spark.createDataFrame([r for r in rows if r[1] == b], SCHEMA)).collect()
    spans = [tuple(map(int, n.split("-")[:3])) for n in written]
    assert spans == [(1, 1, 0), (1, 2, 1), (3, 3, 0), (1, 4, 2), (5, 5, 0), (5, 6, 1), (7, 7, 0), (1, 8, 3)]
    assert [p.name for p in (tmp_path / "index").iterdir()] == [written[-1]]
    assert sorted(map(tuple, found)) == brute(rows)
