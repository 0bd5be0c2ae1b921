"""Titles that differ by formatting."""

import random
import re

import pytest
from pyspark.sql import functions as F

from presswork.llm.formatting import canonical_title, formatting_clusters, formatting_copies

SCHEMA = "table_name string, row_id bigint, news_title string, keep_id string, n int"


def frame(spark, titles, table="t"):
    return spark.createDataFrame([(table, i, t, "clash", 0) for i, t in enumerate(titles, 1)], SCHEMA)


def canonical(spark, *titles):
    return [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").select(canonical_title(F.col("t"))).collect()]


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Deals | Acme buys Beta - Wire", "wire: ACME BUYS BETA — deals"),
        ("worth Rs 2,40,000 lakh", "worth rs 240000 lakh!"),
        ("data-centre hall", "Data centre  hall"),
        ("« Acme wins » ", "acme wins -"),
        ("Acme wins | X", "X :: acme\twins"),
        ("Acme wins​", "Acme wins"),
    ],
)
def test_same(spark, a, b):
    x, y = canonical(spark, a, b)
    assert x == y


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("worth 12.5 MW", "worth 125 MW"),
        ("230 kV", "320 kV"),
        ("At Goa, Acme wins", "Acme wins at Goa"),
        ("₹5 crore", "$5 crore"),
        ("opens at 10:30", "opens at 30:10"),
        ("Acme wins", "Acme wins | Acme wins"),
    ],
)
def test_different(spark, a, b):
    x, y = canonical(spark, a, b)
    assert x != y


def test_null_blank_and_punctuation(spark):
    assert canonical(spark, None, "", " \t\n", "--!") == [None, None, None, ""]


def test_copies_against_brute_force(spark):
    rng = random.Random(4)
    base = ["Acme wins order", "Beta bids: metro", "Gamma 4.5 MW - Wire", "x", "", None, "!!"]
    titles = []
    for _ in range(400):
        t = rng.choice(base)
        if t:
            t = rng.choice([t, t.upper(), t + "!", " " + t, t.replace(" ", "  ")])
        titles.append(t)
    got = sorted(map(tuple, formatting_copies(frame(spark, titles), hot_rows=30).collect()))

    def key(t):
        segments = re.split(r"(?<!\S)-+(?!\S)|\||(?<!\d):+|:+(?!\d)", t.lower())
        return tuple(sorted(s for s in (re.sub(r"[^a-z0-9.]|(?<!\d)\.|\.(?!\d)", "", s) for s in segments) if s))

    first, wanted = {}, []
    for i, t in enumerate(titles, 1):
        if t and t.strip():
            keep = first.setdefault(key(t), i)
            if keep != i:
                wanted.append(("t", keep, i))
    assert got == sorted(wanted)


def test_tables_stay_apart_and_clusters_count(spark):
    both = frame(spark, ["A b", "a B!", "c"], "x").unionAll(frame(spark, ["a b", "c"], "y"))
    assert sorted(map(tuple, formatting_copies(both).collect())) == [("x", 1, 2)]
    assert sorted(map(tuple, formatting_clusters(both).collect())) == [("x", 1, 2, 2), ("x", 3, 1, 1), ("y", 1, 1, 1), ("y", 2, 1, 1)]


def test_empty_table_and_long_title(spark):
    assert formatting_copies(frame(spark, [])).count() == 0
    long = "word " * 100_000
    assert formatting_copies(frame(spark, [long, long.upper()])).count() == 1
