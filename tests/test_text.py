"""Scalar functions: the quirks that decide results."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from presswork.functions import numbers, similarity, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<double>' if isinstance(v, list) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("title", "source", "wanted"),
    [
        ("A - B - Src", "Src", "A - B"),
        ("A - B", "", "A"),
        ("A - B", None, "A"),
        ("A | Src", "Src", "A"),
        ("A- Src", "Src", "A"),
        ("A | B - C – D", "Other", "A"),
        ("  plain  ", "Src", "plain"),
        (None, "Src", None),
    ],
)
def test_clean_title(spark, title, source, wanted):
    assert one(spark, text.clean_title(F.col("t"), F.col("s")), t=title, s=source) == wanted


@pytest.mark.parametrize(
    ("reply", "wanted"),
    [("85", 85), ("Score: 90/100", 90), ("150", 100), ("-5", 5), ("85.7", 85), ("none", 0), (None, 0), ("9" * 40, 100), ("", 0)],
)
def test_parse_score(spark, reply, wanted):
    assert one(spark, text.parse_score(F.col("r")), r=reply) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("1,200", None), ("12d", None), (" 7.5 ", 7.5), ("1e3", 1000.0), ("", None), (None, None), ("nan", None), (".5", 0.5)])
def test_coerce_number(spark, value, wanted):
    assert one(spark, text.coerce_number(F.col("v")), v=value) == wanted


@pytest.mark.parametrize(
    ("title", "wanted"),
    [
        ("rs 35,54,82,968 order", [35.55]),
        ("₹850 crore", [850.0, 850.0]),
        ("rs 35.5 crore", [35.0, 35.5]),
        ("5 million", [42.5]),
        ("tenders 500", [500.0]),
        ("2 lakh crore", [0.02]),
        ("5 cranes", [5.0]),
        ("nothing", []),
        (None, []),
    ],
)
def test_extract_numbers(spark, title, wanted):
    assert one(spark, numbers.extract_numbers(F.col("t")), t=title) == wanted


def test_similar_numbers_strict_and_values_inclusive(spark):
    assert one(spark, numbers.similar_numbers(F.col("a"), F.col("b")), a=[100.0], b=[90.0]) is False
    assert one(spark, numbers.similar_numbers(F.col("a"), F.col("b")), a=[100.0, 0.0], b=[90.1]) is True
    assert one(spark, numbers.similar_numbers(F.col("a"), F.col("b")), a=[0.0], b=[0.0]) is False
    assert one(spark, numbers.values_similar(F.col("a"), F.col("b")), a=100.0, b=90.0) is True
    for a, b, wanted in ((0.0, 0.0, True), (0.0, 1.0, False), (-5.0, -50.0, True), (100.0, 89.0, False)):
        assert one(spark, numbers.values_similar(F.col("a"), F.col("b")), a=a, b=b) is wanted


def test_html_to_text(spark):
    page = "<html><head><title>T &amp; T</title><style>x</style></head><body><NAV>n</NAV><p>a<br>b</p><!-- c > d --><header>h</header><script>1<2</script></body>"
    assert one(spark, text.html_to_text(F.col("h")), h=page) == "T & T a b"
    assert one(spark, text.html_to_text(F.col("h"), 3), h=page) == "T &"
    assert one(spark, text.html_to_text(F.col("h")), h=None) == ""


def test_font_source(spark):
    assert one(spark, text.font_source(F.col("h")), h='<a>x</a>&nbsp;<font color="1"> The <b>Wire</b> </font><font>no</font>') == "The Wire"
    assert one(spark, text.font_source(F.col("h")), h=None) == ""


def test_quote_url_like_the_standard_library(spark):
    from urllib.parse import quote

    for value in ("a b", "L&T", "x/y", "50%", "ü*~-_.", '"q"', "+"):
        assert one(spark, text.quote_url(F.col("v")), v=value) == quote(value)


def test_json_object_text(spark):
    assert one(spark, text.json_object_text(F.col("r")), r='Sure: ```json\n{"a": {"b": 1}}\n``` done') == '{"a": {"b": 1}}'
    assert one(spark, text.json_object_text(F.col("r")), r="none") is None


def test_core_match(spark):
    words = similarity.title_words
    match = similarity.core_match(words(F.col("a")), words(F.col("b")))
    assert one(spark, match, a="Acme wins metro line order", b="Acme bags metro line contract") is True
    assert one(spark, match, a="the order", b="the order") is False
    assert one(spark, match, a=None, b="x") is False


def test_sequence_ratio_and_bounds(spark):
    rng = random.Random(3)
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), (None, "a")]
    pairs += [tuple("".join(rng.choice("abc 1é") for _ in range(rng.randint(0, 30))) for _ in range(2)) for _ in range(200)]
    a, b = F.col("a"), F.col("b")
    bound = similarity.letters_bound(similarity.letter_counts(a), similarity.letter_counts(b), F.length(a), F.length(b))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.sequence_ratio(a, b).alias("r"), similarity.ratio_bound(a, b).alias("l"), bound.alias("c"))
    for r in rows.collect():
        if r["a"] is None:
            assert r["r"] is None
            continue
        assert r["r"] == pytest.approx(SequenceMatcher(None, r["a"], r["b"]).ratio())
        if r["a"] or r["b"]:
            assert r["r"] <= r["l"] + 1e-9 and r["r"] <= r["c"] + 1e-9
