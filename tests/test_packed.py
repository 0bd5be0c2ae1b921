"""Packed fields and amounts."""

import random

import numpy as np
import pytest

from presswork.functions.amounts import spelled_number, stated_amounts
from presswork.functions.trees import TreeEnsemble
from presswork.operators.packed import dictionary_automaton, known_values, segment, split_packed
from presswork.operators.units import UnitModel, common_units, filled_unit, fit_units, read_rates, wrong_values


@pytest.mark.parametrize(
    ("packed", "wanted"),
    [
        (None, []),
        ("", []),
        ("  ", []),
        ("one", ["one"]),
        (" a , b ,, c;", ["a", "b", "c"]),
        ('"a, b", c', ["a, b", "c"]),
        ('["x", "y; z"]', ["x", "y; z"]),
        ("“p | q” • r", ["p | q", "r"]),
        ("M/s Acme / Beta", ["M/s Acme", "Beta"]),
        ("General /", ["General"]),
        ("a\tb\nc、d", ["a", "b", "c", "d"]),
        ('"open, x', ['"open', "x"]),
        ('5" pipe, b', ['5" pipe', "b"]),
        ("Infra (P) Ltd, b", ["Infra (P) Ltd", "b"]),
        ("highway; elevated, b", ["highway; elevated", "b"]),
        ("highway; elevated road", ["highway", "elevated road"]),
        ('""', []),
        (", ; ,", []),
    ],
)
def test_segment(packed, wanted):
    assert segment(packed, dictionary_automaton(("highway; elevated", "plain"))) == wanted


def test_known_values_hold_beside_characters_that_grow_in_lower_case():
    known = dictionary_automaton(("Alpha, Beta Works", "Öl, Gas İşleri"))
    assert segment("Alpha, Beta Works; İstanbul", known) == ["Alpha, Beta Works", "İstanbul"]
    assert segment("İ; Öl, Gas İşleri, b", known) == ["İ", "Öl, Gas İşleri", "b"]


def test_joined_values_come_back():
    rng = random.Random(1)
    for _ in range(300):
        values = ["".join(rng.choice("abc &.-") for _ in range(rng.randint(1, 8))).strip() or "x" for _ in range(rng.randint(1, 6))]
        values = [v if rng.random() < 0.7 else f"{v}, {v}" for v in values]
        separator = rng.choice([", ", ";", " | ", "\t", " • ", " / "])
        quoted = [f'"{v}"' if "," in v or rng.random() < 0.3 else v for v in values]
        assert segment(separator.join(quoted)) == values


def test_a_dictionary_of_any_size_gives_the_same(spark, tiny):
    from presswork.plans.packed_queries import known, packed_fields

    values = ["Alpha, Beta Works", " Gamma; Delta ", "plain", None, "a / b", "Alpha, Beta Works"]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    small, large = known_values(frame), known_values(frame, 2)
    assert small == ("Alpha, Beta Works", "Gamma; Delta", "a / b") and not isinstance(large, tuple)
    packed = ['x, alpha, beta works; y', "Gamma; Delta", '["a / b", Gamma; delta]', "İ; Alpha, Beta Works", "alpha; beta works", None, "", "GAMMA; DELTA, a / B"]
    fields = spark.createDataFrame([("f", i, p) for i, p in enumerate(packed)], "field_name string, row_id int, packed string")
    assert sorted(map(tuple, split_packed(fields, small).collect())) == sorted(map(tuple, split_packed(fields, large).collect()))
    stated = known(spark, tiny)
    joined = split_packed(packed_fields(spark, tiny), spark.createDataFrame([(v,) for v in stated] or [("",)], "value string"))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, split_packed(packed_fields(spark, tiny), stated).collect()))


def test_split_packed_keeps_positions_and_ignores_other_columns(spark):
    df = spark.createDataFrame([("f", 1, "a, b", "item"), ("f", 2, "a", "x"), ("g", 3, None, None)], "field_name string, row_id int, packed string, item string")
    assert sorted(map(tuple, split_packed(df, least=2).collect())) == [("f", 1, 1, "a"), ("f", 1, 2, "b")]
    assert split_packed(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("title", "wanted"),
    [
        ("worth ₹ five hundred cr", (5e9, "INR")),
        ("Rs 0.5 lakh crore order", (5e11, "INR")),
        ("at Rs. 5,02,800 lakhs", (5.028e10, "INR")),
        ("eight hundred crore rupees", (8e9, "INR")),
        ("US$168M plan", (1.68e8, "USD")),
        ("JPY 42bn", (4.2e10, "JPY")),
        ("Dh 311.2M tender", (3.112e8, "AED")),
        ("Rs 15,24,00,09,217", (15240009217.0, "INR")),
        ("SR 539 mn", (5.39e8, "SAR")),
        ("stock at ₹140 per share", None),
        ("slips to ₹2642 a share on €5m news", (5e6, "EUR")),
        ("₹4.95 per unit", None),
        ("30 MW at 14 km", None),
        (None, None),
        ("", None),
    ],
)
def test_stated_amounts(title, wanted):
    got = stated_amounts(title)
    assert (got[0].value, got[0].currency) == (pytest.approx(wanted[0]), wanted[1]) if wanted else got == []


def test_spelled_number():
    assert [spelled_number(w) for w in ("nine hundred", "twenty five", "two thousand and six", "cr")] == [900, 25, 2006, None]


RATES = {"INR": 1.0, "USD": 85.0, "EUR": 92.0}


def test_filled_unit():
    assert filled_unit(66, 66e7, "INR", RATES) == "crore"
    assert filled_unit(6600, 66e7, "INR", RATES) == "lakh"
    assert filled_unit(26.35, 224e7, "INR", RATES) == "usd_million"
    assert filled_unit(5, 5e6 * 92, "EUR", RATES) == "own_million"
    assert filled_unit(1, 7e9, "INR", RATES) == "other"


def test_ensemble_learns_and_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)).astype(int)
    y[rng.random(3000) < 0.1] = 0
    model = TreeEnsemble().fit(x[:1000], y[:1000], 3).calibrate(x[1000:2000], y[1000:2000])
    kind, sure = model.predict(x[2000:])
    right = kind == y[2000:]
    assert right.mean() > 0.82
    for low, high in ((0.5, 0.85), (0.85, 1.01)):
        part = (sure >= low) & (sure < high)
        if part.sum() > 100:
            assert abs(right[part].mean() - sure[part].mean()) < 0.08


def test_units_edges(spark, tiny):
    from presswork.session import table

    articles = table(spark, tiny, "processed_articles")
    nothing = UnitModel(RATES, None)
    assert common_units(articles.limit(0), nothing).count() == 0
    rows = {
        "published": [("x", 1.0), ("worth Rs 100 crore", None), ("worth Rs 100 crore", 100.5), ("worth Rs 100 crore", 10000.0), ("worth Rs 100 crore", float("nan")), (None, None)]
    }["published"]
    df = spark.createDataFrame(
        [(i, t, v, None, None, None, None, None, None, None, "extra") for i, (t, v) in enumerate(rows)],
        "article_id bigint, news_title string, contract_value_inr_crore double, source string, category_tag string, sbu_tagging string, geography string, competitor_tier int, relevance_score int, summary string, route string",
    )
    got = common_units(df, nothing)
    assert sorted(map(tuple, wrong_values(got).collect())) == [(1, 10000), (3, 10000), (4, 10000)]
    assert {r["article_id"]: r["route"] for r in got.collect()} == {0: "review", 1: "stated", 2: "stated", 3: "stated", 4: "stated"}


def test_unit_model_on_held_out_rows(spark):
    from presswork.session import table

    articles = table(spark, "/root/testdata/sf0.1", "processed_articles")
    model = fit_units(articles.filter("article_id % 2 = 0"), read_rates(table(spark, "/root/testdata/sf0.1", "currency_rates")))
    from presswork.operators.units import CLASSES, FEATURES, labelled

    rows = [r.asDict() for r in articles.filter("article_id % 2 = 1").select("article_id", "news_title", *FEATURES).collect()]
    x, y = labelled(rows, model.rates)
    kind, sure = model.ensemble.predict(x)
    right, usual, confident = kind == y, (y == CLASSES.index("crore")).mean(), sure >= 0.8
    # what a model that always says the usual unit can't reach
    assert right.mean() >= 0.85 and right.mean() >= usual + 0.2
    assert right[confident].mean() >= 0.93 and confident.mean() >= 0.6
    assert abs(sure.mean() - right.mean()) < 0.08
    often = [c for c in range(len(CLASSES)) if (y == c).sum() >= 100]
    assert len(often) >= 3 and all(right[y == c].mean() >= 0.5 for c in often)
