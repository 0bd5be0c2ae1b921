"""Spellings of names."""

import random

import numpy as np
import pytest

from presswork.llm.names import NameForms, cells_of_forms, choose_pivots, distances, levenshtein, link_spellings, pivots_for, spelled_names, typing_errors

FIRMS = [
    ("Surgevolt Power Transmission Limited", ["Surgevolt", "SurgPower"]),
    ("Kalpadrum Construction & Engineering Company Limited", ["KCE", "Shared EPC"]),
    ("Voltara Rail Systems Corporation", ["VRS", "Shared EPC"]),
    ("Lakshyabh Power Transmission Limited", []),
    ("Lakshyabh Cables Industries Limited", ["Lakshyabh Cables"]),
    ("Girivant Renewable Energy Private Limited", []),
]
S, K, V, L, C, G = (f for f, _ in FIRMS)


@pytest.mark.parametrize(
    ("typed", "meant"),
    [
        ("surgevolt power transmission limited", [S]),
        ("Sugrevolt Powre Transmission", [S]),
        ("Sur gevolt Power Transmission Lmiited.", [S]),
        ("Power Transmission, Surgevolt", [S]),
        ("Ltd Power Transmission Surgevolt", [S]),
        ("M/s Surgevolt Pwr Transm. Ltd", [S]),
        ("Surgevolt Group", [S]),
        ("S.P.T.", [S]),
        ("SPTL", [S]),
        ("Kalpadrum Constr. and Engg. Co. Ltd.", [K]),
        ("Shared EPC", [K, V]),
        ("Voltara Rail Sys", [V]),
        ("Pvt Ltd Renewable Energy Girivant", [G]),
        ("Lakshyabh-Paper", []),
        ("Lakshyabh Paper Mills", []),
        ("Lakshyabh", []),
        ("Oldacre Power Transmission Limited", []),
        ("Limited", []),
        ("-", []),
    ],
)
def test_link(spark, typed, meant):
    found = link_spellings(spark, spark.createDataFrame([(typed, 1)], "spelling string, n bigint"), FIRMS).collect()
    assert [r["competitors"] for r in found] == ([sorted(meant)] if meant else [])


def test_no_pair_within_the_radius_is_lost_between_cells():
    rng = random.Random(9)
    names = NameForms(FIRMS)
    pivots, forms = choose_pivots(sorted(names.forms), 6), sorted(names.forms)
    form, cell, _ = cells_of_forms(forms, np.array([names.radius[f] for f in forms]), pivots)
    cells = {(c, forms[f]) for f, c in zip(form.tolist(), cell.tolist())}
    for form, radius in names.radius.items():
        for _ in range(20):
            typed = list(form)
            for _ in range(rng.randint(0, radius)):
                at = rng.randrange(len(typed))
                typed[at : at + 1] = rng.choice([[], [rng.choice("abcxyz")], [typed[at], "q"]]) if len(typed) > 1 else typed[at : at + 1]
            typed = "".join(typed)
            if levenshtein(typed, form) <= radius:
                home = min(range(len(pivots)), key=lambda i: (levenshtein(typed, pivots[i]), i))
                assert (home, form) in cells


def test_no_edited_name_of_a_large_dictionary_is_lost(spark):
    rng = random.Random(12)
    syllables = [a + b for a in "bdfgklmnprstv" for b in ("a", "e", "io", "u")]
    made = lambda n: "".join(rng.choice(syllables) for _ in range(n)).capitalize()
    firms = [(f"{made(4)} {made(3)} {made(3)} Limited", []) for _ in range(3000)]
    typed = []
    for name, _ in rng.sample(firms, 300):
        at = rng.randrange(1, len(name) - 9)
        typed.append((name[:at] + rng.choice(["", "x", name[at] * 2]) + name[at + 1 :], 1))
    found = {r["spelling"]: r["competitors"] for r in link_spellings(spark, spark.createDataFrame(typed, "spelling string, n bigint"), firms).collect()}
    names = NameForms(firms)
    assert pivots_for(len(names.forms)) > 24
    official = {form: owners for form, owners in names.forms.items()}
    for spelling, _ in typed:
        form = names.squeeze(spelling)
        near = {o for f in official if abs(len(f) - len(form)) <= 1 and levenshtein(f, form) <= 1 for o in official[f]}
        assert near and near <= set(found.get(spelling, ())), spelling


def test_distances():
    texts = ["power", "", "poewr", "p", "powers and more"]
    assert distances(texts, "power").tolist() == [levenshtein(t, "power") for t in texts]
    assert distances([], "x").tolist() == [] and distances(["ab"], "").tolist() == [2]
    assert levenshtein("power", "poewr") == 2 and typing_errors("power", "poewr") == 1
    assert levenshtein("", "abc") == typing_errors("abc", "") == 3
    assert typing_errors("paper", "power") == 2


def test_rows_hot_nulls_repeats_and_exact_names(spark):
    rows = [("raw", i, "surgevolt POWER transmission") for i in range(200)]
    rows += [("raw", 500, S), ("raw", 501, f" {S} "), ("raw", 502, None), ("raw", 503, ""), ("raw", 504, "SurgPower"), ("raw", 504, "SPT"), ("raw", 504, S)]
    named = spark.createDataFrame([(*r, "x") for r in rows], "table_name string, row_id bigint, spelling string, competitor string")
    got = sorted(map(tuple, spelled_names(spark, named, FIRMS, hot_rows=20).collect()))
    assert got == sorted([("raw", i, S) for i in range(200)] + [("raw", 504, S)])
    assert spelled_names(spark, named.limit(0), FIRMS).count() == 0
    assert spelled_names(spark, named, []).count() == 0
