"""Registered queries that SQL can't express, against plain scans of the same rows."""

import json
from collections import Counter
from difflib import SequenceMatcher

import duckdb
import pytest

import __spark_entry__ as entry_module
from presswork.functions.amounts import stated_amounts
from presswork.operators.events import RULES, same_event
from presswork.operators.packed import dictionary_automaton, segment
from presswork.plans.services import OfflineModel

DAY = 86_400_000_000
WITHOUT = {
    "dedup_phase1", "seq_ratio_pairs", "title_pairs", "event_pairs", "event_survivors", "dedup_phase2", "enrich_queue", "company_match",
    "p5_found", "p5_units", "p7_found", "p7_values",
}


@pytest.fixture(scope="module")
def run(spark, tiny):
    return lambda name: [tuple(r) for r in entry_module.queries()[name](spark, tiny).collect()]


@pytest.fixture(scope="module")
def read(tiny):
    return lambda sql: duckdb.sql(sql.replace("{}", tiny)).fetchall()


def test_every_query_without_sql_is_tested_here():
    from presswork.plans import catalog

    left = set(catalog.queries()) - set(catalog.oracle_sql())
    assert left == WITHOUT | {f"fingerprint_match_{(c or 'other').replace(' & ', '_').replace(' ', '_')}" for c in (*RULES, None)}


def apart(a, b):
    return None if a is None or b is None else abs((a - b) // DAY)


@pytest.fixture(scope="module")
def queue(read):
    rows = read("""SELECT row_number() OVER (ORDER BY published_date DESC NULLS FIRST, id) AS pos, lower(coalesce(news_title, 'none')), epoch_us(published_date), news_title
     FROM '{}/raw_scraped_articles.parquet' ORDER BY pos""")
    return rows


@pytest.fixture(scope="module")
def alike(queue):
    found = set()
    for k, (i, a, t, _) in enumerate(queue):
        for j, b, u, _ in queue[k + 1 : k + 100]:
            days = apart(t, u)
            if (days is None or days <= 3) and SequenceMatcher(None, a, b).ratio() > 0.85:
                found.add((i, j))
    return found


def test_seq_ratio_pairs(run, alike):
    got = run("seq_ratio_pairs")
    assert len(got) == len(set(got)) and set(got) == alike


def test_title_pairs_and_their_greedy_scan(spark, tiny, run, queue, alike):
    from presswork.operators.dedup import title_matches
    from presswork.plans.dedup_queries import _named

    rules = {tuple(r) for r in title_matches(_named(spark, tiny), ratio=None).collect()}
    pairs = run("title_pairs")
    assert len(pairs) == len(set(pairs)) and set(pairs) == alike | rules
    first = {}
    for pos, low, _, title in queue:
        first.setdefault("none" if title is None else title.strip().lower(), pos)
    kept = []
    for pos in sorted(first.values()):
        if not any((k, pos) in alike or (k, pos) in rules for k in kept):
            kept.append(pos)
    assert sorted(r[0] for r in run("dedup_phase1")) == kept


EVENTS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def told(spark):
    return lambda name: [tuple(r) for r in entry_module.queries()[name](spark, EVENTS).collect()]


@pytest.fixture(scope="module")
def articles():
    rows = duckdb.sql("""SELECT row_number() OVER (ORDER BY published_date DESC NULLS FIRST, article_id) AS pos, coalesce(news_title, ''), coalesce(scraped_content, ''),
     coalesce(category_tag, ''), coalesce(competitor_tagging, ''), epoch_us(published_date), coalesce(rank_score, 0) FROM '{}/processed_articles.parquet' ORDER BY pos""".replace("{}", EVENTS)).fetchall()
    out = []
    for pos, title, content, category, tags, ts, score in rows:
        facts = json.loads(OfflineModel().facts(title, content[:2000], category))
        facts = {k: None if v is None else str(v) for k, v in facts.items()}
        real = list(dict.fromkeys(t.strip() for t in tags.split(",") if t.strip() not in ("", "-"))) or ["General"]
        out.append((pos, facts, category, real, ts, score))
    return out


def match(a, b):
    days = apart(a[4], b[4])
    return a[2].lower() == b[2].lower() and (days is None or days <= 3) and same_event(a[1], b[1], a[2])


def test_event_pairs_and_their_categories(told, articles):
    first = {}
    for pos, *_, tags, _, _ in articles:
        for t in tags:
            first.setdefault(t, pos)
    wanted = set()
    for k, a in enumerate(articles):
        for b in articles[k + 1 :]:
            both = set(a[3]) & set(b[3])
            if both and match(a, b):
                wanted.add((a[0], b[0], min(first[t] for t in both)))
    assert sorted(told("event_pairs")) == sorted(wanted)
    by = [told(f"fingerprint_match_{(c or 'other').replace(' & ', '_').replace(' ', '_')}") for c in (*RULES, None)]
    assert sorted(p for found in by for p in found) == sorted(wanted) and all(by)


def test_event_survivors(told, articles):
    groups, dropped = {}, set()
    for a in articles:
        for t in a[3]:
            groups.setdefault(t, []).append(a)
    for members in groups.values():
        for k, a in enumerate(members):
            if a[0] in dropped:
                continue
            for b in members[k + 1 :]:
                if b[0] not in dropped and match(a, b):
                    dropped.add(b[0] if a[5] >= b[5] else a[0])
    assert sorted(r[0] for r in told("event_survivors")) == sorted({a[0] for a in articles} - dropped)


def test_company_match(run, read):
    def alike(a, b):
        a, b = (a or "").lower().strip(), (b or "").lower().strip()
        return bool(a and b) and (a in b or b in a or SequenceMatcher(None, a, b).ratio() > 0.8)

    rows = read("SELECT id, competitor, search_keyword FROM '{}/raw_scraped_articles.parquet'")
    assert sorted(run("company_match")) == sorted((i, alike(a, b)) for i, a, b in rows)


def test_pipeline_queries(run, read):
    scored = run("enrich_queue")
    titles = dict(read("SELECT id, coalesce(news_title, '') || chr(1) || coalesce(competitor, '') FROM '{}/raw_scraped_articles.parquet'"))
    model = OfflineModel()
    for i, score, category, *_ in scored:
        assert score == int(model.score(*titles[i].split("\1")).split()[-1]) and (category is not None) == (score >= 70)
    assert len(scored) == len(titles)
    stored = run("dedup_phase2")
    assert 0 < len(stored) <= sum(s[1] >= 70 for s in scored)


def test_packed_values(run, read, spark, tiny):
    from presswork.plans.packed_queries import known

    automaton = dictionary_automaton(known(spark, tiny))
    fields = read("""SELECT 'competitor_tagging', article_id, competitor_tagging FROM '{}/processed_articles.parquet' UNION ALL SELECT 'sbu_tagging', article_id, sbu_tagging FROM '{}/processed_articles.parquet'
     UNION ALL SELECT 'raw_sbu', id, sbu FROM '{}/raw_scraped_articles.parquet' UNION ALL SELECT 'keywords_raw', competitor_id, keywords_raw FROM '{}/competitors.parquet'""")
    found, counts = [], Counter()
    for name, row, packed in fields:
        values = segment(packed, automaton)
        counts.update((name, v) for v in values)
        found += [(name, row, k, v) for k, v in enumerate(values, 1)] if len(values) > 1 else []
    assert sorted(run("p7_found")) == sorted(found)
    assert sorted(run("p7_values")) == sorted((n, v, c) for (n, v), c in counts.items())


def test_amounts(run, read):
    rates = {c.strip().upper(): r for c, r in read("SELECT currency_code, inr_per_unit FROM '{}/currency_rates.parquet'")}
    wanted, holds = [], 0
    for i, title, value in read("SELECT article_id, news_title, contract_value_inr_crore FROM '{}/processed_articles.parquet'"):
        amounts = [a for a in stated_amounts(title) if a.currency in rates]
        usable = value is not None and value > 0
        holds += bool(amounts) or usable
        if amounts:
            crore = amounts[0].value * rates[amounts[0].currency] / 1e7
            if value is None or abs(value - crore) > 0.01 * crore:
                wanted.append((i, round(crore * 100)))
    assert sorted(run("p5_found")) == sorted(wanted)
    units = run("p5_units")
    assert len(units) == holds and {r[4] for r in units} <= {"stated", "converted", "review"}
