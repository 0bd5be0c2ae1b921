"""The forms of the pipeline's steps that keep it fast on large queues, against the plain ones."""

import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from presswork.plans import pipeline
from presswork.session import table


def test_enrich_queue_forms_no_pairs(spark, tiny, monkeypatch):
    def never(*_):
        raise AssertionError("titles or events were compared")

    for step in ("title_dedup", "event_dedup", "with_position"):
        monkeypatch.setattr(pipeline, step, never)
    rows = entry_module.queries()["enrich_queue"](spark, tiny)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == table(spark, tiny, "raw_scraped_articles").count()


def test_names_and_tiers_in_place_equal_the_joined_form(spark, tiny):
    from presswork.operators.dictionary import alias_table, normalize_tags, resolve_names, with_names_and_tiers
    from presswork.operators.rank import RULES, best_known, best_tier

    firms = table(spark, tiny, "competitors")
    fields = [r[0] for r in table(spark, tiny, "processed_articles", "competitor_tagging").collect()] + [None, "", " - ", "None", "a,,b", "a, a , b\x1c", ","]
    rows = spark.createDataFrame(list(enumerate(fields)), "id bigint, tags string")
    aliases = alias_table(firms)
    named = normalize_tags(rows, "id", "tags", lambda names: resolve_names(names, aliases)).withColumnRenamed("normalized", "competitor_tagging")
    wanted = named.join(best_tier(named, "id", "competitor_tagging", firms), "id").select("id", "competitor_tagging", F.col("competitor_tier").cast("bigint"))
    tiers = {r["name"]: r["tier"] for r in best_known(firms).collect() if r["tier"] is not None}
    got = with_names_and_tiers(rows, "tags", aliases, tiers, RULES.last_tier).select("id", "competitor_tagging", "competitor_tier")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_titles_are_bounded_and_paired_without_a_join(spark):
    import random
    from difflib import SequenceMatcher

    import numpy as np

    from presswork.operators import alike
    from presswork.operators.dedup import title_matches

    rng = random.Random(5)
    titles = ["".join(rng.choice("ab c1é中") for _ in range(rng.choice([0, 3, 40, 63, 64, 65, 130, 210, 300]))) for _ in range(60)]
    titles += [t[:20] + "x" + t[25:] for t in titles]
    kinds, lengths = alike.character_kinds(titles)
    i, j = np.triu_indices(len(titles), 1)
    matched = [2.0 * sum(m.size for m in SequenceMatcher(None, titles[a], titles[b]).get_matching_blocks()) / 2 for a, b in zip(i.tolist(), j.tolist())]
    common = alike.common_at_most(kinds, lengths, i, j)
    assert (common >= matched).all() and (common <= np.minimum(lengths[i], lengths[j])).all()
    for k, most in alike.shared_characters(kinds, lengths):
        assert (most[: len(titles) - k] >= [m for m, a, b in zip(matched, i, j) if b - a == k]).all()
    rows = spark.createDataFrame([(1, "a", "b", datetime.datetime(2025, 1, 1))], "pos bigint, news_title string, names string, published_date timestamp")
    assert "Join" not in title_matches(rows)._jdf.queryExecution().executedPlan().toString()


def test_events_of_many_rows_equal_single_decisions(spark):
    import random

    import numpy as np

    from presswork.operators.dedup import event_matches
    from presswork.operators.events import RULES, Records, same_event

    rng = random.Random(7)
    words = [None, "", "Acme Power", "acme power ", "Acme", "Beta", "100", "108", "0", "1e400", "north line of 40 km", "north line of 41 km"]
    fields = ["company", "contract_value_crore", "client_or_authority", "scope", "location", "period", "revenue_crore", "trigger_event", "sector", "companies_involved"]
    facts = [{f: rng.choice(words) for f in rng.sample(fields, rng.randint(0, 6))} for _ in range(60)]
    records, (i, j) = Records(facts), np.triu_indices(len(facts), 1)
    for category in (*RULES, "other"):
        assert records.same_events(category, i, j).tolist() == [same_event(facts[a], facts[b], category) for a, b in zip(i.tolist(), j.tolist())]
    # dates missing or not, several tags, hours around the limit of days
    start = datetime.datetime(2025, 1, 20)
    rows = []
    for pos in range(1, 81):
        date = None if rng.random() < 0.2 else start - datetime.timedelta(hours=5 * pos)
        rows.append((pos, rng.sample(["A", "B", "C"], rng.randint(0, 2)), rng.choice(["Stock Market", "x", None]), date, 1.0, {"company": rng.choice(["Acme", "Beta"])}))
    frame = spark.createDataFrame(rows, "pos bigint, tags array<string>, category_tag string, published_date timestamp, score double, facts map<string,string>")
    first = {}
    for pos, tags, *_ in rows:
        for t in tags or ["General"]:
            first.setdefault(t, pos)
    day, wanted = datetime.timedelta(days=1), set()
    for k, a in enumerate(rows):
        for b in rows[k + 1 :]:
            both = set(a[1] or ["General"]) & set(b[1] or ["General"])
            near = a[3] is None or b[3] is None or abs((a[3] - b[3]) // day) <= 3
            if both and near and (a[2] or "").lower() == (b[2] or "").lower() and same_event(a[5], b[5], a[2]):
                wanted.add((a[0], b[0], min(first[t] for t in both)))
    plan = event_matches(frame)
    assert sorted(tuple(r)[:3] for r in plan.select("pos_i", "pos_j", "group_rank").collect()) == sorted(wanted)
    assert plan._jdf.queryExecution().analyzed().toString().count("Join") == 1


def test_common_length_bounds_the_likeness():
    import random
    from difflib import SequenceMatcher

    from presswork.operators.events import above, common_length

    rng = random.Random(9)
    assert common_length("abcbdab", "bdcaba") == 4 and common_length("", "a") == 0
    for _ in range(400):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 90))) for _ in range(2))
        b = b if rng.random() < 0.5 else a[: len(a) // 2] + b[:9] + a[len(a) // 2 :]
        for least in (0.7, 0.75, 0.8):
            assert above(a, b, least) == (SequenceMatcher(None, a, b).ratio() > least)
