"""Feeds, sinks and the pipeline."""

import datetime
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from pyspark.sql import functions as F

from presswork.operators.dictionary import keyword_table
from presswork.plans import pipeline
from presswork.session import dimension, table
from presswork.sources import feeds, jdbc, sinks

FEED = """<rss><channel><item><title>Acme wins - Wire</title><link>http://a/1</link><pubDate>Wed, 01 Jan 2025 10:00:00 GMT</pubDate>
<description>&lt;a&gt;x&lt;/a&gt;&lt;font&gt;Wire&lt;/font&gt;</description></item><item><title>No date</title><link>http://a/2</link></item></channel></rss>"""


def test_feeds_fail_alone_and_are_collected(spark, tmp_path):
    (tmp_path / "good.xml").write_text(FEED)
    (tmp_path / "bad.xml").write_text("<rss><item>")
    entries = feeds.read_feeds(spark, ["good", "bad", "absent", "good"], str(tmp_path))
    rows = entries.collect()
    assert {(r["keyword"], r["success"]) for r in rows} == {("good", True), ("bad", False), ("absent", False)}
    now = F.lit(datetime.datetime(2025, 5, 5))
    got = {r["link"]: r for r in feeds.collected(entries, now).collect()}
    assert got["http://a/1"]["news_title"] == "Acme wins" and got["http://a/1"]["source"] == "Wire"
    assert got["http://a/2"]["published_date"] == datetime.datetime(2025, 5, 5)


def test_insert_ignore_and_drain(spark, tmp_path):
    path = str(tmp_path / "stored")
    day = datetime.datetime(2025, 1, 1)
    batch = spark.createDataFrame([(1, "a", day), (2, "a", day), (3, "a", None), (4, "a", None), (5, None, day)], "id int, link string, published_date timestamp")
    assert sinks.insert_ignore(spark, batch, path, "id") == sinks.Counts(4, 1)
    assert sinks.insert_ignore(spark, batch, path, "id") == sinks.Counts(3, 2)  # null keys never conflict
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3, 3, 4, 4, 5, 5]
    sinks.drain(spark, path, batch.schema)
    assert spark.read.parquet(path).count() == 0


def test_stored_columns_default_only_if_absent(spark):
    row = sinks.stored_columns(spark.createDataFrame([("t", None)], "news_title string, competitor_tagging string")).first()
    assert row["competitor_tagging"] is None and row["relevance_score"] == 0 and row["sbu_tagging"] == "" and row["geography"] is None


def test_fetch_pages_swallows_failures(spark):
    def fetch(link):
        if "bad" in link:
            raise OSError
        return "page"

    got = {r["link"]: r["html"] for r in feeds.fetch_pages(spark.createDataFrame([("x",), ("bad",), (None,), ("x",)], "link string"), fetch, 2).collect()}
    assert got == {"x": "page", "bad": ""}


def test_keyword_table_needs_quotes(spark):
    df = spark.createDataFrame([("A", '"x", "y z"'), ("B", "plain"), (None, '"q"'), ("C", None)], "owner string, keywords_raw string")
    assert sorted(tuple(r) for r in keyword_table(df, "owner").collect()) == [("x", "A"), ("y z", "A")]


def test_pipeline_runs_and_is_deterministic(spark, tiny):
    queue, firms = table(spark, tiny, "raw_scraped_articles"), table(spark, tiny, "competitors")
    first, second = (pipeline.run(spark, queue, firms) for _ in range(2))
    assert sorted(map(tuple, first.stored.collect()), key=repr) == sorted(map(tuple, second.stored.collect()), key=repr)
    assert 0 < first.stored.count() <= first.after_titles.count() <= first.analysed.count() <= first.scored.count() == queue.count()
    assert pipeline.run(spark, queue.limit(0), firms).stored.count() == 0


class Reader(pipeline.OfflineModel):
    """Says in its replies what it was given to read."""

    def analyse(self, title, content, score):
        return super().analyse(title, f"read {content[-9:]} {len(content)}", score)

    def facts(self, title, content, category):
        return json.dumps({"company": title, "location": f"{content[-9:]} {len(content)}"})


PAGED = [
    (1, "http://a/1", "<nav>menu</nav><p>A  page</p>" + "x" * 4000),
    (2, "http://a/2", "short &amp; plain"),
    (3, "http://a/3", None),
    (4, None, "y" * 4000),
]


def paged_queue(spark):
    rows = [(i, "k", f"Acme{i} wins wind order {'abcd'[i - 1] * 9}", "s", link, datetime.datetime(2025, 1, 7 * i), "u", f"Firm{i}", c) for i, link, c in PAGED]
    schema = "id bigint, search_keyword string, news_title string, source string, link string, published_date timestamp, sbu string, competitor string, content string"
    return spark.createDataFrame(rows, schema)


def test_pipeline_reads_pages(spark, tiny, monkeypatch):
    read = []
    monkeypatch.setattr(pipeline, "event_dedup", lambda known: read.extend(known.select("news_title", "facts").collect()) or known.select("pos"))
    stored = pipeline.run(spark, paged_queue(spark), table(spark, tiny, "competitors"), Reader()).stored.collect()
    by = {r["news_title"][:5]: (r["scraped_content"], r["summary"]) for r in stored}
    assert by["Acme1"] == ("A page " + "x" * 493, "read xxxxxxxxx 2000")
    assert by["Acme2"] == ("short & plain", "read t & plain 13")
    assert by["Acme3"] == ("", "read ccccccccc 31")  # the title where there is no page
    assert by["Acme4"][0] == "y" * 500
    # the whole page again; what is stored where there is no link
    assert {r["news_title"][:5]: r["facts"]["location"] for r in read} == {"Acme1": "xxxxxxxxx 2000", "Acme2": "t & plain 13", "Acme3": " 0", "Acme4": "yyyyyyyyy 500"}


def test_pipeline_fetches_pages(spark, tiny):
    def fetch(link):
        if link.endswith("2"):
            raise OSError
        return f"<p>behind {link}</p>"

    stored = pipeline.run(spark, paged_queue(spark), table(spark, tiny, "competitors"), fetch=fetch).stored.collect()
    got = {r["news_title"][:5]: r["scraped_content"] for r in stored}
    assert got == {"Acme1": "behind http://a/1", "Acme2": "", "Acme3": "behind http://a/3", "Acme4": ""}


def test_analysis_errors_become_a_record(spark):
    replies = spark.createDataFrame([(1, "no json"), (2, '{"category_tag": "x"}'), (3, None)], "id int, reply string")
    assert {r["category_tag"] for r in replies.select(pipeline.analysed_fields(F.col("reply")).alias("f")).select("f.*").collect()} == {"error"}


class Web(BaseHTTPRequestHandler):
    """Answers feeds and pages; a word in the address makes it fail or hang."""

    def do_GET(self):
        if "slow" in self.path:
            threading.Event().wait(3)
        self.send_response(500 if "error" in self.path else 200)
        self.end_headers()
        self.wfile.write((f"<p>page {self.path}</p>" if "page" in self.path else "<rss>" if "broken" in self.path else FEED).encode())

    def log_message(self, *given):
        pass


@pytest.fixture(scope="module")
def web():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Web)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_feeds_over_http(spark, web):
    entries = feeds.read_feeds(spark, ["a b", "error", "broken", "slow"], web + "/rss?q={q}", timeout=1).collect()
    by = {}
    for r in entries:
        by.setdefault(r["keyword"], []).append(r["success"])
    # the status of an answer does not count, what it says does
    assert by == {"a b": [True, True], "error": [True, True], "broken": [False], "slow": [False]}


def test_pages_over_http(spark, web):
    links = spark.createDataFrame([(f"{web}/page1",), (f"{web}/error-page",), ("nowhere:",)], "link string")
    got = {r["link"]: r["html"] for r in feeds.fetch_pages(links, feeds.http_page, 2).collect()}
    assert got == {f"{web}/page1": "<p>page /page1</p>", f"{web}/error-page": "", "nowhere:": ""}


def test_dimensions(spark, tmp_path):
    (tmp_path / "d.csv").write_text('sbu,keywords_raw\nA,"""x"", ""y"""\n')
    df = dimension(spark, str(tmp_path / "d.csv"))
    assert sorted(tuple(r) for r in keyword_table(df, "sbu").collect()) == [("x", "A"), ("y", "A")]
    for absent in ("no.csv", "no.parquet"):
        with pytest.raises(FileNotFoundError):
            dimension(spark, str(tmp_path / absent))


def test_database_tables(spark, tmp_path, monkeypatch):
    monkeypatch.delenv("DATABASE_URL", raising=False)
    with pytest.raises(ValueError, match="DATABASE_URL"):
        jdbc.Database().address  # noqa: B018
    monkeypatch.setenv("DATABASE_URL", f"derby:{tmp_path}/db;create=true")
    db = jdbc.Database(properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    day = datetime.datetime(2025, 1, 1)
    schema = "id int, link string, published_date timestamp"
    empty = spark.createDataFrame([], schema)
    empty.write.option("createTableColumnTypes", "link varchar(64)").jdbc(db.address, "queue", properties=db.properties)
    batch = spark.createDataFrame([(1, "a", day), (2, "a", day), (3, "a", None)], schema)
    assert db.insert_ignore(batch, "queue", "id") == sinks.Counts(2, 1)
    assert db.insert_ignore(batch, "queue", "id") == sinks.Counts(1, 2)
    assert sorted(r[0] for r in db.read(spark, "queue", by="id", parts=3).select("id").collect()) == [1, 3, 3]
    db.drain(spark, "queue")
    assert db.read(spark, "queue", by="id").count() == 0


def test_a_whole_run_and_its_failures(spark, tmp_path):
    now = F.lit("2025-06-01 00:00:00").cast("timestamp")
    rows = [
        ("k", 0, 0, True, "Acme wins wind order for Rs 5 crore - Wire", "http://a/1", None, "<font>Wire</font>"),
        ("k", 0, 1, True, "Acme wins wind order for Rs 5 crore - Wire", "http://a/1", None, "<font>Wire</font>"),
        ("k", 0, 2, True, "Nobody bakes bread", "http://a/2", None, None),
        ("m", 1, 0, False, None, None, None, None),
    ]
    entries = spark.createDataFrame(rows, feeds.ENTRY_SCHEMA)
    units = spark.createDataFrame([("Power", '"wind"')], "sbu string, keywords_raw string")
    firms = spark.createDataFrame([(1, "Acme Works", '"Acme"', 1)], "competitor_id int, competitor string, keywords_raw string, tier int")
    queue, stored = str(tmp_path / "queue"), str(tmp_path / "stored")

    class Failing(pipeline.OfflineModel):
        def score(self, title, competitor):
            raise OSError

    class Broken:
        """No model at all."""

    with pytest.raises(AttributeError):
        pipeline.cycle(spark, entries, units, firms, queue, stored, now, model=Broken())
    assert spark.read.parquet(queue).count() == 1  # what was collected is kept
    report = pipeline.cycle(spark, entries, units, firms, queue, stored, now, fetch=lambda link: f"<p>Page of {link}.</p>")
    assert report == pipeline.Report(1, sinks.Counts(0, 1), sinks.Counts(1, 0))
    got = spark.read.parquet(stored).first()
    assert got["competitor_tagging"] == "Acme Works" and got["scraped_content"] == "Page of http://a/1." and got["news_title"] == "Acme wins wind order for Rs 5 crore"
    assert spark.read.parquet(queue).count() == 0
    # a model that always fails scores nothing, so nothing is stored
    assert pipeline.cycle(spark, entries, units, firms, queue, stored, now, model=Failing()).stored == sinks.Counts(0, 0)


def test_hosted_model_fills_templates():
    from presswork.plans.services import HostedModel, Prompts

    asked = []
    model = HostedModel(lambda prompt: asked.append(prompt) or "{}", pipeline.REQUIRED, (("competitors", "- A"), ("categories", "1. **x**")), Prompts(score="{competitor}?{title}"))
    model.score("t", "c")
    model.analyse("t", "page", 80)
    model.facts("t", "", "Financial")
    assert asked[0] == "c?t" and "- A" in asked[1] and "geography" in asked[1] and "Not available" in asked[2] and "revenue_crore" in asked[2]


def test_facts_of_all_categories():
    titles = {
        "order wins": "Acme Power wins Rs 50 crore order from Beta Transco for 66 kV line at Goa",
        "bidding activity": "Acme emerges lowest bidder for Beta Discom metro tunnel in Goa",
        "financial": "Acme reports Rs 5 crore revenue in third quarter",
        "mergers & acquisitions": "Acme to acquire Goa developer behind Beta Trust tank at Rs 9 crore",
        "partnerships & alliances": "Acme and Beta join hands for Gamma Agency water main in Goa",
        "project execution": "Acme completes 66 kV line for Beta near Goa",
        "stock market": "Acme shares rise 5 per cent after Beta order for wind farm",
    }
    from presswork.operators.events import same_event

    for category, title in titles.items():
        facts = json.loads(pipeline.OfflineModel().facts(title, "", category))
        assert same_event(facts, facts, category), (category, facts)
