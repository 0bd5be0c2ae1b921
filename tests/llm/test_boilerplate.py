"""Main content of pages."""

import random

import pytest

from presswork.llm.boilerplate import SIGMA, furniture_lines, line_events, main_text, page_furniture, page_main_text, page_templates, shape, smooth, threshold

KINDS = "bridge dam kiln silo lathe tram quarry ferry loom mill".split()
PLACES = "Arlu Bevik Cando Dorth Eskel Fanno Gimli Hurst Iveta Jonka".split()
SENTENCES = (
    "The {k} at {p} will be ready in {n} months, the owner said.",
    "{p} has asked for {n} more workers to finish the {k} before winter.",
    "No one was hurt when a wall of the {k} fell in {p} last week.",
    "A second {k} near {p} is planned, and {n} firms want to build it.",
    "Search for a new owner of the {k} has taken {n} weeks so far.",
    "The council of {p} set aside {n} coins for the {k} and its yard.",
)
HEADS = ("Owner of {k} in {p} waits {n} weeks for bricks", "{p} counts {n} cracks in old {k}", "New {k} opens near {p} after {n} years")


def story(rng: random.Random) -> str:
    return rng.choice(SENTENCES).format(k=rng.choice(KINDS), p=rng.choice(PLACES), n=rng.randint(2, 99))


def headline(rng: random.Random) -> str:
    return rng.choice(HEADS).format(k=rng.choice(KINDS), p=rng.choice(PLACES), n=rng.randint(2, 99))


def made_page(rng: random.Random, site: str, markup: bool) -> tuple[str, str, set[int]]:
    """A page of a style with wording of its own: text, title and the numbers of its furniture lines."""
    link = (lambda x: f'<li><a href="/x">{x}</a></li>') if markup else str
    para = (lambda x: f"<p>{x}</p>") if markup else str
    title = headline(rng)
    lines = [(link(x), True) for x in ("Kitchen", "Garden", "Attic")[: rng.randint(1, 3)]]
    lines += [(link(f"Welcome to {site}, reader {rng.randint(1, 99)}. Mind the step."), True)]
    lines += [(para(title), False), (para(rng.choice(["From the tower", "Written at night"])), False)]
    for at in range(rng.randint(3, 6)):
        if at == 2 and rng.random() < 0.8:
            lines.append((para(rng.choice(["Why now", "The plan in short"])), False))
        lines.append((para(" ".join(story(rng) for _ in range(rng.randint(1, 3)))), False))
        if rng.random() < 0.15:
            lines.append((link(rng.choice(["Buy the green tin", "A word from the tin makers"])), True))
    if rng.random() < 0.7:
        lines.append((link("Neighbours were gripped by"), True))
        lines += [(link(headline(rng)), True) for _ in range(rng.randint(2, 4))]
    lines += [(link(x), True) for x in (f"{site} is printed on {rng.randint(10, 99)} sheets. Ask the porter.", "Ladder | Cellar | Roof | Porch")]
    return "\n".join(x for x, _ in lines), title, {i for i, (_, off) in enumerate(lines, 1) if off}


def made_corpus(n: int, markup: bool, seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        site = rng.choice(["The Owl", "Daily Hedge", "Brook Post"])
        page, title, wrong = made_page(rng, site, markup)
        out.append((i, page, title if rng.random() < 0.8 else None, site, wrong))
    return out


def frame(spark, rows):
    shaped = [("t", i, page, title, site, 5) for i, page, title, site, *_ in rows]
    return spark.createDataFrame(shaped, "table_name string, row_id bigint, page string, title string, site string, line_no int")


@pytest.mark.parametrize("markup", [False, True])
def test_pages_of_a_style_that_no_list_knows(spark, markup):
    rows = made_corpus(400, markup)
    got = {(r["row_id"], r["line_no"]) for r in page_furniture(frame(spark, rows)).collect()}
    true = {(i, n) for i, *_, wrong in rows for n in wrong}
    # an insert that text nearly always follows is taken for a sub-head
    assert len(got & true) >= 0.9 * len(true)
    assert len(got & true) >= 0.95 * len(got)


def test_smoothing_and_threshold_decide(spark):
    rows = made_corpus(400, False)
    templates = page_templates(frame(spark, rows))
    ratio = lambda sigma: {(i, n) for i, page, title, site, _ in rows for n in furniture_lines(page, title, site, templates, sigma)}
    smoothed, plain = ratio(SIGMA), ratio(0)
    assert len(smoothed ^ plain) >= 0.15 * len(smoothed)
    true = {(i, n) for i, *_, wrong in rows for n in wrong}
    assert len(smoothed ^ true) < 0.7 * len(plain ^ true)


def test_copies_of_one_story_are_no_template(spark):
    rng = random.Random(3)
    rows = made_corpus(200, False)
    alone = [(1000 + i, rows[0][1].replace("ready", f"ready {i}") if i % 9 == 0 else rows[0][1], rows[0][2], rows[0][3], rows[0][4]) for i in range(100)]
    got = {(r["row_id"], r["line_no"]) for r in page_furniture(frame(spark, rows + alone)).collect()}
    for i, *_, wrong in (rng.choice(alone) for _ in range(20)):
        assert {n for r, n in got if r == i} == wrong


def test_a_shape_forgets_case_numbers_bullets_and_the_site():
    assert shape("• 12 readers of The Owl", "The Owl") == shape("7 READERS of Daily  Hedge", None or "Daily  Hedge")
    assert shape("a b", None) != shape("a c", None)


@pytest.mark.parametrize("page", [None, "", "\n \n"])
def test_nothing(page):
    assert furniture_lines(page, "x") == []


def test_clean_page_keeps_all():
    page = "Acme starts work in Goa.\nThe works will take two years, the firm said.\nBanks will fund half of it, officials said."
    assert furniture_lines(page, None) == []


def test_markup_is_parsed_in_one_stream():
    page = "<nav>Home\nNews</nav>\n<p>Acme has won the order in Goa, the firm said.</p>\n<a href='x'>More</a> <a>Less</a>\nA &amp; B said the work will start in May."
    events = line_events(page)
    assert len(events) == 5 and events[0][0] == "" and events[3][1] == 4 and events[4][0].startswith("A & B")
    assert furniture_lines(page) == [1, 2, 4]


def test_smoothing_and_threshold():
    level = smooth([0.0, 0.0, 9.0, 9.0, 9.0], [(1.0, 1.0)] * 5)
    assert level[0] < level[1] < level[2] < level[4]
    assert smooth([0.0, 9.0], [(1.0, 1.0)] * 2, 0) == [0.0, 9.0]
    assert smooth([0.0, 9.0], [(60.0, 1.0), (1.0, 1.0)])[0] < smooth([0.0, 9.0], [(1.0, 1.0), (1.0, 1.0)])[0]
    assert 2 < threshold([0, 0.5, 1, 8, 9, 10]) < 8
    assert 0 < threshold([5.0, 5.2, 4.8]) < 4.8


def test_frame(spark):
    page = "Home > News > Mills\nOwner waits\nThe owner waits for bricks, he said on Monday.\nThe wall will stand by spring, the town said.\nA | B | C | D"
    rows = [(1, page, None, None), (2, None, None, None), (3, "", "x", "y"), (4, "word " * 200_000, "x", None), (5, "x\n" * 50_000, None, "")]
    df = frame(spark, rows)
    got = page_furniture(df).collect()
    assert {r["line_no"] for r in got if r["row_id"] == 1} == {1, 5} and not {r["row_id"] for r in got} & {2, 3, 4}
    assert page_furniture(df.limit(0)).count() == 0
    kept = {r["row_id"]: r["main_text"] for r in page_main_text(df).collect()}
    assert kept[2] is None and kept[3] == "" and kept[1].startswith("Owner waits\nThe owner")
    assert main_text(page).endswith("the town said.")
