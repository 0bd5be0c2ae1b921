"""Main content of a page, told from menus, notices, teasers and footers.

Each page goes as one stream through the standard library's parser. The events
give, for each line, its text and its tags. Pages that were saved as text have
lost their tags, so what stands for links and buttons is found without any
list of phrases: glyphs that part short items, lines that end in no sentence,
and templates, lines of one shape on many pages that never stand inside a
paragraph and do not lead into text. Their counts come from the whole corpus.

The logarithms of the text-to-tag ratios of the lines are smoothed with a
Gaussian, in which lines with clear evidence weigh more than short or unclear
ones, and split at the threshold between the two clusters of the page. The
smoothed ratio decides every line.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.session import cut

#: Width of the smoothing, in lines.
SIGMA = 0.9
#: How much a line counts for itself and for its neighbours in the smoothing: an unclear line, one of text, one of furniture.
UNCLEAR, TEXT, FURNITURE = (1.0, 1.0), (24.0, 12.0), (60.0, 4.0)
#: Tags that an item of a line of linked items is worth.
ITEM_TAGS = 3
#: Words from which a line without a sentence is taken as one link, and tags that this is worth.
LINK_WORDS, LINK_TAGS = 4, 6
#: Words from which a line that ends in a sentence is text.
SENTENCE_WORDS = 5
#: Ratios (characters per tag) of one line of furniture and one of text that are added to every page before its
#: lines are clustered, so that a page of one kind is not split.
ANCHORS = (0.0, 150.0)
#: Share of a headline's words that the story's own title must hold.
OWN_TITLE = 0.6
#: A shape counts as repeated from this many pages, and from this share of all pages. With L lines a page at most
#: L / SHARE shapes are repeated, 8 bytes each.
LEAST_PAGES, SHARE = 8, 0.00002
#: Uses inside paragraphs, as a share of the uses as a whole line, from which a shape is a sentence of stories.
INSIDE = 0.1
#: Share of its uses in which a repeated line must lead into text, or else is furniture.
LEADS = 0.78
#: Standard errors by which the share must stay below.
ERRORS = 1.6
#: Distinct shapes that a task counts before it hands its counts on.
FLUSH = 200_000
#: Elements whose text is never content.
HIDDEN = frozenset({"script", "style", "nav", "footer", "aside", "iframe", "noscript", "form", "button"})
#: Elements of running text, which are no sign of furniture and count as no tags.
PLAIN = frozenset({"p", "br", "b", "i", "em", "strong", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "article", "main", "body", "html", "sup", "sub"})

_ITEMS = re.compile(r"\s*(?:[>|·•/›»]|\s{2,}|\t)\s*")
_MARK = re.compile(r"[>|·»›←→☰★☆©✓]|\S(?: {2,}|\t)\S")
_WORD = re.compile(r"[^\W_]+")
_NUMBER = re.compile(r"\d+")
_ENDS, _CLOSES = frozenset(".!?…।。！？"), "\"'”’)]"
_BETWEEN = re.compile(r"(?<=[.!?…।。！？])\s+(?=[^\W_a-z]|\d)")
_BULLET = re.compile(r"^(?:[•◦▪‣*·–—-]|\d{1,2}[.)])\s+(?=\S)")
_COLON = re.compile(r"\s?[:»|]\s")
#: Words before a first colon or bar that are taken as a lead.
LEAD_WORDS = 5
_TAGLIKE = re.compile(r"<[a-zA-Z/!?]|&[#a-zA-Z]")


class LineEvents(HTMLParser):
    """Text and number of tags of each line of a page, from the parser's events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text: dict[int, list[str]] = {}
        self.tags: dict[int, int] = {}
        self.depth = 0

    def _tag(self, tag: str) -> None:
        if tag not in PLAIN:
            line = self.getpos()[0]
            self.tags[line] = self.tags.get(line, 0) + 1

    def handle_starttag(self, tag, attrs):
        self._tag(tag)
        self.depth += tag in HIDDEN

    def handle_startendtag(self, tag, attrs):
        self._tag(tag)

    def handle_endtag(self, tag):
        self._tag(tag)
        if tag in HIDDEN and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            first = self.getpos()[0]
            for offset, part in enumerate(data.split("\n")):
                if part.strip():
                    self.text.setdefault(first + offset, []).append(part)


def line_events(page: str) -> list[tuple[str, int]]:
    """``(text, tags)`` of each line; a page without markup needs no parsing of its lines."""
    lines = page.split("\n")
    if not _TAGLIKE.search(page):
        return [(line, 0) for line in lines]
    parser = LineEvents()
    parser.feed(page)
    parser.close()
    return [(" ".join(parser.text.get(i, ())), parser.tags.get(i, 0)) for i in range(1, len(lines) + 1)]


def shape(text: str, site: str | None) -> int:
    """A 64-bit hash of what a line of a template has in common on all pages: letter case, spacing, a bullet, the numbers
    and the name of the site do not count."""
    if not text[0].isalpha():
        text = _BULLET.sub("", text)
    if site and site in text:
        text = text.replace(site, "\x01")
    text = text.lower()
    if "  " in text or "\t" in text:
        text = " ".join(text.split())
    return xxhash.xxh64_intdigest(_NUMBER.sub("0", text)) - (1 << 63)


def shapes(text: str, site: str | None) -> tuple[int, ...]:
    """The shape of a line, and that of the few words before a first colon or bar, if it has them."""
    colon = _COLON.search(text, 1, 80)
    if colon and text.count(" ", 0, colon.start()) < LEAD_WORDS:
        return shape(text, site), shape(text[: colon.start()] + "\x02", site)
    return (shape(text, site),)


def is_sentence(text: str) -> bool:
    """Whether a line ends a sentence of some words."""
    last = text[-1]
    if last in _CLOSES:
        last = text.rstrip(_CLOSES)[-1:]
    return last in _ENDS and text.count(" ") >= SENTENCE_WORDS - 1


def _parts(text: str, site: str | None) -> Iterator[int]:
    """Shapes of the runs of one to three sentences inside a line of several."""
    sentences = _BETWEEN.split(text)
    n = len(sentences)
    if n > 1:
        for begin in range(n):
            for end in range(begin + 1, min(n, begin + 3) + 1):
                if end - begin < n:
                    yield shape(" ".join(sentences[begin:end]), site)


def _weigh(text: str, tags: int, title: frozenset[str], site: str | None, templates: frozenset[int]) -> tuple[float, tuple[float, float]]:
    """Text-to-tag ratio of a line, and its weights."""
    size = len(text)
    known = shapes(text, site) if templates else ()
    sentence = is_sentence(text)
    if title and not sentence and not (len(known) > 1 and known[1] in templates):
        own = set(_WORD.findall(text.lower()))
        if len(own) >= 4 and len(own & title) >= OWN_TITLE * min(len(own), len(title)):
            return size / (1.0 + tags), TEXT
    if not templates.isdisjoint(known):
        return size / (1.0 + tags + size), FURNITURE
    if sentence:
        return size / (1.0 + tags), TEXT if size > 20 * tags else UNCLEAR
    marks = tags + len(_MARK.findall(text))
    items = [i for i in _ITEMS.split(text) if i]
    if len(items) >= 3 and max(i.count(" ") for i in items) <= 3:
        return size / (1.0 + marks + ITEM_TAGS * len(items)), FURNITURE
    if text.count(" ") + 1 >= LINK_WORDS:
        return size / (1.0 + marks + LINK_TAGS), UNCLEAR
    return size / (1.0 + 2 * marks), FURNITURE if tags else UNCLEAR


def smooth(values: list[float], weights: list[tuple[float, float]], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing over the sequence, in which each value counts with its weights. No width leaves the values as they are."""
    if sigma <= 0:
        return list(values)
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        weight = weights[i][0]
        total = weight * values[i]
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            if j != i:
                k = kernel[abs(i - j)] * weights[j][1]
                total += k * values[j]
                weight += k
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Midpoint of the two clusters of one-dimensional 2-means over the values and the anchors."""
    values = [*values, *(math.log1p(a) for a in ANCHORS)]
    low, high = min(values), max(values)
    for _ in range(20):
        middle = (low + high) / 2
        below = [v for v in values if v <= middle]
        above = [v for v in values if v > middle]
        if not above:
            return middle
        new = sum(below) / len(below), sum(above) / len(above)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def furniture_lines(
    page: str | None, title: str | None = None, site: str | None = None, templates: frozenset[int] = frozenset(), sigma: float = SIGMA
) -> list[int]:
    """Numbers (from 1, blank lines counted) of the lines that are not blank and not main content.

    A null or blank page has none. ``title`` (may be null) helps to know the
    story's own headline, ``site`` the templates. The smoothed ratio decides
    every line.
    """
    if not page:
        return []
    numbers, ratios, clear = [], [], []
    own = frozenset(w.lower() for w in _WORD.findall(title)) if title else frozenset()
    raw = page.split("\n")
    for number, (text, tags) in enumerate(line_events(page), 1):
        if not raw[number - 1].strip():
            continue
        text = text.strip()
        ratio, weight = _weigh(text, tags, own, site, templates) if text else (0.0, FURNITURE)
        numbers.append(number)
        ratios.append(math.log1p(ratio))
        clear.append(weight)
    if not numbers:
        return []
    level = smooth(ratios, clear, sigma)
    middle = threshold(level)
    return [n for n, v in zip(numbers, level) if v <= middle]


def _texts(page: str) -> list[str]:
    return [text for text in (t.strip() for t, _ in line_events(page)) if text]


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _table(counts: dict[int, list], names: tuple[str, ...]) -> pa.RecordBatch:
    values = [pa.array(list(counts), pa.int64())]
    for at in range(len(names) - 1):
        values.append(pa.array([v[at] for v in counts.values()], pa.float64()))
    return pa.RecordBatch.from_arrays(values, names=list(names))


def _story_key() -> Column:
    """A hash of the longest line of a page: copies of a story, and most copies with small edits, have the same."""
    return F.array_max(F.transform(F.split("page", "\n"), lambda line: F.struct(F.length(line), F.xxhash64(line).alias("h"))))["h"]


def page_templates(pages: DataFrame, least: int = LEAST_PAGES, share: float = SHARE) -> frozenset[int]:
    """Shapes of the lines that are furniture by their use on all pages.

    Such a shape is on many pages of different stories (``least`` pages and
    ``share`` of all; the copies of a story count as one page), hardly ever
    stands inside a paragraph, and often has no text after it. With L lines a
    page there are at most L / ``share`` of them, whatever the number of pages;
    only they reach the driver. A template on fewer pages is left to the ratio.
    """
    spark = pages.sparkSession
    keyed = pages.filter(F.length("page") > 0).select("page", "site", _story_key().alias("key"))
    keys = cut(keyed.groupBy("key").agg(F.count("*").alias("n")))
    total = keys.agg(F.sum("n")).first()[0] or 0
    floor = max(least, math.ceil(share * total))
    # at most 1 / share keys
    copies = spark.sparkContext.broadcast({r["key"]: r["n"] for r in keys.filter(F.col("n") >= floor).collect()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, list] = {}
        for page, site, key in _rows(batches, "page", "site", "key"):
            weight = 1.0 / copies.value.get(key, 1)
            for s in {s for text in _texts(page) for s in shapes(text, site)}:
                known = counts.setdefault(s, [0, 0.0])
                known[0] += 1
                known[1] += weight
            if len(counts) > FLUSH:
                yield _table(counts, ("shape", "n", "stories"))
                counts.clear()
        yield _table(counts, ("shape", "n", "stories"))

    counted = keyed.mapInArrow(count, "shape bigint, n double, stories double").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("stories").alias("stories"))
    often = counted.filter((F.col("n") >= floor) & (F.col("stories") >= F.col("n") / 2)).select("shape").collect()
    repeated = spark.sparkContext.broadcast(frozenset(r["shape"] for r in often))

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, list] = {}
        known = repeated.value
        for page, site in _rows(batches, "page", "site"):
            texts = _texts(page)
            for at, text in enumerate(texts):
                for s in _parts(text, site):
                    if s in known:
                        counts.setdefault(s, [0, 0, 0])[1] += 1
                for s in shapes(text, site):
                    if s in known:
                        found = counts.setdefault(s, [0, 0, 0])
                        found[0] += 1
                        found[2] += at + 1 < len(texts) and is_sentence(texts[at + 1])
        yield _table(counts, ("shape", "n", "inside", "leads"))

    used = keyed.select("page", "site").mapInArrow(use, "shape bigint, n double, inside double, leads double")
    used = used.groupBy("shape").agg(*[F.sum(c).alias(c) for c in ("n", "inside", "leads")])
    leads = F.col("leads") / F.col("n")
    furniture = (F.col("inside") < INSIDE * F.col("n")) & (leads + ERRORS * F.sqrt(leads * (1 - leads) / F.col("n")) < LEADS)
    return frozenset(r["shape"] for r in used.filter(furniture).select("shape").collect())


def page_furniture(pages: DataFrame, templates: frozenset[int] | None = None) -> DataFrame:
    """``table_name``, ``row_id``, ``line_no`` of every line that is not main content.

    ``pages`` has ``table_name``, ``row_id``, ``page``, ``title`` and ``site``
    (the last two may be null). Only counts of shapes are shuffled. Null and
    blank pages give no rows. ``templates`` of another corpus may be given.
    """
    known = pages.sparkSession.sparkContext.broadcast(page_templates(pages) if templates is None else templates)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, lines = [], []
            for row, (page, title, site) in enumerate(_rows([batch], "page", "title", "site")):
                found = furniture_lines(page, title, site, known.value)
                take.extend([row] * len(found))
                lines.extend(found)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("table_name").take(at), batch.column("row_id").take(at), pa.array(lines, pa.int32())],
                names=["table_name", "row_id", "line_no"],
            )

    return pages.select("table_name", "row_id", "page", "title", "site").mapInArrow(find, "table_name string, row_id bigint, line_no int")


def main_text(page: str | None, title: str | None = None, site: str | None = None, templates: frozenset[int] = frozenset()) -> str | None:
    """The page without its furniture; blank lines are dropped. Null gives null."""
    if page is None:
        return None
    drop = set(furniture_lines(page, title, site, templates))
    return "\n".join(t.strip() for i, (t, _) in enumerate(line_events(page), 1) if i not in drop and t.strip())


def page_main_text(pages: DataFrame, templates: frozenset[int] | None = None) -> DataFrame:
    """``table_name``, ``row_id``, ``main_text`` of every page; null pages give null, pages of furniture only the empty text."""
    known = pages.sparkSession.sparkContext.broadcast(page_templates(pages) if templates is None else templates)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, t, s, known.value) for p, t, s in _rows([batch], "page", "title", "site")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("table_name"), batch.column("row_id"), pa.array(texts, pa.string())], names=["table_name", "row_id", "main_text"]
            )

    return pages.select("table_name", "row_id", "page", "title", "site").mapInArrow(keep, "table_name string, row_id bigint, main_text string")
