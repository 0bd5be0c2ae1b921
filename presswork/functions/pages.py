"""Text of pages by their element tree, for markup that patterns can't follow (nested or unclosed elements)."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from presswork.functions.text import DROPPED_ELEMENTS

#: Elements without content, which never close.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class VisibleText(HTMLParser):
    """Texts outside the dropped elements. An element that is never closed ends with the one around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.texts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if not any(tag in DROPPED_ELEMENTS for tag in self.open):
            self.texts.append(data)


def visible_text(html: str | None, most: int | None = None) -> str:
    """Visible text of a page on one line; null and broken input give what can be read."""
    if not html:
        return ""
    parser = VisibleText()
    parser.feed(html)
    parser.close()
    return " ".join(" ".join(parser.texts).split())[:most]


def with_visible_text(pages: DataFrame, html: str, out: str, most: int | None = None) -> DataFrame:
    """``pages`` with ``out``, the visible text of the column ``html``; in Arrow batches, without shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(page, most) for page in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return pages.mapInArrow(run, StructType([*pages.schema.fields]).add(out, StringType()))
