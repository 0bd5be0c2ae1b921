"""Text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose whole content is left out of a page's text.
DROPPED_ELEMENTS = ("script", "style", "nav", "footer", "aside", "header", "iframe")
#: Separators before an outlet's name, in the order in which they are tried.
OUTLET_SEPARATORS = (" - ", " | ", " – ", "- ", "| ")
CUT_SEPARATORS = (" - ", " | ", " – ")
#: Character references that are decoded.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_title(title: Column, source: Column) -> Column:
    """A title without the name of its outlet.

    If the title ends in a separator and the outlet's name, both go; if no
    such end was found, everything from the last separator on goes. Null and
    empty outlets only allow the second way; a null title stays null.
    """
    named = F.coalesce(source, F.lit("")) != ""
    cleaned = F.when(F.lit(False), title)
    for separator in OUTLET_SEPARATORS:
        end = F.concat(F.lit(separator), source)
        cleaned = cleaned.when(named & F.endswith(title, end), strip(F.substring(title, F.lit(1), F.length(title) - F.length(end))))
    cut = title
    for separator in CUT_SEPARATORS:
        cut = F.regexp_replace(cut, rf"(?s)^(.*){separator.replace('|', '[|]')}.*$", "$1")
    found = cleaned.otherwise(title)
    return F.when(found == title, strip(cut)).otherwise(found)


def decode_entities(text: Column) -> Column:
    """The common character references decoded; the ampersand last."""
    for reference, character in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def font_source(html: Column) -> Column:
    """Text of the first ``font`` element, stripped; empty if there is none or the input is null."""
    inner = F.regexp_extract(html, r"(?is)<font\b[^>]*>(.*?)</font>", 1)
    return F.coalesce(strip(decode_entities(F.regexp_replace(inner, r"(?s)<[^>]*>", ""))), F.lit(""))


def html_to_text(html: Column, most: int | None = None) -> Column:
    """Visible text of a page on one line, elements of furniture left out; null gives the empty text."""
    text = html
    for element in DROPPED_ELEMENTS:
        text = F.regexp_replace(text, rf"(?is)<{element}\b[^>]*>.*?</{element}\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    text = F.when(F.contains(html, F.lit("<")), text).otherwise(html)  # pages saved as text have no markup
    text = F.coalesce(strip(F.regexp_replace(decode_entities(text), r"(?U)\s+", " ")), F.lit(""))
    return text if most is None else F.substring(text, 1, most)


def parse_score(reply: Column) -> Column:
    """First run of digits of a reply, clamped to 0..100; 0 without digits or for null."""
    digits = F.regexp_extract(reply, r"([0-9]+)", 1)
    number = F.when(F.length(digits) > 9, F.lit(100)).otherwise(digits.try_cast("int"))
    return F.least(F.lit(100), F.coalesce(number, F.lit(0))).cast("int")


def json_object_text(reply: Column) -> Column:
    """The outermost braces of a reply and what is between them, code fences removed; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(reply, r"```(?:json)?", ""), r"(?U)^\s+|\s+$", "")
    found = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.when(found != "", found)


def coerce_number(text: Column) -> Column:
    """The number that a whole text states, else null. Grouping commas and type suffixes make no number."""
    plain = strip(text)
    return F.when(plain.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), plain.try_cast("double"))


def quote_url(text: Column) -> Column:
    """Percent-encoding for a query value; letters, digits, ``_.-~`` and the slash stay."""
    encoded = F.url_encode(text)
    for given, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(given), F.lit(wanted))
    return encoded


def split_tags(tags: Column) -> Column:
    """The comma-separated values of a tag field, stripped; empty values are kept. Null gives null."""
    return F.transform(F.split(tags, ","), strip)


def real_tags(tags: Column) -> Column:
    """As ``split_tags`` without empty values and dashes; null gives an empty array."""
    kept = F.filter(split_tags(tags), lambda t: (t != "") & (t != "-"))
    return F.coalesce(kept, F.array().cast("array<string>"))


def quoted_keywords(cell: Column) -> Column:
    """The values between straight double quotes of a dictionary cell; null gives none."""
    return F.coalesce(F.regexp_extract_all(cell, F.lit('"([^"]+)"'), F.lit(1)), F.array().cast("array<string>"))


def first_given(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.when(t != "", t) for t in texts])
