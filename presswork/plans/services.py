"""External steps of the pipeline behind small interfaces, each with a deterministic offline form.

A service is called once for each row of a partition; its results are
materialised by the pipeline, so a plan that is used twice calls it once.
Failures are retried and then give the step's empty result.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame

from presswork.functions.amounts import stated_amounts
from presswork.operators.events import FACTS, OTHER_FACTS


class Model(Protocol):
    """What the pipeline asks of a model; every reply is a text that the pipeline parses."""

    def score(self, title: str, competitor: str) -> str:
        """A reply that holds a score of 0 to 100."""

    def analyse(self, title: str, content: str, score: int) -> str:
        """A reply that holds a JSON object with the analysed fields."""

    def facts(self, title: str, content: str, category: str) -> str:
        """A reply that holds a JSON object with the facts of the category."""


@dataclass(frozen=True)
class Prompts:
    """Templates of the three questions; ``{name}`` is filled in, and a caller may give templates of their own."""

    score: str = "How relevant is this headline to {competitor}? Answer with a number from 0 to 100.\nHeadline: {title}"
    analyse: str = (
        "Read the article and answer with one JSON object of the keys {fields}.\nFirms:\n{competitors}\nCategories:\n{categories}\n"
        "Relevance: {score}\nHeadline: {title}\nArticle: {content}"
    )
    facts: str = "State the facts of this {category} report as one JSON object of the keys {fields}.\nHeadline: {title}\nArticle: {content}"


@dataclass(frozen=True)
class HostedModel:
    """A model behind ``complete`` (prompt to reply); ``lists`` fill the templates with the dictionaries in use."""

    complete: Callable[[str], str]
    fields: tuple[str, ...]
    lists: tuple[tuple[str, str], ...] = ()
    prompts: Prompts = Prompts()

    def score(self, title: str, competitor: str) -> str:
        return self.complete(self.prompts.score.format(title=title, competitor=competitor, **dict(self.lists)))

    def analyse(self, title: str, content: str, score: int) -> str:
        given = {"competitors": "", "categories": "", **dict(self.lists)}
        return self.complete(self.prompts.analyse.format(title=title, content=content, score=score, fields=", ".join(self.fields), **given))

    def facts(self, title: str, content: str, category: str) -> str:
        fields = FACTS.get(category.lower(), OTHER_FACTS)
        return self.complete(self.prompts.facts.format(title=title, content=content or "Not available", category=category, fields=", ".join(fields)))


#: What titles of each category say, the first that fits decides.
CATEGORY_TERMS = (
    ("order wins", ("wins", "bags", "secures", "lands", "clinches", "adds", "goes to", "selects", "picks", "names", "chooses")),
    ("bidding activity", ("bid", "tender", "lowest bidder")),
    ("project execution", ("commissions", "completes", "hands over", "halfway", "clears first stage", "delay at", "energises")),
    ("mergers & acquisitions", ("acquire", "buys", "stake")),
    ("partnerships & alliances", ("join hands", "signs pact", "tie-up")),
    ("financial", ("revenue", "profit", "order book", "results")),
    ("stock market", ("shares", "stock")),
    ("regulatory & policy", ("regulator", "changes rules", "policy")),
    ("legal & disputes", ("tribunal", "legal")),
)
_KIND = re.compile(r"\b(?:line|substation|wind|solar|pipeline|main|bridge|metro|tunnel|electrification|doubling|highway|terminal|tank|battery|meter)\b")
_NAME = r"[A-Z][\w&’'-]*(?: (?:of |& )?[A-Z][\w&’'-]*)*"
_FIRST = re.compile(_NAME)
_CLIENT = re.compile(rf"\b(?:from|for|of|by|asks|after) (?:the )?({_NAME})")
_PLACE = re.compile(r"\b(?:at|in|near) (?:the )?([A-Z][a-z]+)")
_SCALE = re.compile(rf"\b\d[\d.,]*[ -]?[A-Za-z]+ (?:[\w-]+ ){{0,2}}?{_KIND.pattern[2:-2]}\b")
_TARGET = re.compile(rf"(?:acquires?|stake in) ({_NAME})")
_TOGETHER = re.compile(rf"({_NAME}) (?:and|with|signs pact with|ties up with) ({_NAME})")
_PERCENT = re.compile(r"(\d+(?:\.\d+)?) ?(?:%|per ?cent)")
_PERIOD = re.compile(r"(?i)\b(?:first|second|third|fourth) quarter\b|\bhalf year\b|\bnine months\b|\bq[1-4]\b|\bfy ?\d+\b")
_CAUSE = re.compile(r"\b(?:on|after|as) (.{10,})$")
_PARTS = re.compile(r"\s+[|–—-]\s+|:\s+")


def category_of(title: str) -> str:
    """The category whose terms a title holds; the first in the table decides."""
    low = title.lower()
    return next((c for c, terms in CATEGORY_TERMS if any(t in low for t in terms)), "industry trends")


def read_facts(title: str, content: str) -> dict[str, str | None]:
    """What the title states, or lacking it the first sentence of the page, under the names of all categories' facts."""
    main = max(_PARTS.split(title), key=len, default="")
    lead = (content or "").split("\n")[0][:400]

    def find(pattern: re.Pattern, group: int = 1) -> str | None:
        hit = pattern.search(main) or pattern.search(lead)
        return hit[group].strip() if hit else None

    company = find(_FIRST, 0)
    clients = [c for c in _CLIENT.findall(main) + _CLIENT.findall(lead) if c != company]
    client = clients[0] if clients else company
    amounts = [a for a in stated_amounts(title) if a.currency == "INR"] or [a for a in stated_amounts(lead) if a.currency == "INR"]
    value = str(round(amounts[0].value / 1e7, 2)) if amounts else None
    pair = _TOGETHER.search(main)
    kind = _KIND.search(main.lower()) or _KIND.search(lead.lower())
    low = main.lower()
    term = next((t for _, terms in CATEGORY_TERMS for t in terms if t in low), None)
    return {
        "company": company,
        "client_or_authority": client,
        "companies_bidding": company,
        "acquirer": company,
        "target_company": find(_TARGET),
        "companies_involved": ", ".join(sorted((pair[1], pair[2]))) if pair else company,
        "authority": company,
        "counterparty": client,
        "location": find(_PLACE),
        "geography": find(_PLACE),
        "scope": " ".join(_KIND.findall(low)) or None,
        "capacity_or_scale": find(_SCALE, 0),
        "project_name": find(_SCALE, 0),
        "sector": kind[0] if kind else None,
        "sector_affected": kind[0] if kind else None,
        "topic": kind[0] if kind else None,
        "milestone": term,
        "deal_type": term,
        "event_type": term,
        "issue_type": term,
        "policy_or_rule": term,
        "period": find(_PERIOD, 0),
        "stake_percent": find(_PERCENT),
        "price_movement_percent": find(_PERCENT),
        "trigger_event": find(_CAUSE),
        "key_stat": find(_PERCENT) or value,
        "contract_value_crore": value,
        "project_value_crore": value,
        "deal_value_crore": value,
        "value_crore": value,
        "value": value,
        "revenue_crore": value if "revenue" in low else None,
        "profit_crore": value if "profit" in low else None,
        "order_book_crore": value if "order book" in low else None,
    }


class OfflineModel:
    """Rules that stand in for a hosted model: the same input always gives the same reply."""

    def score(self, title: str, competitor: str) -> str:
        points = 20 + 40 * (competitor.strip() not in ("", "-")) + 20 * bool(_KIND.search(title.lower())) + 10 * bool(stated_amounts(title))
        return f"Score: {points + 5 * (category_of(title) != 'industry trends') + min(5, len(title.split()) // 3)}"

    def analyse(self, title: str, content: str, score: int) -> str:
        amounts = [a for a in stated_amounts(title) if a.currency == "INR"]
        text = (content or title).split(". ")[0]
        found = {
            "competitor_tagging": None,
            "sbu_tagging": "General",
            "category_tag": category_of(title),
            "summary": " ".join(text.split()[:40]),
            "contract_value_inr_crore": round(amounts[0].value / 1e7, 2) if amounts else None,
            "geography": None,
        }
        return "```json\n" + json.dumps(found) + "\n```"

    def facts(self, title: str, content: str, category: str) -> str:
        known = read_facts(title, content)
        return json.dumps({f: known.get(f) for f in FACTS.get(category.lower(), OTHER_FACTS)})


def call(
    rows: DataFrame, service: Callable[..., str], columns: list[str], out: str = "reply", tries: int = 3, pause: float = 0.0, only: str | None = None
) -> DataFrame:
    """``rows`` with ``out``: the service's reply to ``columns`` (null as empty text); null after ``tries`` failures. With ``only``
    the service is called for the rows in which this column is true, and the others have null."""
    from pyspark.sql.types import StringType, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = []
            asked = batch.column(only).to_pylist() if only else [True] * batch.num_rows
            for ask, *given in zip(asked, *(batch.column(c).to_pylist() for c in columns)):
                reply = None
                for attempt in range(tries if ask else 0):
                    try:
                        reply = service(*("" if g is None else g for g in given))
                        break
                    except Exception:  # noqa: BLE001 - whatever a service raises is retried
                        time.sleep(pause * 2**attempt)
                replies.append(reply)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(replies, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add(out, StringType()))
