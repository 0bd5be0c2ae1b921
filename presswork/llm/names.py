"""Typed spellings of names, linked to the official names they mean.

Distinct spellings are compared with the known forms of each official name by
a true metric (Levenshtein distance on squeezed text). The metric space is
partitioned: pivots are chosen among the known forms, a spelling is assigned
to the cell of its nearest pivot, and a known form is repeated in every cell
that can hold a spelling within the radius. If ``d(x, y) <= r`` and ``p`` is
the pivot nearest to ``x``, then for the pivot ``q`` nearest to ``y``
``d(y, p) <= d(x, p) + r <= d(x, q) + r <= d(y, q) + 2 r``, so no link is lost
by comparing only inside cells.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.packed import segment
from presswork.operators.skew import HOT_ROWS, join_unique

#: A dictionary of more official names than this is refused: its words and forms go to every worker (about 1 kB a name).
MAX_NAMES = 200_000
#: Least and most pivots of the metric partition; in between they grow with the square root of the forms.
PIVOTS, MOST_PIVOTS = 24, 128
#: Forms among which pivots are chosen.
PIVOT_SAMPLE = 4_000
#: Largest radius of a link, in edits.
RADIUS = 4

#: Words of legal form, short and long.
LEGAL_SHORT = frozenset({"ltd", "pvt", "co", "corp", "corpn", "inc", "llp", "plc", "p", "m", "s", "ms", "messrs", "and", "cos"})
LEGAL_LONG = ("limited", "private", "company", "corporation", "incorporated")
#: Words that say no more than the name before them.
GENERIC_TAIL = frozenset({"group"})


def levenshtein(a: str, b: str) -> int:
    """Edit distance with unit costs."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def distances(texts: list[str], pivot: str) -> np.ndarray:
    """Edit distance of each text to ``pivot``, for all texts at once."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    width = max(1, int(size.max(initial=0)))
    codes = np.array(texts, f"U{width}").view(np.uint32).reshape(len(texts), width).T.copy()
    row = [np.full(len(texts), j, np.int16) for j in range(len(pivot) + 1)]
    out = row[-1].copy()
    for i in range(1, width + 1):
        diagonal, row[0] = row[0], np.full(len(texts), i, np.int16)
        for j, c in enumerate(pivot, 1):
            least = np.minimum(np.minimum(row[j], row[j - 1]) + 1, diagonal + (codes[i - 1] != ord(c)))
            diagonal, row[j] = row[j], least.astype(np.int16)
        out = np.where(size == i, row[-1], out)
    return out


def typing_errors(a: str, b: str) -> int:
    """Edit distance in which two swapped neighbours count once. No metric: only for the exact check of a link."""
    last, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, last, row = last, row, [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, older[j - 2] + 1)
            row.append(best)
    return row[-1]


def words_of(name: str) -> list[str]:
    """Lower-case words; the dots of initials and the slash inside a word vanish, other punctuation separates."""
    text = re.sub(r"(?<=\w)/(?=\w\w)", "", re.sub(r"\bm\s?/\s?s\b\.?", " ", name.lower()))
    text = re.sub(r"(?<=\b\w)\.(?=\w\b)", "", text)
    return re.findall(r"[^\W_]+", text)


def is_legal(word: str) -> bool:
    """Whether a word states the legal form, small typing errors included."""
    if word in LEGAL_SHORT:
        return True
    return len(word) >= 5 and any(
        abs(len(word) - len(form)) <= 2 and levenshtein(word, form) <= (3 if len(form) > 9 else 2) for form in LEGAL_LONG
    )


def abbreviates(short: str, word: str) -> bool:
    """Whether ``short`` keeps the first letter and, in order, some further letters of ``word``."""
    if len(short) > len(word) - 2 or len(short) < 2 or short[0] != word[0]:
        return False
    rest = iter(word)
    return all(c in rest for c in short)


class NameForms:
    """Known forms of official names, and the forms in which a typed spelling is looked up."""

    def __init__(self, officials: list[tuple[str, list[str]]]):
        cores = {name: [w for w in words_of(name) if not is_legal(w)] for name, _ in officials}
        first = Counter(core[0] for core in cores.values() if core)
        self.vocabulary = sorted({w for core in cores.values() for w in core[1:]})
        self.known_words = frozenset(self.vocabulary) | frozenset(first)
        self._by_letter: dict[str, list[str]] = defaultdict(list)
        for w in self.vocabulary:
            self._by_letter[w[0]].append(w)
        self._expanded: dict[str, str] = {}
        made: dict[str, set[str]] = defaultdict(set)
        whole: set[str] = set()
        stated: dict[str, set[str]] = defaultdict(set)
        for name, aliases in officials:
            core, words = cores[name], words_of(name)
            if not core:
                continue
            for form in ("".join(core), "".join(w for w in words if w != "and")):
                stated[form].add(name)
                whole.add(form)
            for alias in aliases:
                form = self.squeeze(alias)
                stated[form].add(name)
                if len(words_of(alias)) > 1:
                    whole.add(form)
            initials = "".join(w[0] for w in words if w != "and")
            for form in (initials[: len(core)], initials[: len(core) + 1]):
                if len(form) >= 3:
                    made[form].add(name)
            if first[core[0]] == 1:
                made[core[0]].add(name)
            if len(core) > 1:
                made[core[0] + core[1]].add(name)
                for head in (core[0][:4], core[0][:5]):
                    for form in (head + core[1], head + core[1][:5]):
                        made[form].add(name)
        #: Squeezed form -> official names. A made form stands only if it is clear and not stated otherwise.
        self.forms = {form: sorted(names) for form, names in stated.items() if form}
        for form, names in made.items():
            if len(names) == 1 and form not in self.forms:
                self.forms[form] = sorted(names)
        #: Edits within which a spelling is compared with a form; codes and cropped forms allow fewer.
        self.radius = {form: min(radius_of(form), RADIUS if form in whole else 2) for form in self.forms}

    def expand(self, word: str) -> str:
        """The vocabulary word that ``word`` abbreviates, if any; the closest in length where several fit."""
        found = self._expanded.get(word)
        if found is None:
            fits = [] if word in self.known_words else [w for w in self._by_letter.get(word[0], ()) if abbreviates(word, w)]
            found = min(fits, key=lambda w: (len(w), w)) if fits else word
            if len(self._expanded) < 200_000:
                self._expanded[word] = found
        return found

    def squeeze(self, spelling: str) -> str:
        """Words without legal form, run together."""
        return "".join(w for w in words_of(spelling) if not is_legal(w))

    def lookups(self, spelling: str) -> set[str]:
        """The squeezed forms under which a typed spelling is looked up."""
        words = words_of(spelling)
        for at in range(len(words) - 1, 0, -1):
            joined = words[at - 1] + words[at]
            if len(words[at - 1]) == 1 and len(words[at]) > 2 and not is_legal(words[at]) and self.expand(joined) != joined:
                words[at - 1 : at + 1] = [joined]
        core = [w for w in words if not is_legal(w)]
        if not core:
            return set()
        if len(core) > 1 and core[-1] in GENERIC_TAIL:
            core = core[:-1]
        spread = [core[0], *map(self.expand, core[1:])] if len(core) > 1 else core
        found = {"".join(core), "".join(spread)}
        if len(words) > len(core):
            found.add("".join(words))
        if len(core) > 1:
            turned = [core[-1], *map(self.expand, core[:-1])]
            found |= {core[-1] + "".join(core[:-1]), "".join(turned)}
        return found


def radius_of(form: str) -> int:
    """How many edits a known form of this length allows in the metric join."""
    size = len(form)
    return 0 if size <= 5 else 2 if size <= 16 else RADIUS


def errors_allowed(form: str, radius: int) -> int:
    """How many typing errors the exact check allows: one in shorter and cropped forms."""
    return min(radius, 1) if radius <= 2 else radius


def pivots_for(forms: int) -> int:
    """How many pivots so many forms take."""
    return min(MOST_PIVOTS, max(PIVOTS, int(forms**0.5 / 2)))


def choose_pivots(forms: list[str], count: int | None = None) -> list[str]:
    """Pivots that lie far apart: each next one is the form farthest from those chosen, among a sample by hash."""
    if not forms:
        return []
    count = pivots_for(len(forms)) if count is None else count
    sample = sorted(sorted(forms, key=lambda f: zlib.crc32(f.encode()))[:PIVOT_SAMPLE])
    pivots = [max(sample, key=len)]
    near = distances(sample, pivots[0])
    while len(pivots) < min(count, len(sample)):
        pivots.append(sample[int(near.argmax())])
        near = np.minimum(near, distances(sample, pivots[-1]))
    return pivots


def cells_of_forms(forms: list[str], radius: np.ndarray, pivots: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Form, cell and distance to the cell's pivot; boundary forms are repeated in every cell that a spelling within their
    radius can be at home in."""
    table = np.array([distances(forms, p) for p in pivots]).reshape(len(pivots), len(forms))
    cell, form = np.nonzero(table <= table.min(0, initial=1 << 14) + 2 * radius)
    return form, cell, table[cell, form]


def read_officials(competitors: DataFrame) -> list[tuple[str, list[str]]]:
    """Official names without outer spaces, each with its stated other names; refused beyond ``MAX_NAMES``."""
    rows = competitors.select("competitor", "keywords_raw").limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} official names can't be sent to the workers")
    return [(r[0].strip(), segment(r[1])) for r in rows if r[0] and r[0].strip()]


def link_spellings(spark: SparkSession, spellings: DataFrame, officials: list[tuple[str, list[str]]]) -> DataFrame:
    """``spelling``, ``n``, ``competitors`` (array) of the distinct ``spelling`` (with ``n``) that mean a listed name.

    Of all names within the radius the nearest is meant; at equal distance all
    of these are.
    """
    names = NameForms(officials)
    pivots = choose_pivots(sorted(names.forms))
    longest = max(map(len, names.forms), default=0) + RADIUS
    # little data but much work for each spelling: spread over all tasks, whatever their size
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    salts = -(-tasks // max(1, len(pivots)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            radius = batch.column("radius").to_numpy()
            form, cell, distance = cells_of_forms(batch.column("form").to_pylist(), radius, pivots)
            kept = [batch.column(c).take(pa.array(form)) for c in ("form", "radius", "officials")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(distance.astype(np.int32)), *kept], names=["cell", "form_distance", "form", "radius", "officials"]
            )

    rows = [(form, names.radius[form], officials) for form, officials in names.forms.items()]
    known = (
        spark.createDataFrame(rows, "form string, radius int, officials array<string>")
        .mapInArrow(place, "cell int, form_distance int, form string, radius int, officials array<string>")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, out = [], []
            for row, spelling in enumerate(batch.column("spelling").to_pylist()):
                # a longer form is within no radius
                found = sorted(f for f in names.lookups(spelling) if len(f) <= longest)
                take.extend([row] * len(found))
                out.extend(found)
            table = np.array([distances(out, p) for p in pivots]).reshape(len(pivots), len(out))
            cell = table.argmin(0) if len(pivots) else np.zeros(len(out), np.int64)
            near = table[cell, np.arange(len(out))] if len(pivots) else cell
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("spelling").take(at), batch.column("n").take(at), pa.array(out, pa.string()), pa.array(cell.astype(np.int32)), pa.array(near.astype(np.int32))],
                names=["spelling", "n", "typed", "cell", "typed_distance"],
            )

    typed = (
        spellings.select("spelling", F.col("n").cast("bigint").alias("n"))
        .repartition(tasks, F.xxhash64("spelling"))
        .mapInArrow(forms, "spelling string, n bigint, typed string, cell int, typed_distance int")
        .withColumn("salt", F.pmod(F.hash("typed", "spelling"), F.lit(salts)))
    )
    edits = F.levenshtein(F.col("typed"), F.col("form"), RADIUS)
    linked = (
        typed.join(known, ["cell", "salt"])
        .filter(F.abs(F.col("typed_distance") - F.col("form_distance")) <= F.col("radius"))
        .filter(F.abs(F.length("typed") - F.length("form")) <= F.col("radius"))
        .withColumn("edits", edits)
        .filter((F.col("edits") >= 0) & (F.col("edits") <= F.col("radius")))
    )
    hits = linked.groupBy("spelling", "n").agg(F.collect_set(F.struct("edits", "radius", "typed", "form", "officials")).alias("hits"))
    return hits.mapInArrow(_meant, "spelling string, n bigint, competitors array<string>")


def _meant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The exact check: typing errors of each hit, and the officials of the nearest."""
    for batch in batches:
        take, out = [], []
        for row, hits in enumerate(batch.column("hits").to_pylist()):
            one = len({tuple(h["officials"]) for h in hits}) == 1
            best, meant = None, set()
            for h in sorted(hits, key=lambda h: (h["edits"], h["typed"], h["form"])):
                errors = h["edits"]
                if errors > 1 and (h["radius"] <= 2 or not one):
                    errors = typing_errors(h["typed"], h["form"])
                if errors > errors_allowed(h["form"], h["radius"]) or best is not None and errors > best:
                    continue
                meant = set(h["officials"]) | (meant if errors == best else set())
                best = errors
            if meant:
                take.append(row)
                out.append(sorted(meant))
        at = pa.array(take, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("spelling").take(at), batch.column("n").take(at), pa.array(out, pa.list_(pa.string()))],
            names=["spelling", "n", "competitors"],
        )


def spelled_names(
    spark: SparkSession, named: DataFrame, officials: list[tuple[str, list[str]]], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``table_name``, ``row_id``, ``competitor``: listed names that rows mean in another spelling.

    ``named`` has ``table_name``, ``row_id`` and ``spelling``, one row for each
    typed name. Null and blank spellings mean nothing. A row that names the
    same official twice comes out once; one that spells it exactly only does
    not come out.
    """
    rows = named.select("table_name", "row_id", F.regexp_replace("spelling", r"(?U)^\s+|\s+$", "").alias("spelling")).filter(
        F.col("spelling") != ""
    )
    distinct = rows.groupBy("spelling").agg(F.count("*").alias("n"))
    linked = link_spellings(spark, distinct, officials)
    return (
        join_unique(rows, linked, ["spelling"], "n", F.col("row_id"), hot_rows)
        .select("table_name", "row_id", "spelling", F.explode("competitors").alias("competitor"))
        .filter(F.col("competitor") != F.col("spelling"))
        .select("table_name", "row_id", "competitor")
        .distinct()
    )
