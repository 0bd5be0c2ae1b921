"""Encoding with a public byte-pair vocabulary by an automaton over its tokens.

The merges are compiled, in order of rank, by one gadget each: the gadget of
``a b -> ab`` adds the token ``ab`` and takes from every state that ends in a
live ``a`` the arcs of all tokens that begin with a live ``b``, for such a
sequence would have been merged. What remains is deterministic: one state for
each last token, and for each byte string exactly one path of arcs whose
labels spell it. The removed arcs are kept as the spines of the tokens (which
parts are live until which rank), and arcs are put into the transition table
when they are first asked for. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Default vocabulary; any path of a file of the same format can be given.
VOCABULARY = "byte_bpe_50k.json"
#: The pattern that splits text before the merges (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct words that a worker remembers.
REMEMBERED = 300_000
NEVER = 1 << 40


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed collection of public tokenizers keeps a file."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"/opt/tokenizers/{name}"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: printable bytes stand for
    themselves, the others follow from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class MergeAutomaton:
    """Token automaton of a byte-level vocabulary: ``states`` are the last tokens, arcs are labelled with tokens."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = tokens
        self.label = {i: t for t, i in tokens.items()}
        self.rule: dict[tuple[bytes, bytes], int] = {}
        #: Per token, its right and left spine: parts at its end (its beginning), each with the rank that ends its life.
        self.right: dict[bytes, list[tuple[bytes, int]]] = {}
        self.left: dict[bytes, list[tuple[bytes, int]]] = {}
        for b in range(256):
            one = bytes([b])
            self.right[one] = self.left[one] = [(one, NEVER)]
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, a, b)
        self.longest = max(map(len, tokens), default=1)
        self._arcs: dict[tuple[bytes, bytes], bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        #: For each beginning of some token: the lengths of the tokens that end there are found by walking it.
        self._begins = {t[:n] for t in tokens for n in range(1, len(t) + 1)}

    def _gadget(self, rank: int, a: bytes, b: bytes) -> None:
        made = a + b
        if made in self.right or a not in self.right or b not in self.right:
            self.rule.setdefault((a, b), rank)
            return
        self.rule[a, b] = rank
        self.right[made] = [(made, NEVER), (b, rank), *self.right[b][1:]]
        self.left[made] = [(made, NEVER), (a, rank), *self.left[a][1:]]

    def arc(self, state: bytes, token: bytes) -> bool:
        """Whether ``token`` may follow ``state``: no gadget has removed the arc."""
        known = self._arcs.get((state, token))
        if known is None:
            known = True
            for a, a_ends in self.right[state]:
                for b, b_ends in self.left[token]:
                    rank = self.rule.get((a, b))
                    # at equal rank the merge further left comes first
                    if rank is not None and rank < a_ends and rank <= b_ends:
                        known = False
            if len(self._arcs) > 4 * REMEMBERED:
                self._arcs.clear()
            self._arcs[state, token] = known
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of the one path that spells ``word``."""
        size = len(word)
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        last: list[bytes | None] = [None] * (size + 1)
        # forward over the bytes: from each reached end, all tokens that begin there and whose arc stands
        last[0] = b""
        begins, ids = self._begins, self.ids
        for at in range(size):
            state = last[at]
            if state is None:
                continue
            for end in range(at + 1, min(size, at + self.longest) + 1):
                token = word[at:end]
                if token not in begins:
                    break
                if token in ids and (last[end] is None) and (not state or self.arc(state, token)):
                    last[end] = token
        out, at = [], size
        while at:
            token = last[at]
            if token is None:
                raise ValueError("the vocabulary can't spell this word")
            out.append(ids[token])
            at -= len(token)
        return out[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, without special tokens; null and empty texts have none."""
        if not text:
            return []
        words = _SPLIT.findall(text)
        known = self._words
        try:
            return list(chain.from_iterable([known[w] for w in words]))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for word in set(words):
                if word not in known:
                    known[word] = tuple(self.encode_word(word.encode("utf-8", "surrogatepass")))
            return list(chain.from_iterable([known[w] for w in words]))

    def decode(self, ids: list[int]) -> str:
        """The text spelled by the labels of the arcs."""
        return b"".join(self.label[i] for i in ids).decode("utf-8", "replace")


_SPLIT = regex.compile(PATTERN)


def load_automaton(content: bytes) -> MergeAutomaton:
    """The automaton of a vocabulary file (JSON with ``model.vocab`` and ``model.merges``)."""
    model, letters = json.loads(content)["model"], byte_letters()

    def as_bytes(text: str) -> bytes:
        return bytes(letters[c] for c in text)

    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return MergeAutomaton({as_bytes(t): i for t, i in model["vocab"].items()}, [(as_bytes(a), as_bytes(b)) for a, b in merges])


_loaded: dict[int, MergeAutomaton] = {}


def _automaton(content: bytes) -> MergeAutomaton:
    """The automaton kept by this worker."""
    key = hash(content)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = load_automaton(content)
    return _loaded[key]


def encode_texts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids``: the token ids of each text. Null, empty: an empty list. The vocabulary file (of fixed,
    bounded size) is read by the driver and broadcast."""
    content = documents.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(content.value)
        for batch in _pieces(batches):
            ids = [automaton.encode(t) for t in batch.column("text").to_pylist()]
            ends = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(i) for i in ids], out=ends[1:])
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` of each text; null and empty texts have 0."""
    content = documents.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(content.value)
        for batch in _pieces(batches):
            sizes = pa.array([len(automaton.encode(t)) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes], names=["doc_id", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def round_trips(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``same``: whether decoding the ids gives the text again (null counts as empty)."""
    content = documents.sparkSession.sparkContext.broadcast(_read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(content.value)
        for batch in _pieces(batches):
            texts = batch.column("text").to_pylist()
            ids = [automaton.encode(t) for t in texts]
            same = [automaton.decode(i) == (t or "") for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), pa.array(same)], names=["doc_id", "n_tokens", "same"]
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, same boolean")


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, so that long texts don't add up."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def _read(path: str | None) -> bytes:
    with open(path or vocabulary_path(), "rb") as file:
        return file.read()
