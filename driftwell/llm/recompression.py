"""Substring deduplication by recompression.

Every word is a symbol.  In rounds, pairs of equal neighbours (runs) and then pairs of a left and a
right symbol get one name; which symbols are left and which are right follows from their names and
changes with the round.  A name depends on the words below it alone, so equal stretches of the
corpus get equal interior symbols wherever they stand, without any exchange for the naming.

Each round is limited to symbols of a few words, so how far the surroundings can reach into a
stretch is bounded: after all rounds, whether a symbol begins at some place depends on ``REACH``
words on either side.  The first such place at least ``REACH`` words into a window is its anchor;
``repeats`` finds and verifies what is repeated around shared anchors.

Runs longer than two equal words are left to the pair rounds, which never join equal symbols.

Defined cases: a null text has no words; texts shorter than a window stay whole; repeated rows are
documents of their own and so repeat each other's windows, whether or not they share an id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from driftwell.llm.repeats import CROWD, NO_ID, Scheme, covered, mark_of, prepared, repeated_spans

WINDOW = 35
# The longest symbol, in words, that each round of pairs may make.
ROUNDS = (2, 2, 4, 4, 8)


def _reach(rounds: tuple[int, ...]) -> int:
    """Words on either side that decide whether a symbol begins at a place."""
    reach = longest = 2  # the round of runs
    for limit in rounds:
        reach += min(longest, limit - 1)
        longest = max(longest, limit)
    return reach


REACH = _reach(ROUNDS)

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    """Hashes of words; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 17)
        return found


_WORDS = _Words()


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    name = (left * _K1) ^ (right + _K2)
    name ^= name >> np.uint64(32)
    name *= _K2
    return name ^ (name >> np.uint64(29))


def _is_left(names: np.ndarray, number: int) -> np.ndarray:
    mixed = (names ^ np.uint64((number + 1) * 0x632BE59BD9B4E019 % (1 << 64))) * _K1
    return (mixed >> np.uint64(63)).astype(bool)


def symbol_starts(words: np.ndarray, begins: np.ndarray, rounds: tuple[int, ...] = ROUNDS) -> np.ndarray:
    """Where symbols begin after all rounds; none reaches over one of ``begins``, where texts begin."""
    names, starts = words, np.arange(len(words))
    barrier = np.zeros(len(words) + 1, dtype=bool)
    barrier[begins] = True
    if len(words) < 2:
        return starts
    lengths = np.ones(len(words), dtype=np.int64)

    def merge(first: np.ndarray) -> None:
        nonlocal names, starts, lengths
        at = np.flatnonzero(first)
        if not len(at):
            return
        names, lengths = names.copy(), lengths.copy()
        names[at] = _joined(names[at], names[at + 1])
        lengths[at] += lengths[at + 1]
        kept = np.ones(len(names), dtype=bool)
        kept[at + 1] = False
        names, starts, lengths = names[kept], starts[kept], lengths[kept]

    equal = (names[1:] == names[:-1]) & ~barrier[starts[1:]]
    alone = np.concatenate(([True], ~equal[:-1])) & np.concatenate((~equal[1:], [True]))
    merge(equal & alone)
    for number, limit in enumerate(rounds):
        left = _is_left(names, number)
        merge(left[:-1] & ~left[1:] & (lengths[:-1] + lengths[1:] <= limit) & ~barrier[starts[1:]])
    return starts


class SharedSymbols(Scheme):
    earlier = False

    def __init__(self, window: int = WINDOW, rounds: tuple[int, ...] = ROUNDS, crowd: int = CROWD):
        self.window, self.rounds, self.crowd = window, rounds, crowd
        self.least = _reach(rounds)
        self.most = self.least + max(rounds) - 1
        if self.most + self.least > window:
            raise ValueError("the rounds reach too far for this window")

    def units(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))

    def anchors(self, units: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = symbol_starts(units, begins, self.rounds)
        place, before = starts[1:], starts[:-1]
        owner = np.searchsorted(ends, place, "right")
        begin, size = begins[owner], (ends - begins)[owner]
        low = np.maximum(self.least, place - begin - (size - self.window))
        high = np.minimum(self.least - 1 + place - before, place - begin)
        used = (low <= high) & (size >= self.window) & (place > begin)
        return place[used], low[used], high[used]


def repeated_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc, mark, spans`` of the rows that hold repeated windows; see ``repeats``."""
    return repeated_spans(prepared(docs, id_col, text_col), SharedSymbols(window))


def _cut(text: bytes, spans: np.ndarray | None, window: int) -> tuple[int, int, bytes]:
    words = text.split()
    if spans is None:
        return len(words), 0, b" ".join(words)
    gone = covered(spans, len(words), window)
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def remove_repeated_words(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, crowd: int = CROWD
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256`` of every row; kept words joined by a blank."""
    rows = prepared(docs, id_col, text_col)
    marked = rows.join(repeated_spans(rows, SharedSymbols(window, crowd=crowd)), ["doc", "mark"], "left")

    @F.pandas_udf("n_words long, n_removed long, kept string, kept_sha256 string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, spans):
            words, removed, kept = _cut(text, found, window)
            out.append((words, removed, kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "kept_sha256"])

    result = marked.select(F.expr(f"nullif(doc, {NO_ID})").alias("doc_id"), cut("text", "spans").alias("found"))
    return result.select("doc_id", "found.*")


def without_repeated_words(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None, window: int = WINDOW
) -> DataFrame:
    """``docs`` with repeated words taken out of the text; all rows and columns stay.

    Texts that lose nothing keep their line breaks.  ``size_col`` is set to the new number of
    characters.
    """
    rows = prepared(docs, id_col, text_col)
    marked = rows.join(repeated_words(docs, id_col=id_col, text_col=text_col, window=window), ["doc", "mark"], "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        pairs = zip(texts, found)
        return pd.Series([(t if s is None else _cut(t, s, window)[2]).decode("utf-8", "replace") for t, s in pairs], dtype=object)

    # The texts are dealt out by (doc, mark) once, in the form in which the search deals them out too;
    # rows with the same id and text share what is left of it.  The other columns follow without it.
    distinct = marked.groupBy("doc", "mark").agg(F.first("text").alias("text"), F.first("spans").alias("spans"))
    text = F.col(f"`{text_col}`")
    others = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"),
        mark_of(F.coalesce(text, F.lit(""))).alias("mark"),
        text.isNotNull().alias("given"),
        F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns if c != text_col], F.lit(0).alias("__")).alias("rest"),
    )
    new = F.when(F.col("given"), F.col("kept"))
    changed = {text_col: new} | ({size_col: F.char_length(new).cast(docs.schema[size_col].dataType)} if size_col else {})
    joined = others.join(distinct, ["doc", "mark"]).withColumn("kept", cut("text", "spans"))
    return joined.select(*[changed[c].alias(c) if c in changed else F.col("rest")[c].alias(c) for c in docs.columns])
