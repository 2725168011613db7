"""License scan: short notices, with bounded errors.

A notice that occurs with at most ``k`` edits has at least one of ``k + 1`` pieces of it unchanged,
so each notice is cut into that many pieces; every exact occurrence of a piece gives a window, and
the ``regex`` library's bounded-error matching decides in the window and says where the match lies.
A license is told from others by words that must stand as they are; the edits are in the others.

Texts are compared as words: lower-cased (A-Z only), joined by single spaces.

Defined cases: a null text counts as empty; an empty text has no match, a score of 0 and empty
labels.  Repeated documents give repeated rows; overlapping occurrences all count, but of several
notices with the same span only those with the fewest edits.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from driftwell.llm.common import id_and_text


@dataclass(frozen=True)
class Notice:
    """Words that stand for a license; ``edits`` is the largest number of character edits.

    ``telling`` is the word that tells it from other licenses: in a scan it must be unchanged.
    """

    words: str
    label: str
    edits: int
    exact: bool = False
    telling: str = ""


# The phrases that count wherever their words stand side by side.
BASE_NOTICES = (
    Notice("under the mit license", "mit", 0, True),
    Notice("apache license version 2", "apache-2", 0, True),
    Notice("cc by nc", "cc-by-nc", 0, True),
)
# Notices searched with errors.
FUZZY_NOTICES = (
    Notice("released under the mit license", "mit", 3, telling="mit"),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    Notice("licensed under the apache license version 2 0", "apache-2", 4, telling="2"),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 2, telling="nc"),
    Notice("licensed under the creative commons attribution noncommercial", "cc-by-nc", 6),
    Notice("licensed under the gnu general public license version 3", "gpl-3", 5, telling="3"),
    Notice("licensed under the gnu general public license version 2", "gpl-2", 5, telling="2"),
    Notice("redistribution and use in source and binary forms with or without modification", "bsd", 7),
    Notice("licensed under the mozilla public license version 2 0", "mpl-2", 5, telling="2"),
)

_DROPPED = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_BLANK = bytes.maketrans(_DROPPED, b" " * len(_DROPPED))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: ASCII letters and digits and everything outside ASCII."""
    return (text or "").encode("utf-8", "replace").lower().translate(_TO_BLANK).split()


def _starts(haystack: bytes, needle: bytes) -> list[int]:
    found, at = [], haystack.find(needle)
    while at >= 0:
        found.append(at)
        at = haystack.find(needle, at + 1)
    return found


def _word_numbers(line: bytes, places: Sequence[int]) -> dict[int, int]:
    """For each place of a blank the number of the word behind it; one pass over the line."""
    numbers, at, blanks = {}, 0, 0
    for place in sorted(set(places)):
        blanks += line.count(b" ", at, place)
        at = place
        numbers[place] = blanks
    return numbers


def _fuzzy(words: bytes, edits: int) -> bytes:
    return b"(?:" + regex.escape(words, special_only=True) + b"){e<=%d}" % edits


@lru_cache(maxsize=256)
def _prepared(notice: Notice, told: bool) -> tuple[tuple[tuple[int, bytes], ...], regex.Pattern]:
    """Pieces with their offsets, and the pattern that allows the edits, if ``told`` not in the telling word."""
    whole = notice.words.encode()
    bounds = [len(whole) * i // (notice.edits + 1) for i in range(notice.edits + 2)]
    pieces = tuple((a, whole[a:b]) for a, b in zip(bounds, bounds[1:]))
    pattern = _fuzzy(whole, notice.edits)
    if told and notice.telling:
        before, telling, after = (b" %b " % whole).partition(b" %b " % notice.telling.encode())
        fuzzy = [_fuzzy(x, notice.edits) if x else b"" for x in (before.strip(), after.strip())]
        pattern = fuzzy[0] + (telling if after else telling[:-1] + b"(?= )") + fuzzy[1]
    return pieces, regex.compile(b"(?b)" + pattern)


def fuzzy_spans(line: bytes, notice: Notice, told: bool = False) -> list[tuple[int, int, int]]:
    """``(start, end, edits)`` in bytes of the matches of one notice, from left to right."""
    pieces, pattern = _prepared(notice, told)
    size, slack = len(notice.words.encode()), notice.edits
    # The window of a seed holds every match the seed can be part of, and one more place, for the blank
    # behind a telling word.  Pieces of one match mostly give the same window.
    windows = {
        (max(0, at - offset - slack), min(at - offset + size + slack + 1, len(line))) for offset, piece in pieces for at in _starts(line, piece)
    }
    spans: list[tuple[int, int, int]] = []
    while windows:
        found: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for a, b in windows:
            match = pattern.search(line, a, b) if b - a >= size - slack and _possible(line[a:b], notice, told) else None
            if match and (edits := sum(match.fuzzy_counts)) <= slack:
                found.setdefault((edits, *match.span()), []).append((a, b))
        # Of matches that overlap the one with the fewest edits stays; the windows of the others are
        # searched again beside it, and become shorter each time.
        windows = set()
        for (edits, start, end), own in sorted(found.items()):
            at = bisect_left(spans, (start, end, 0))
            if (at and spans[at - 1][1] > start) or (at < len(spans) and spans[at][0] < end):
                windows |= {part for a, b in own for part in _beside(spans, a, b)}
            else:
                spans.insert(at, (start, end, edits))
    return spans


@lru_cache(maxsize=256)
def _letters(words: str) -> tuple[tuple[bytes, int], ...]:
    whole = words.encode()
    return tuple((bytes([c]), whole.count(c)) for c in sorted(set(whole), key=whole.count, reverse=True))


def _possible(window: bytes, notice: Notice, told: bool) -> bool:
    """False where the window lacks the telling word, or more letters of the notice than there may be edits."""
    if told and notice.telling and b" %b " % notice.telling.encode() not in b" %b " % window:
        return False
    lacking = 0
    for letter, wanted in _letters(notice.words):
        if (given := window.count(letter)) < wanted:
            lacking += wanted - given
            if lacking > notice.edits:
                return False
    return True


def _beside(spans: list[tuple[int, int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """What the spans, which are sorted and do not overlap, leave of a window."""
    parts, at = [], bisect_left(spans, (a, a, 0))
    if at and spans[at - 1][1] > a:
        at -= 1
    for start, end, _ in spans[at:]:
        if start >= b:
            break
        if a < start:
            parts.append((a, start))
        a = max(a, end)
    return [*parts, (a, b)] if a < b else parts


def scan_text(text: str | None, base: Sequence[Notice], fuzzy: Sequence[Notice]) -> tuple:
    """One row of ``license_scan`` without its id."""
    words = words_of(text)
    line = b" " + b" ".join(words) + b" "
    places: list[int] = []  # of the blanks before the matches
    base_labels: set[str] = set()
    best = 0.0
    for notice in base:
        at = _starts(line, b" " + notice.words.encode() + b" ")
        if at:
            places += at
            base_labels.add(notice.label)
            best = 1.0
    labels, spans = set(base_labels), []
    for notice in fuzzy:
        spans += [(a, b, edits, notice) for a, b, edits in fuzzy_spans(line, notice, told=True)]
    fewest: dict[tuple[int, int], int] = {}
    for a, b, edits, _ in spans:
        fewest[a, b] = min(edits, fewest.get((a, b), edits))
    spans = [x for x in spans if x[2] == fewest[x[:2]]]
    for _, _, edits, notice in spans:
        labels.add(notice.label)
        best = max(best, 1.0 - edits / len(notice.words))
    spans = [(a, b, edits, notice.label) for a, b, edits, notice in spans]
    first = {a: line.rfind(b" ", 0, a + 1) for a, *_ in spans}
    numbers = _word_numbers(line, [*places, *first.values()])
    return (
        len(words),
        len(places),
        numbers[min(places)] if places else None,
        numbers[max(places)] if places else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        best,
        [f"{label}@{numbers[first[a]]}:{edits}" for a, _, edits, label in sorted(set(spans))],
    )


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"


def license_scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Sequence[Notice] = BASE_NOTICES,
    fuzzy: Sequence[Notice] = FUZZY_NOTICES,
) -> DataFrame:
    """Per document its notices: exact places, labels and ``spans`` (``label@word:edits``)."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    @F.pandas_udf(COLUMNS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame([scan_text(t, base, fuzzy) for t in texts], columns=names)
        return found.astype({"first_word": "Int64", "last_word": "Int64"})

    rows = id_and_text(docs, id_col, text_col).select("doc_id", scan("text").alias("found"))
    return rows.select("doc_id", "found.*")
