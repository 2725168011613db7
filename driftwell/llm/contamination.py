"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, units after a number, and names are typed placeholders, all other
words stand as they are, in lower case.  Windows of the templates meet in a hash join, and so do
windows of the plain lower-cased words, which find unchanged text in any case.  Along each alignment
of a document with an item the values behind the placeholders must map one to one, so a question
asked again with other numbers or names is found, and a chance meeting of templates is not.  Where
they do not, only windows with unchanged values count.  An item leaks where enough of its windows
are covered.

A name is a word in title case inside a sentence.  Wherever it stands, in any case, a word is one
too if the items have it in title case inside sentences more often than in lower case, or only ever
at the beginning of sentences.  Any other word in title case that begins a sentence is one if no
item has it in lower case, or if the same text has it inside a sentence and never in lower case.

Defined cases: null and empty texts match nothing.  Items shorter than a window are matched whole;
below ``LEAST`` words nothing is matched.  Where most of a window is placeholders only its plain
words count.  Repeated documents and items give one row per pair of ids; rows with a null id are
matched one by one.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from driftwell.llm.common import id_and_text, staged

WINDOW = 8
LEAST = 5
COVERAGE = 0.5
# Up to this many item windows are sent along as a filter ahead of the join; it drops no match.
FILTER_WINDOWS = 2_000_000
# Raw words that a Python worker remembers.
KEPT_WORDS = 300_000

# Words that are a unit when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds "
    "oz ounce ounces ml l liter liters litre litres meter meters metre metres s sec second seconds min minute minutes h hour "
    "hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees mph kmh"
).split()

# Words that begin sentences without being names, also where no item has them in lower case.
COMMON = (
    "a after all an and any are as at be because before both but by can could did do does during each either every few find "
    "first five for four from give given had has have he her here his how if in into is it its last let many may more most "
    "much must my next no not now of on one only or other our she should show since so some such suppose that the their then "
    "there these they this those three to two until we were what when where whether which while who whose why will with would "
    "you your"
).split()

_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(%|st|nd|rd|th|[a-zA-Z]{1,3})?")
_EDGES = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
_LITERAL, _NUM, _UNIT, _NAME = range(4)
_PLACEHOLDERS = np.array([0, 0x9AE16A3B2F90404F, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273], dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))


class _Vocabulary(dict):
    """The number of a raw word, under which ``hashes`` and ``flags`` have what it is.

    Flags: number 1, unit 2, title case 4, sentence end 8, dropped 16, name by the items 32, in lower
    case in an item 64, lower case 128.
    """

    def __init__(self, names: frozenset[int] = frozenset(), common: frozenset[int] = frozenset()):
        super().__init__()
        self.names, self.common = names, common
        # Number 0 is no word's, so there is always something to read.
        self.hashes, self.flags = array("Q", [0]), array("q", [0])

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hash and flags of each word.  Words are forgotten between calls only, so numbers hold."""
        if len(self) >= KEPT_WORDS:
            self.clear()
            del self.hashes[1:], self.flags[1:]
        numbers = np.array([*map(self.__getitem__, words)], dtype=np.int64)
        return np.frombuffer(self.hashes, np.uint64)[numbers], np.frombuffer(self.flags, np.int64)[numbers]

    def __missing__(self, raw: str) -> int:
        # Most words are letters only, perhaps with a mark behind them: the patterns are for the rest.
        if raw.isalpha():
            core, flags, letters = raw, 0, True
        elif raw[-1] in ",.;:!?" and raw[:-1].isalpha():
            core, flags, letters = raw[:-1], 8 * (raw[-1] in ".!?"), True
        else:
            core = raw if raw.isalnum() else raw[:-1] if raw[:-1].isalnum() and raw[-1] in ",.;:!?" else _EDGES.sub("", raw)
            flags = 8 if not raw[-1].isalnum() and raw.rstrip("\"')]}»”’")[-1:] in tuple(".!?") else 0
            letters = core.isalpha()
        lower = core.lower()
        hashed = _hash(lower)
        if not letters and not core.isalnum() and not any(c.isalnum() for c in core):
            flags |= 16
        elif not letters and _NUMBER.fullmatch(core):
            flags |= 1
        else:
            flags |= 2 * (lower in _UNIT_SET) | 4 * (len(core) > 1 and core.istitle()) | 128 * (core == lower)
            flags |= 32 * (hashed in self.names) | 64 * (hashed in self.common)
        number = len(self.hashes)
        self.hashes.append(hashed)
        self.flags.append(flags)
        self[raw] = number
        return number


_UNIT_SET = frozenset(UNITS)
_COMMON_SET = frozenset(map(_hash, COMMON))


# Kept by a Python worker from task to task, for the items last asked about.
_VOCABULARIES: dict[str, _Vocabulary] = {}


@dataclass(frozen=True)
class Words:
    """What the items say about words: sorted hashes of names, and of words in lower case."""

    names: np.ndarray
    common: np.ndarray

    def vocabulary(self) -> _Vocabulary:
        key = xxhash.xxh128_hexdigest(self.names.tobytes() + b"|" + self.common.tobytes())
        if key not in _VOCABULARIES:
            _VOCABULARIES.clear()
            _VOCABULARIES[key] = _Vocabulary(frozenset(self.names.tolist()), frozenset(self.common.tolist()))
        return _VOCABULARIES[key]


class Template:
    """The canonical form of one text."""

    def __init__(self, text: str | None, vocabulary: _Vocabulary):
        raw = (text or "").split()
        hashes, flags = vocabulary.of(raw)
        ends = (flags & 8) > 0
        # A sentence begins behind an end mark, also one that stands alone.
        begins = np.concatenate(([True], ends[:-1]))[: len(ends)]
        kept = np.flatnonzero((flags & 16) == 0)
        flags, begins, hashes = flags[kept], begins[kept], hashes[kept]
        number = (flags & 1) > 0
        after_number = np.concatenate(([False], number[:-1]))[: len(number)]
        title = (flags & 4) > 0
        self.title, self.begins, self.lower = title, begins, (flags & 128) > 0
        name = (title & ~begins) | ((flags & 32) > 0) | (title & ((flags & 64) == 0))
        unsure = np.flatnonzero(title & begins & ~name)
        if len(unsure):
            own = set(hashes[title & ~begins].tolist()).intersection(hashes[unsure].tolist())
            own = [h for h in own if not self.lower[hashes == np.uint64(h)].any()]
            if own:
                name[unsure] = np.isin(hashes[unsure], np.array(own, dtype=np.uint64))
        self.kinds = np.zeros(len(kept), dtype=np.int64)
        self.kinds[name] = _NAME
        self.kinds[((flags & 2) > 0) & after_number] = _UNIT
        self.kinds[number] = _NUM
        self.plain = hashes
        self.hashes = np.where(self.kinds > 0, _PLACEHOLDERS[self.kinds], hashes)
        self.raw, self.kept = raw, kept

    def __len__(self) -> int:
        return len(self.kinds)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all windows, which have enough words of their own, plain hashes, and which differ."""
        count = len(self) - size + 1
        if count <= 0:
            none, no = np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
            return none, no, none, no
        literal = np.concatenate(([0], np.cumsum(self.kinds == _LITERAL)))
        own = literal[size:] - literal[:-size]
        plain = _window_hashes(self.plain, size, count)
        mixed = own < size
        typed = _window_hashes(self.hashes, size, count) if mixed.any() else plain
        return typed, 2 * own >= size, plain, mixed

    def slots(self, at: int, size: int) -> list[str]:
        """``place:value`` of the placeholders in a window, counted from its start."""
        places = np.flatnonzero(self.kinds[at : at + size]) + at
        return [f"{p - at}:{_EDGES.sub('', self.raw[self.kept[p]]).lower()}" for p in places]

    def keys(self, size: int, chosen) -> Iterator[tuple[int, int, list[str]]]:
        """``at, window, slots``: as template where usable, and as plain words, which have no slots."""
        typed, usable, plain, mixed = self.windows(size)
        # Without placeholders both are the same.
        for hashes, wanted, slotted in ((typed, usable, True), (plain, mixed, False)):
            places = chosen(hashes, np.flatnonzero(wanted))
            for at, window in zip(places.tolist(), hashes[places].view(np.int64).tolist()):
                yield at, window, self.slots(at, size) if slotted else []


def _window_hashes(words: np.ndarray, size: int, count: int) -> np.ndarray:
    total = np.full(count, np.uint64(size), dtype=np.uint64)
    for i in range(size):
        total = (total ^ words[i : i + count]) * _FACTOR
        total ^= total >> np.uint64(29)
    return total


def _words_of_items(items: DataFrame) -> Words:
    """Counted over all items; as large as their vocabulary, of which only hashes come here."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _Vocabulary()
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"]:
                t = Template(text, vocabulary)
                for kind, where in (("inside", t.title & ~t.begins), ("first", t.title & t.begins), ("lower", t.lower)):
                    seen.update((kind, h) for h in t.plain[where].view(np.int64).tolist())
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "word", "n"])

    counts = items.mapInPandas(emit, "kind string, word long, n long").groupBy("word")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(kind)
    name = (F.col("inside") > F.col("lower")) | ((F.col("first") > 0) & (F.col("lower") == 0))
    counts = counts.agg(of("inside"), of("first"), of("lower")).select("word", name.alias("name"), (F.col("lower") > 0).alias("lower"))
    found = [(r[0] % (1 << 64), r[1], r[2]) for r in counts.where("name OR lower").collect()]
    names = {w for w, name, _ in found if name} - _COMMON_SET
    common = {w for w, _, lower in found if lower} | _COMMON_SET
    return Words(*(np.array(sorted(x), dtype=np.uint64) for x in (names, common)))


def _window_rows(docs: DataFrame, sizes: list[int], chosen: np.ndarray | None, words: Words) -> DataFrame:
    """``row, doc_id, at, window, slots`` of each window, or of the chosen ones."""
    table = None
    if chosen is not None:
        table = np.zeros(1 << 20, dtype=bool)
        table[(chosen >> np.uint64(44)).astype(np.int64)] = True

    def among(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        if chosen is None or not len(places):
            return places
        places = places[table[(hashes[places] >> np.uint64(44)).astype(np.int64)]]
        near = np.minimum(np.searchsorted(chosen, hashes[places]), len(chosen) - 1)
        return places[chosen[near] == hashes[places]]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = words.vocabulary()
        for batch in batches:
            out = []
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                template = Template(text, vocabulary)
                known = None if pd.isna(doc_id) else int(doc_id)
                for size in sizes:
                    out += [(row, known, *key) for key in template.keys(size, among)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})
                    out = []
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    columns = ["row", "doc_id", "at", "window", "slots"]
    return docs.mapInPandas(emit, "row long, doc_id long, at int, window long, slots array<string>")


def _item_windows(items: DataFrame, window: int, least: int, words: Words) -> DataFrame:
    """``item, item_id, item_at, window, item_slots, usable, size, of, of_usable``.

    ``usable``: the window has enough words of its own; ``of`` and ``of_usable`` are the numbers of
    windows and of usable ones.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = words.vocabulary()
        for batch in batches:
            out = []
            for item, item_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                template = Template(text, vocabulary)
                size = min(window, len(template))
                if size < least:
                    continue
                usable = template.windows(size)[1]
                known = None if pd.isna(item_id) else int(item_id)
                for at, hashed, slots in template.keys(size, lambda _, places: places):
                    out.append((item, known, at, hashed, slots, bool(usable[at]), size, len(usable), int(usable.sum())))
            yield pd.DataFrame(out, columns=columns).astype({"item_id": "Int64"})

    columns = ["item", "item_id", "item_at", "window", "item_slots", "usable", "size", "of", "of_usable"]
    schema = "item long, item_id long, item_at int, window long, item_slots array<string>, usable boolean, size int, of int, of_usable int"
    return items.mapInPandas(emit, schema)


def _numbered(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a number of their own: repeated or missing ids must not mix documents."""
    named = id_and_text(rows, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return named.withColumn("row", F.monotonically_increasing_id())


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    least: int = LEAST,
    coverage: float = COVERAGE,
    filter_windows: int = FILTER_WINDOWS,
) -> DataFrame:
    """``doc_id, item_id, windows, item_windows, coverage, slots_changed`` of each leaked item."""
    numbered = _numbered(benchmark, item_col, item_text_col)
    words = _words_of_items(numbered)
    items = staged(_item_windows(numbered, window, least, words), "item-windows")
    # Few: a size is at most the window.
    sizes = [r[0] for r in items.select("size").distinct().orderBy("size").collect()] or [window]
    distinct = items.select("window").distinct()
    chosen = None
    if distinct.count() <= filter_windows:
        chosen = np.sort(np.array([r[0] for r in distinct.collect()], dtype=np.int64).view(np.uint64))
        if not len(chosen):
            chosen = np.array([0], dtype=np.uint64)
    met = _window_rows(_numbered(docs, id_col, text_col), sizes, chosen, words).join(items, "window")
    pair = ["row", "doc_id", "item", "item_id", "of", "of_usable"]
    aligned = met.withColumn("along", F.col("at") - F.col("item_at"))
    # Pairs of values behind the same placeholder, within one alignment.
    values = F.zip_with("item_slots", "slots", lambda a, b: F.struct(F.split(a, ":", 2)[1].alias("theirs"), F.split(b, ":", 2)[1].alias("ours")))
    place = F.struct("item_at", "usable")
    runs = aligned.groupBy(*pair, "along").agg(
        F.collect_set(place).alias("covered"),
        F.collect_set(F.when(F.col("slots") == F.col("item_slots"), place)).alias("unchanged"),
        F.array_distinct(F.flatten(F.collect_set(values))).alias("values")
    )
    theirs, ours = F.transform("values", lambda v: v["theirs"]), F.transform("values", lambda v: v["ours"])
    consistent = (F.size(F.array_distinct(theirs)) == F.size("values")) & (F.size(F.array_distinct(ours)) == F.size("values"))
    changed = F.size(F.filter("values", lambda v: v["theirs"] != v["ours"]))

    def share(windows: str, of: str) -> Column:
        full = F.struct((F.col(windows) / F.col(of)).alias("coverage"), F.col(windows).alias("windows"), F.col(of).cast("long").alias("item_windows"))
        return F.when(F.col(of) > 0, full)

    leaks = (
        runs.select(
            *pair,
            F.explode(F.when(consistent, F.col("covered")).otherwise(F.col("unchanged"))).alias("place"),
            F.when(consistent, changed).otherwise(0).alias("changed"),
        )
        .groupBy(*pair, "place")
        .agg(F.max("changed").alias("changed"))
        .groupBy(*pair)
        .agg(F.count("*").alias("all"), F.count_if("place.usable").alias("usable"), F.max("changed").alias("slots_changed"))
        # Enough of the usable windows, or of all.
        .withColumn("share", F.greatest(share("usable", "of_usable"), share("all", "of")))
        .where(F.col("share.coverage") >= coverage)
    )
    best = leaks.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("share.coverage", "share.windows", "share.item_windows", "slots_changed")).alias("best")
    )
    return best.select("doc_id", "item_id", "best.windows", "best.item_windows", "best.coverage", "best.slots_changed")
