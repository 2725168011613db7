"""Repeated windows of a corpus, found exactly from sampled places.

A scheme picks places ("anchors") in a text by content alone: every window of ``window`` units has
one anchor, at an offset between ``least`` and ``most`` from its start, and equal windows have
theirs at equal offsets.  What all windows of an anchor have in common is its key.  Then, in three
rounds, each a map over texts and an exchange of packed tuples by key:

1. anchors whose key occurs once are left out, or all keys of parts of their windows, where a scheme
   has such; an anchor may be found by several;
2. of the others, the whole stretch of windows around the anchor is compared at once;
3. where stretches share a key but differ, windows are compared one by one: those of a crowded key
   by their own hashes, those of other keys by what stands around the anchor.

A stretch is named by its key and a hash of its own, 96 bits and the target, a window by 128 bits.
Tuples travel as packed columns, one row for each task and target, since a row per tuple would cost
several times the bytes.  The texts are dealt out once; all joins with them use the same exchange.

Hot keys: what a map task can settle among its own tuples it does, and only two tuples (or those of
the smallest document) of a key or stretch go on to be compared; settled ones are dealt out evenly.
Where a key has more than ``crowd`` differing stretches in a pack of tuples, only two of them go to
the key's target, to tell it; the others are dealt out, and all windows of that key are compared
where their own hashes send them.  So a passage that stands in a third of all documents, among other
words each time, costs a comparing task a few tuples per pack.  The way taken never changes a result.
"""

from __future__ import annotations

import zlib
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from driftwell.llm.common import ship_package

NO_ID = (1 << 63) - 1
# Tuples that a map task packs at a time, and units that it looks at together.
PACK = 400_000
TOGETHER = 1 << 18
# Stretches of one key that a pack may send to the key's target.
CROWD = 256

# What a map task knows of a tuple.  The lower bit: dealt out evenly, not sent to its key's target;
# the upper one: its key is crowded.
LOOSE, SETTLED, TELLS, APART = range(4)

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mix(units: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each row of a matrix of bytes or of 64-bit numbers."""
    if units.dtype == np.uint8:
        short = -units.shape[1] % 8
        if short:
            units = np.pad(units, ((0, 0), (0, short)))
        units = np.ascontiguousarray(units).view(np.uint64)
    found = np.full(len(units), np.uint64(seed * 2 + 1) * _K3, dtype=np.uint64)
    for column in units.T:
        x = (column + _K3) * _K1
        x ^= x >> np.uint64(32)
        found = (found ^ x) * _K2
        found ^= found >> np.uint64(29)
    found *= _K1
    return found ^ (found >> np.uint64(32))


class _Powers:
    """Powers of an odd factor and of its inverse modulo ``2 ** 64``; kept up to a bounded length."""

    KEPT = 1 << 20

    def __init__(self, factor: int):
        self.factor, self.inverse = factor, pow(factor, -1, 1 << 64)
        self.kept = self._make(0)

    def _make(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for base in (self.factor, self.inverse):
            powers = np.ones(max(size, 1), dtype=np.uint64)
            powers[1:] = np.uint64(base)
            found.append(np.multiply.accumulate(powers))
        return tuple(found)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > self.KEPT:
            return self._make(size)
        if size > len(self.kept[0]):
            self.kept = self._make(min(self.KEPT, 2 * size))
        return self.kept


_POWERS = (_Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93))
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, (2, 256), dtype=np.uint64)


class Ranges:
    """64-bit hashes of ranges of units, from prefix sums; ``kind`` chooses one of two functions."""

    def __init__(self, units: np.ndarray, kind: int):
        if units.dtype == np.uint8:
            values = _BYTES[kind][units]
        else:
            values = (units ^ np.uint64(0xA0761D6478BD642F >> kind)) * _K2
            values ^= values >> np.uint64(32)
        powers, self.inverse = _POWERS[kind].upto(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(values * powers[: len(units)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        found = (self.sums[stop] - self.sums[start]) * self.inverse[start]
        found ^= found >> np.uint64(32)
        found *= _K1
        return found ^ (found >> np.uint64(29))


class Scheme(ABC):
    """How a text is read and where its anchors are; ``earlier`` is the rule for what is repeated.

    With ``earlier`` a window is repeated if it also starts in a document with a smaller id, else
    if it also starts at any other place.
    """

    window: int
    least: int
    most: int
    earlier: bool
    crowd: int = CROWD

    @abstractmethod
    def units(self, text: bytes) -> np.ndarray:
        """The text as bytes (uint8) or as hashes of words (uint64)."""

    @abstractmethod
    def anchors(self, units: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, and the smallest and largest offset of the windows that have them.

        ``units`` holds several texts, one after another; no window reaches from one to the next.
        """

    def contexts(self, units: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A row for each place with all units that its windows may cover."""
        right = self.window - self.least
        padded = np.concatenate((np.zeros(self.most, units.dtype), units, np.zeros(right, units.dtype)))
        return padded[places[:, None] + np.arange(self.most + right)]

    def keys(self, units: np.ndarray, places: np.ndarray) -> np.ndarray:
        return Ranges(units, 0).of(places - self.least, places - self.most + self.window)

    def parts(self, units: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of anchors, each once or more, and keys for the first round.

        Each window belongs to one of its anchor's keys, which follows from its units and offset.
        """
        return np.arange(len(places)), self.keys(units, places)

    def stretches(self, units: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        named = Ranges(units, 1).of(places - high, places - low + self.window)
        named = (named ^ (low << 8 | high).astype(np.uint64)) * _K3
        return named ^ (named >> np.uint64(31))


class _Texts:
    """A few texts side by side, as one array of units."""

    def __init__(self, scheme: Scheme, rows: list[tuple]):
        self.docs, self.marks = [r[0] for r in rows], [r[1] for r in rows]
        self.units = np.concatenate([r[2] for r in rows])
        sizes = np.array([len(r[2]) for r in rows], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.chosen = [r[3] for r in rows] if len(rows[0]) > 3 else None

    def owners(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """Owner and number of all that was asked for."""
        owner = np.repeat(np.arange(len(self.chosen)), [len(c) for c in self.chosen])
        return owner, np.concatenate([np.asarray(c, dtype=np.int64) for c in self.chosen])


def _in_texts(scheme: Scheme, batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[_Texts]:
    """Texts in groups of a bounded number of units, or single ones that are longer."""
    rows, size = [], 0
    for batch in batches:
        for doc, mark, text, *more in zip(*(batch.column(n).to_pylist() for n in columns)):
            units = scheme.units(text)
            if rows and size + len(units) > TOGETHER:
                yield _Texts(scheme, rows)
                rows, size = [], 0
            rows.append((doc, mark, units, *more))
            size += len(units)
        if rows:
            yield _Texts(scheme, rows)
            rows, size = [], 0


def _planes(values: np.ndarray) -> tuple[bytes, bytes]:
    """Lower and upper halves of 32-bit numbers; the upper ones compress to nothing."""
    wide = values.astype(np.uint32)
    return (wide & np.uint32(0xFFFF)).astype(np.uint16).tobytes(), (wide >> np.uint32(16)).astype(np.uint16).tobytes()


def _from_planes(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, np.uint16).astype(np.int64) | np.frombuffer(high, np.uint16).astype(np.int64) << 16


def _byte_planes(values: np.ndarray) -> bytes:
    """Ids by the bytes of each rank; most of the upper ones are alike and compress to nothing."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_byte_planes(stored: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(stored, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


class _Packer:
    """Gathers tuples of many documents, settles what it can and packs the tuples by target."""

    schema = pa.schema(
        [
            ("bucket", pa.int32()), ("docs", pa.binary()), ("marks", pa.binary()), ("owner_low", pa.binary()),
            ("owner_high", pa.binary()), ("place_low", pa.binary()), ("place_high", pa.binary()), ("keys", pa.binary()),
            ("rest", pa.binary()), ("offsets", pa.binary()), ("settled", pa.binary()), ("crowded", pa.binary()),
        ]
    )
    ddl = (
        "bucket int, docs binary, marks binary, owner_low binary, owner_high binary, place_low binary, place_high binary, "
        "keys binary, rest binary, offsets binary, settled binary, crowded binary"
    )

    def __init__(self, buckets: int, key_type: type, settle=None, compress: bool = False):
        self.buckets, self.key_type, self.settle, self.compress = buckets, key_type, settle, compress
        self.parts: list[tuple] = []
        self.docs: list[int] = []
        self.marks: list[int] = []
        self.size = 0

    def add(self, texts: _Texts, places: np.ndarray, keys: np.ndarray, rest: np.ndarray | None = None, offsets: np.ndarray | None = None) -> bool:
        """True when enough is gathered."""
        if len(places):
            owner = texts.owners(places)
            self.parts.append((owner + len(self.docs), places - texts.begins[owner], keys, rest, offsets))
            self.docs += texts.docs
            self.marks += texts.marks
            self.size += len(places)
        return self.size >= PACK

    def store(self, rest: np.ndarray) -> bytes:
        return zlib.compress(rest.tobytes(), 1) if self.compress else rest.tobytes()

    def pack(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        docs, marks = np.array(self.docs, dtype=np.int64), np.array(self.marks, dtype=np.int64)
        owners, places, keys = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        rest, offsets = (None if self.parts[0][i] is None else np.concatenate([p[i] for p in self.parts]) for i in (3, 4))
        self.parts, self.docs, self.marks, self.size = [], [], [], 0
        state = np.zeros(len(keys), dtype=np.uint8) if self.settle is None else self.settle(keys, rest, docs[owners])
        target = np.where(state & 1, owners.astype(np.uint64) * _K1 >> np.uint64(32), keys & np.uint64(0xFFFFFFFF))
        bucket = (target % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        rows = []
        for chosen in np.split(order, cuts):
            present, owner = np.unique(owners[chosen], return_inverse=True)
            stored = keys[chosen] if self.key_type is np.uint64 else (keys[chosen] >> np.uint64(32)).astype(self.key_type)
            rows.append(
                (
                    int(bucket[chosen[0]]), _byte_planes(docs[present]), marks[present].tobytes(), *_planes(owner),
                    *_planes(places[chosen]), stored.tobytes(), b"" if rest is None else self.store(rest[chosen]),
                    b"" if offsets is None else offsets[chosen].tobytes(),
                    np.packbits(state[chosen] & 1).tobytes(), np.packbits(state[chosen] >> 1).tobytes(),
                )
            )
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), self.schema.types)], schema=self.schema)


class _Tuples:
    """The packed tuples of one target, as arrays."""

    def __init__(self, rows: Iterable[dict], key_type: type, compressed: bool = False):
        parts: dict[str, list] = {n: [] for n in ("doc", "mark", "place", "key", "rest", "offset", "settled", "crowded")}
        for row in rows:
            owner = _from_planes(row["owner_low"], row["owner_high"])
            parts["doc"].append(_from_byte_planes(row["docs"])[owner])
            parts["mark"].append(np.frombuffer(row["marks"], np.int64)[owner])
            parts["place"].append(_from_planes(row["place_low"], row["place_high"]))
            parts["key"].append(np.frombuffer(row["keys"], key_type))
            parts["rest"].append(zlib.decompress(row["rest"]) if compressed else row["rest"])
            parts["offset"].append(np.frombuffer(row["offsets"], np.uint8))
            for name in ("settled", "crowded"):
                parts[name].append(np.unpackbits(np.frombuffer(row[name], np.uint8), count=len(owner)).astype(bool))
        self.empty = not parts["doc"]
        if not self.empty:
            self.doc, self.mark, self.place, self.key, offset, self.settled, self.crowded = (
                np.concatenate(parts[n]) for n in ("doc", "mark", "place", "key", "offset", "settled", "crowded")
            )
            self.rest = np.frombuffer(b"".join(parts["rest"]), np.uint8)
            self.low, self.high = offset.reshape(-1, 2).T.astype(np.int64) if len(offset) else (None, None)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _first_of_groups(*sorted_keys: np.ndarray) -> np.ndarray:
    """True at the first row of each group of equal keys."""
    first = np.ones(len(sorted_keys[0]), dtype=bool)
    first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return first


def _per_group(first: np.ndarray, values: np.ndarray, how) -> np.ndarray:
    """A reduction of each group, at every row of it."""
    return how.reduceat(values, np.flatnonzero(first))[np.cumsum(first) - 1]


def _beyond_two(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True, in the original order, at the third and later rows of each group."""
    number = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    found = np.zeros(len(order), dtype=bool)
    found[order[number > 1]] = True
    return found


def _settle_equals(scheme: Scheme, keys: np.ndarray, rest: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Tuples equal in key and rest are repeated; the smallest document or two of them go on."""
    order = np.lexsort((docs, rest, keys))
    first = _first_of_groups(keys[order], rest[order])
    if not scheme.earlier:
        return _beyond_two(order, first).astype(np.uint8)
    state = np.zeros(len(order), dtype=np.uint8)
    state[order] = docs[order] > _per_group(first, docs[order], np.minimum)
    return state


def _repeated(scheme: Scheme, first: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which rows are repeated, of groups of equal ones sorted by document."""
    if scheme.earlier:
        return docs > _per_group(first, docs, np.minimum)
    return _per_group(first, np.ones(len(docs), np.int64), np.add) > 1


def settle_stretches(scheme: Scheme, keys: np.ndarray, whole: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Stretches that a task sees repeated are; of a crowded key two different ones tell its target.

    The others of that key stay open without having met; whatever equals them stays open too,
    since its target knows of two different stretches.
    """
    state = _settle_equals(scheme, keys, whole, docs)
    loose = np.flatnonzero(state == LOOSE)
    loose = loose[np.lexsort((whole[loose], keys[loose]))]
    if len(loose):
        first = _first_of_groups(keys[loose])
        different = _per_group(first, _first_of_groups(keys[loose], whole[loose]).astype(np.int64), np.add)
        crowded = different > scheme.crowd
        last = np.concatenate((first[1:], [True]))
        state[loose[crowded]] = APART
        state[loose[crowded & (first | last)]] = TELLS
    return state


def _first_round(scheme: Scheme, rows: DataFrame, buckets: int) -> DataFrame:
    """``doc, mark, place`` of the anchors whose key also occurs elsewhere."""

    def settle(keys: np.ndarray, rest: None, docs: np.ndarray) -> np.ndarray:
        """Keys that a task sees twice are shared, for all; two tuples say so to other tasks."""
        order = np.lexsort((docs, keys)) if scheme.earlier else np.argsort(keys, kind="stable")
        first = _first_of_groups(keys[order])
        if not scheme.earlier:
            return _beyond_two(order, first).astype(np.uint8)
        doc = docs[order]
        least, most = _per_group(first, doc, np.minimum), _per_group(first, doc, np.maximum)
        last = np.concatenate((first[1:], [True]))
        state = np.zeros(len(order), dtype=np.uint8)
        state[order[(least < most) & ~first & ~last]] = SETTLED
        return state

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets, np.uint32, settle)
        for texts in _in_texts(scheme, batches, ("doc", "mark", "text")):
            places, low, high = scheme.anchors(texts.units, texts.begins, texts.ends)
            number, keys = scheme.parts(texts.units, places, low, high)
            if packer.add(texts, places[number], keys):
                yield from packer.pack()
        yield from packer.pack()

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tuples = _Tuples(_packed(batches), np.uint32)
        if tuples.empty:
            return
        loose = np.flatnonzero(~tuples.settled)
        order = loose[np.argsort(tuples.key[loose], kind="stable")]
        kept = [np.flatnonzero(tuples.settled)]
        if len(order):
            first = _first_of_groups(tuples.key[order])
            if scheme.earlier:
                doc = tuples.doc[order]
                kept.append(order[_per_group(first, doc, np.minimum) < _per_group(first, doc, np.maximum)])
            else:
                kept.append(order[_per_group(first, np.ones(len(order), np.int64), np.add) > 1])
        kept = np.concatenate(kept)
        for at in range(0, len(kept), PACK):
            part = kept[at : at + PACK]
            yield pa.RecordBatch.from_pydict({"doc": tuples.doc[part], "mark": tuples.mark[part], "place": tuples.place[part]})

    packed = rows.mapInArrow(emit, _Packer.ddl)
    return packed.repartitionById(buckets, "bucket").mapInArrow(shared, "doc long, mark long, place long")


_FOUND = "doc long, mark long, place long, low int, high int, repeated boolean, open boolean, crowded boolean"


def _second_round(scheme: Scheme, asked: DataFrame, buckets: int) -> DataFrame:
    """``_FOUND`` of the anchors in ``asked`` (``doc, mark, text, places``).

    ``repeated``: all windows of the anchor are; ``open``: they must be looked at one by one;
    ``crowded``: by their own hashes, as all open windows of that key.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets, np.uint32, lambda *columns: settle_stretches(scheme, *columns))
        for texts in _in_texts(scheme, batches, ("doc", "mark", "text", "places")):
            places, low, high = scheme.anchors(texts.units, texts.begins, texts.ends)
            owner, asked = texts.wanted()
            chosen = np.isin(places, texts.begins[owner] + asked)
            places, low, high = places[chosen], low[chosen], high[chosen]
            whole = scheme.stretches(texts.units, places, low, high)
            offsets = np.stack([low, high], axis=1).astype(np.uint8)
            if packer.add(texts, places, scheme.keys(texts.units, places), whole, offsets):
                yield from packer.pack()
        yield from packer.pack()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tuples = _Tuples(_packed(batches), np.uint32)
        if tuples.empty:
            return
        repeated, open_ = tuples.settled & ~tuples.crowded, tuples.settled & tuples.crowded
        crowded = open_.copy()
        loose = np.flatnonzero(~tuples.settled)
        if len(loose):
            whole = tuples.rest.view(np.uint64)[loose]
            order = np.lexsort((tuples.doc[loose], whole, tuples.key[loose]))
            whole, order = whole[order], loose[order]
            doc, key = tuples.doc[order], tuples.key[order]
            of_key, of_whole = _first_of_groups(key), _first_of_groups(key, whole)
            several = _per_group(of_key, of_whole.astype(np.int64), np.add) > 1
            repeated[order] = _repeated(scheme, of_whole, doc)
            open_[order] = several & (~repeated[order] if scheme.earlier else of_whole)
            crowded[order] = _per_group(of_key, tuples.crowded[order], np.logical_or)
        kept = np.flatnonzero(repeated | open_)
        for at in range(0, len(kept), PACK):
            part = kept[at : at + PACK]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": tuples.doc[part], "mark": tuples.mark[part], "place": tuples.place[part],
                    "low": tuples.low[part].astype(np.int32), "high": tuples.high[part].astype(np.int32),
                    "repeated": repeated[part], "open": open_[part], "crowded": crowded[part],
                }
            )

    return asked.mapInArrow(emit, _Packer.ddl).repartitionById(buckets, "bucket").mapInArrow(compare, _FOUND)


def _third_round(scheme: Scheme, asked: DataFrame, buckets: int, kind: type) -> DataFrame:
    """``doc, mark, span`` of repeated windows among the open anchors (``doc, mark, text, places``)."""
    width = scheme.most + scheme.window - scheme.least

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets, np.uint64, compress=True)
        apart = _Packer(buckets, np.uint64, lambda *columns: _settle_equals(scheme, *columns))
        for texts in _in_texts(scheme, batches, ("doc", "mark", "text", "places")):
            owner, codes = texts.wanted()
            places = texts.begins[owner] + (codes >> 17)
            low, high, crowded = codes >> 8 & 255, codes & 255, (codes >> 16 & 1).astype(bool)
            # Texts that share an id and a mark are asked for each other's places.
            inside = (places - high >= texts.begins[owner]) & (places - low + scheme.window <= texts.ends[owner])
            usual, others = np.flatnonzero(inside & ~crowded), np.flatnonzero(inside & crowded)
            for at in range(0, len(usual), PACK // 8):
                part = usual[at : at + PACK // 8]
                offsets = np.stack([low[part], high[part]], axis=1).astype(np.uint8)
                keys, contexts = scheme.keys(texts.units, places[part]), scheme.contexts(texts.units, places[part])
                if packer.add(texts, places[part], keys, contexts, offsets):
                    yield from packer.pack()
            for at in range(0, len(others), PACK // 128):
                part = others[at : at + PACK // 128]
                sizes = high[part] - low[part] + 1
                number = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                starts = np.repeat(places[part] - high[part], sizes) + number
                windows = texts.units[starts[:, None] + np.arange(scheme.window)]
                if apart.add(texts, starts, mix(windows, 4), mix(windows, 5)):
                    yield from apart.pack()
        yield from packer.pack()
        yield from apart.pack()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Windows that came by their own hashes have no offsets.
        usual, apart = [], []
        for row in _packed(batches):
            (usual if row["offsets"] else apart).append(row)
        yield from by_offset(_Tuples(usual, np.uint64, compressed=True))
        yield from by_hash(_Tuples(apart, np.uint64))

    def spans(doc: np.ndarray, mark: np.ndarray, begin: np.ndarray, more: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(doc), PACK):
            part = slice(at, at + PACK)
            yield pa.RecordBatch.from_pydict({"doc": doc[part], "mark": mark[part], "span": begin[part] << 8 | more[part]})

    def by_hash(tuples: _Tuples) -> Iterator[pa.RecordBatch]:
        if tuples.empty:
            return
        two = tuples.rest.view(np.uint64)
        repeated = tuples.settled.copy()
        loose = np.flatnonzero(~repeated)
        if len(loose):
            order = loose[np.lexsort((tuples.doc[loose], two[loose], tuples.key[loose]))]
            repeated[order] = _repeated(scheme, _first_of_groups(tuples.key[order], two[order]), tuples.doc[order])
        found = np.flatnonzero(repeated)
        yield from spans(tuples.doc[found], tuples.mark[found], tuples.place[found], np.zeros(len(found), np.int64))

    def by_offset(tuples: _Tuples) -> Iterator[pa.RecordBatch]:
        if tuples.empty:
            return
        contexts = tuples.rest.view(kind).reshape(-1, width)
        flags = np.zeros((len(contexts), scheme.most + 2), dtype=bool)
        for offset in range(scheme.least, scheme.most + 1):
            chosen = np.flatnonzero((tuples.low <= offset) & (tuples.high >= offset))
            if not len(chosen):
                continue
            at = scheme.most - offset
            windows = contexts[chosen, at : at + scheme.window]
            one, two, doc = mix(windows, 4), mix(windows, 5), tuples.doc[chosen]
            order = np.lexsort((doc, two, one))
            first, doc = _first_of_groups(one[order], two[order]), doc[order]
            flags[chosen[order], offset] = _repeated(scheme, first, doc)
        # Runs of neighbouring offsets make one span.
        edges = np.diff(flags.astype(np.int8), axis=1, prepend=0)
        row, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        yield from spans(tuples.doc[row], tuples.mark[row], tuples.place[row] - (end - 1), end - 1 - begin)

    packed = asked.mapInArrow(emit, _Packer.ddl)
    return packed.repartitionById(buckets, "bucket").mapInArrow(compare, "doc long, mark long, span long")


def mark_of(text: Column) -> Column:
    """A hash that tells texts of one id apart; never null, so joins on it add no filter.

    All 64 bits: rows without an id share one, and spans are joined back by id and mark.
    """
    return F.xxhash64(text)


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, mark, text`` for this job: no nulls, and rows that share an id told apart by their text.

    A missing id counts as larger than all others.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"),
        mark_of(text).alias("mark"),
        text.cast("binary").alias("text"),
    )


def repeated_spans(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """``doc, mark, spans`` for ``prepared`` rows that hold repeated windows.

    ``spans`` lists runs of windows in any order, each the first start shifted by 8 bits and the
    number of further starts; it is bounded by the text it belongs to.
    """
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = scheme.units(b"").dtype.type
    same = ["doc", "mark"]
    wanted = _first_round(scheme, rows, buckets).groupBy(*same).agg(F.collect_list(F.col("place").cast("int")).alias("places"))
    found = _second_round(scheme, rows.join(wanted, same), buckets)
    reach = (F.col("high") - F.col("low")).cast("long")
    whole = found.where("repeated").select(
        *same, F.shiftleft(F.col("place") - F.col("high"), 8).bitwiseOR(reach).alias("span")
    )
    code = F.shiftleft("place", 17).bitwiseOR(F.shiftleft(F.col("crowded").cast("long"), 16))
    code = code.bitwiseOR(F.shiftleft("low", 8)).bitwiseOR(F.col("high")).alias("code")
    unsettled = found.where("open").select(*same, code).groupBy(*same).agg(F.collect_list("code").alias("places"))
    single = _third_round(scheme, rows.join(unsettled, same), buckets, kind)
    spans = whole.unionAll(single)
    return spans.groupBy(*same).agg(F.collect_list("span").alias("spans"))


def covered(spans: np.ndarray, size: int, window: int) -> np.ndarray:
    """True at the units of a text that lie in a span."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, spans >> 8, 1)
    np.add.at(steps, (spans >> 8) + (spans & 255) + window, -1)
    return np.cumsum(steps[:-1]) > 0
