"""Aggregation by a caller's own zero, sequence and combine functions.

``fold_by_key`` keeps one state per key in each task, folds the values in as they arrive in Arrow
batches, and sends on binary states only, one for each (task, key).  States meet in two levels, first
by (key, bucket), then by key, and are combined one after the other as a sorted stream, so a task
never holds more than one state of a key and a key that most rows share costs a state a task.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

# States of one key meet in so many places before they meet in one.
BUCKETS = 64
# A task with more open keys than this sends its states on and begins anew.
OPEN_KEYS = 50_000
# Rows and bytes that are put together, so that a key is folded once for many of its rows.
TOGETHER_ROWS, TOGETHER_BYTES = 100_000, 1 << 25
# Rows, and bytes of states, that a merging task hands back at a time.
OUTPUT_ROWS, OUTPUT_BYTES = 1_000, 1 << 23
# Key types whose text stands for the value and nothing else.
KEY_TYPES = ("string", "byte", "short", "integer", "long", "boolean", "date", "decimal")
# Value types whose values may be of any size unseen; their batches are taken as they come.
NESTED_TYPES = ("array", "map", "struct", "variant")


@dataclass(frozen=True)
class Fold:
    """``seq(state, values)`` folds a batch, a frame with one row for each value, into a state.

    ``comb(a, b)`` merges two states, and merging the zero changes nothing; the result must not
    depend on the order in which values and states meet.  ``finish(state)`` gives the output values
    in the order of ``schema``.  A function may change the state it is given and return it.

    ``seq_keys(codes, n, values)``, where given, folds the rows of many keys at once: a fresh state
    for each of the keys ``0 .. n - 1``, of which ``codes`` has each row's, as ``seq`` makes of zero.
    """

    zero: Callable[[], Any]
    seq: Callable[[Any, pd.DataFrame], Any]
    comb: Callable[[Any, Any], Any]
    finish: Callable[[Any], tuple]
    schema: str
    dump: Callable[[Any], bytes] = pickle.dumps
    load: Callable[[bytes], Any] = pickle.loads
    seq_keys: Callable[[np.ndarray, int, pd.DataFrame], list] | None = None


@dataclass(frozen=True)
class each:
    """A function of a state and one row's values as one that folds a batch."""

    one: Callable[..., Any]

    def __call__(self, state: Any, values: pd.DataFrame) -> Any:
        for row in values.itertuples(index=False, name=None):
            state = self.one(state, *row)
        return state


def _together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of the same types put together, up to a bounded size."""
    held: list[pd.DataFrame] = []
    rows = size = 0
    for batch in batches:
        if held and (rows + len(batch) > TOGETHER_ROWS or size > TOGETHER_BYTES or not batch.dtypes.equals(held[0].dtypes)):
            yield pd.concat(held, ignore_index=True)
            held, rows, size = [], 0, 0
        held.append(batch)
        rows += len(batch)
        size += int(batch.memory_usage(deep=True).sum())
    if held:
        yield pd.concat(held, ignore_index=True)


def _fold_in(fold: Fold, states: dict[str, Any], batch: pd.DataFrame) -> None:
    """Folds a batch with the column ``key`` into the states of its keys.

    Keys may be as many as rows, so nothing but the fold's own functions is called once for a key,
    unless the fold knows whole frames only.
    """
    given = batch.drop(columns="key")
    if isinstance(fold.seq, each):
        one = fold.seq.one
        for name, row in zip(batch["key"].tolist(), zip(*(given.iloc[:, i].tolist() for i in range(given.shape[1])))):
            states[name] = one(states[name] if name in states else fold.zero(), *row)
        return
    codes, names = pd.factorize(batch["key"])
    if fold.seq_keys is not None:
        for name, fresh in zip(names, fold.seq_keys(codes, len(names), given)):
            states[name] = fold.comb(states[name], fresh) if name in states else fresh
        return
    given = given.iloc[np.argsort(codes, kind="stable")]
    ends = np.cumsum(np.bincount(codes, minlength=len(names))).tolist()
    for name, start, end in zip(names, [0, *ends[:-1]], ends):
        states[name] = fold.seq(states[name] if name in states else fold.zero(), given.iloc[start:end])


def fold_by_key(frame: DataFrame, keys: Sequence[str], values: Sequence[str], fold: Fold, *, open_keys: int = OPEN_KEYS) -> DataFrame:
    """``keys...`` and the columns of ``fold.schema``, one row for each key; null is a key.

    Values reach ``seq`` as pandas has them: in a batch with nulls, whole numbers are floats with
    NaN.  Without keys all rows are folded into one state, the finished zero for an empty frame.
    """
    for key in keys:
        if frame.schema[key].dataType.typeName() not in KEY_TYPES:
            raise ValueError(f"{key} is of type {frame.schema[key].dataType.simpleString()}; cast it to one of {KEY_TYPES}")
    texts = [F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(keys)]
    inputs = [F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(values)] or [F.lit(True).alias("v0")]
    # The key is one text, equal where the keys are; the typed keys are read from it at the end.
    key = F.to_json(F.struct(*texts), {"ignoreNullFields": "false"}) if texts else F.lit("")
    rows = frame.select(key.alias("key"), *inputs)
    # Functions of single rows gain nothing from longer batches.
    flat = not isinstance(fold.seq, each) and all(frame.schema[v].dataType.typeName() not in NESTED_TYPES for v in values)

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = TaskContext.get().partitionId() % BUCKETS
        states: dict[str, Any] = {}

        def sent() -> pd.DataFrame:
            out = pd.DataFrame({"key": list(states), "bucket": bucket, "state": [fold.dump(s) for s in states.values()]})
            states.clear()
            return out

        for batch in _together(batches) if flat else batches:
            _fold_in(fold, states, batch)
            if len(states) > open_keys:
                yield sent()
        if states:
            yield sent()

    def combined(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Any]]:
        """One state for each run of rows with the same key."""
        key, state = None, None
        for batch in batches:
            for name, dumped in zip(batch["key"], batch["state"]):
                if name == key:
                    state = fold.comb(state, fold.load(dumped))
                    continue
                if key is not None:
                    yield key, state
                key, state = name, fold.load(dumped)
        if key is not None:
            yield key, state

    def halfway(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for name, state in combined(batches):
            rows.append((name, fold.dump(state)))
            held += len(rows[-1][1])
            if len(rows) >= OUTPUT_ROWS or held >= OUTPUT_BYTES:
                yield pd.DataFrame(rows, columns=["key", "state"])
                rows, held = [], 0
        yield pd.DataFrame(rows, columns=["key", "state"])

    def end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = combined(batches)
        while rows := [(name, *fold.finish(state)) for name, state in islice(found, OUTPUT_ROWS)]:
            yield pd.DataFrame(rows, columns=["key", *columns], dtype=object)

    columns = StructType.fromDDL(fold.schema).names
    first = rows.mapInPandas(begin, "key string, bucket int, state binary")
    bucketed = first.repartition("key", "bucket").sortWithinPartitions("key")
    states = bucketed.mapInPandas(halfway, "key string, state binary")
    if not keys:
        zero = [("", bytearray(fold.dump(fold.zero())))]
        states = states.unionByName(frame.sparkSession.createDataFrame(zero, "key string, state binary"))
    found = states.repartition("key").sortWithinPartitions("key").mapInPandas(end, f"key string, {fold.schema}")
    if not keys:
        return found.drop("key")
    parsed = F.from_json("key", ", ".join(f"k{i} string" for i in range(len(keys))))
    typed = [F.col(f"_key.k{i}").cast(frame.schema[k].dataType).alias(k) for i, k in enumerate(keys)]
    return found.withColumn("_key", parsed).select(*typed, *[F.col(f"`{c}`") for c in columns])


def bounded_histogram(bins: int) -> Fold:
    """Whole numbers counted in at most ``bins`` neighbouring bins of one width, a power of two.

    The width is the smallest with which the values fit, so it follows from the least and the
    greatest value alone: ``width, first`` (the first bin's lower bound), ``counts, n``.  Missing
    values are not counted; of none, ``width`` is 1 and ``first`` null.
    """

    def widened(state: tuple[int, dict[int, int]], shift: int) -> tuple[int, dict[int, int]]:
        by = shift - state[0]
        if not by:
            return state
        counts: dict[int, int] = {}
        for place, n in state[1].items():
            counts[place >> by] = counts.get(place >> by, 0) + n
        return shift, counts

    def fitted(state: tuple[int, dict[int, int]]) -> tuple[int, dict[int, int]]:
        shift, counts = state
        if counts:
            low, high = min(counts), max(counts)
            while (high >> (shift - state[0])) - (low >> (shift - state[0])) >= bins:
                shift += 1
        return widened(state, shift)

    def comb(a: tuple[int, dict[int, int]], b: tuple[int, dict[int, int]]) -> tuple[int, dict[int, int]]:
        shift = max(a[0], b[0])
        a, b = widened(a, shift), widened(b, shift)
        counts = dict(a[1])
        for place, n in b[1].items():
            counts[place] = counts.get(place, 0) + n
        return fitted((shift, counts))

    def seq_keys(codes: np.ndarray, n: int, values: pd.DataFrame) -> list[tuple[int, dict[int, int]]]:
        states: list[tuple[int, dict[int, int]]] = [(0, {}) for _ in range(n)]
        present = values.iloc[:, 0].notna().to_numpy()
        given, codes = values.iloc[:, 0].to_numpy()[present].astype(np.int64), codes[present]
        if not len(given):
            return states
        order = np.lexsort((given, codes))
        given, codes = given[order], codes[order]
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        ends = np.append(starts[1:], len(codes))
        low, high, shifts = given[starts], given[ends - 1], np.zeros(len(starts), dtype=np.int64)
        # Without a sign, since the distance may be greater than a signed number holds.
        while len(wide := np.flatnonzero(((high >> shifts) - (low >> shifts)).view(np.uint64) >= bins)):
            shifts[wide] += 1
        places = given >> np.repeat(shifts, ends - starts)
        edges = np.append(np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(places, prepend=places[0]) != 0)), len(codes))
        cuts = np.searchsorted(edges, np.append(starts, len(codes))).tolist()
        places, counts = places[edges[:-1]].tolist(), np.diff(edges).tolist()
        for code, shift, begin, end in zip(codes[starts].tolist(), shifts.tolist(), cuts[:-1], cuts[1:]):
            states[code] = shift, dict(zip(places[begin:end], counts[begin:end]))
        return states

    def seq(state: tuple[int, dict[int, int]], values: pd.DataFrame) -> tuple[int, dict[int, int]]:
        return comb(state, seq_keys(np.zeros(len(values), dtype=np.int64), 1, values)[0])

    def finish(state: tuple[int, dict[int, int]]) -> tuple:
        shift, counts = state
        places = range(min(counts), max(counts) + 1) if counts else []
        return 1 << shift, places[0] << shift if counts else None, [counts.get(p, 0) for p in places], sum(counts.values())

    schema = "width long, first long, counts array<long>, n long"
    return Fold(lambda: (0, {}), seq, comb, finish, schema, seq_keys=seq_keys)
