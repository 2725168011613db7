"""Deduplication of byte strings by windows that meet at sampled suffixes.

No suffixes are sorted: that would take more disk than is allowed.  The sample are the suffixes that
begin at local minima: of the 16-byte prefixes in each window, the one with the smallest hash, the
first of them in a tie.  Sampled suffixes meet by hashes of what their windows have in common (round
one): those that start up to 17 bytes before them of the 33 bytes from there on, those that start 18
to 34 bytes before them of the 34 bytes around; 16 bytes alone meet by chance ever more often as a corpus
grows.  The windows of those that met are compared by hash, as stretches at first and one by one
where stretches differ.  See ``repeats`` for the rounds.

A byte is removed if it lies in a window that also starts in a document with a smaller id; windows
never cross documents and are judged on the input.

Defined cases: a null text is empty; texts shorter than a window stay whole; documents that share
an id never remove each other's bytes; a null id counts as larger than all others.  Repeated rows
have equal results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from driftwell.llm.repeats import CROWD, NO_ID, Ranges, Scheme, covered, prepared, repeated_spans

WINDOW = 50
PREFIX = 16
# Window starts looked at in one go; places within a go fit the lower bits of the order.
_BLOCK = 1 << 21
_PLACE_BITS = 23


class SampledSuffixes(Scheme):
    least = 0
    earlier = True

    def __init__(self, window: int = WINDOW, prefix: int = PREFIX, crowd: int = CROWD):
        if prefix != 16 or window < prefix:
            raise ValueError("a prefix is two words of eight bytes, and a window holds one")
        self.window, self.most, self.crowd = window, window - prefix, crowd

    def units(self, text: bytes) -> np.ndarray:
        return np.frombuffer(text, dtype=np.uint8)

    def _minima(self, units: np.ndarray) -> np.ndarray:
        """For each window of a block the place of its least prefix."""
        places = len(units) - 15
        words = np.lib.stride_tricks.as_strided(units[:8].view(np.uint64), shape=(len(units) - 7,), strides=(1,))
        order = (words[:places] + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
        order ^= order >> np.uint64(31)
        order = (order ^ words[8 : 8 + places]) * np.uint64(0x165667B19E3779F9)
        order ^= order >> np.uint64(32)
        order *= np.uint64(0x9E3779B97F4A7C15)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        order = (order & ~low) | np.arange(places, dtype=np.uint64)
        reach, span = self.most + 1, 1
        while span * 2 <= reach:
            order = np.minimum(order[: len(order) - span], order[span:])
            span *= 2
        if span < reach:
            order = np.minimum(order[: len(order) - (reach - span)], order[reach - span :])
        return (order & low).astype(np.int64)

    def anchors(self, units: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        windows = len(units) - self.window + 1
        if windows <= 0:
            none = np.empty(0, dtype=np.int64)
            return none, none, none
        place = np.empty(windows, dtype=np.int64)
        for at in range(0, windows, _BLOCK):
            end = min(at + _BLOCK, windows)
            place[at:end] = self._minima(units[at : end + self.window - 1]) + at
        # Starts from which a window would leave its text have no place.
        for begin, end in zip(begins.tolist(), ends.tolist()):
            place[max(begin, end - self.window + 1) : end] = -1
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:], [windows])) - 1
        used = place[first] >= 0
        first, last = first[used], last[used]
        return place[first], place[first] - last, place[first] - first

    def parts(self, units: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of a smaller and of a greater offset have more bytes in common than all have."""
        middle = self.most // 2
        near, far = np.flatnonzero(low <= middle), np.flatnonzero(high > middle)
        hashes = Ranges(units, 0)
        right = hashes.of(places[near], places[near] - middle + self.window)
        left = hashes.of(places[far] - middle - 1, places[far] - self.most + self.window)
        number = np.concatenate((near, far))
        order = np.argsort(number, kind="stable")
        return number[order], np.concatenate((right, ~left))[order]


def remove_repeated_bytes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, crowd: int = CROWD
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256`` of every row."""
    rows = prepared(docs, id_col, text_col)
    marked = rows.join(repeated_spans(rows, SampledSuffixes(window, crowd=crowd)), ["doc", "mark"], "left")

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, spans):
            if found is None:
                out.append((len(text), 0, 0, text, hashlib.sha256(text).hexdigest()))
                continue
            gone = covered(found, len(text), window)
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            out.append((len(text), int(gone.sum()), runs, kept, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    result = marked.select(F.expr(f"nullif(doc, {NO_ID})").alias("doc_id"), cut("text", "spans").alias("found"))
    return result.select("doc_id", "found.*")
