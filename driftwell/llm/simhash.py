"""SimHash near-duplicates through a vantage-point tree.

A tree of vantage points over a bounded sample cuts the space of fingerprints by Hamming distance
into shards.  Every distinct fingerprint lives in one shard and also asks each shard its ball
overlaps: a branch is left out only where the triangle inequality says that nothing in it can be
near enough.  In a shard, fingerprints sorted by their distance to its vantage point are compared
in blocks within the same bounds, so all pairs are found exactly, whatever the tree looks like.

A shard does not emit its pairs but a forest that connects the same fingerprints; the forests meet
in a distributed components job.  Copies share a fingerprint and are one node.

Defined cases: a text without words, empty or null, has fingerprint zero and is linked like any
other; a null id never names a component, and a group without any id has a null one.  Repeated
rows keep their repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from driftwell.llm.common import id_and_text, staged
from driftwell.llm.components import connected_components
from driftwell.operators.joins import join_aggregate

SHINGLE = 3
DISTANCE = 2
# The tree is fitted on at most this many fingerprints, and this share; all are routed through it.
SAMPLE = 40_000
MOST_SAMPLED = 0.25
SHARD = 4_096
MOST_SHARDS = 16_384
_ROWS = 16_384
_BLOCK = 512


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed long: majority of the bits of the shingles' XXH64 (seed 42)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, 42) for p in parts], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS):
        block = hashes[at : at + _ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def simhash_column(text: str, shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return fingerprint(text)


def distances(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass(frozen=True)
class VantageTree:
    """Inner nodes as arrays; child numbers below zero are shards (``-1 - shard``)."""

    points: np.ndarray
    radii: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    shards: int

    @classmethod
    def fit(cls, sample: np.ndarray, shards: int, seed: int = 11) -> VantageTree:
        random = np.random.default_rng(seed)
        points, radii, inner, outer = [], [], [], []
        leaves = 0

        def grow(rows: np.ndarray, wanted: int) -> int:
            nonlocal leaves
            best = None
            if wanted > 1 and len(rows) > 1:
                # The vantage point that leaves the fewest fingerprints near its boundary.
                for point in random.choice(rows, min(8, len(rows)), replace=False):
                    d = distances(rows, point).astype(np.int64)
                    radius = int(np.median(d))
                    radius -= int((d <= radius).all())
                    if radius >= 0:
                        near = float(np.mean(np.abs(d - radius) <= DISTANCE)) + abs(float(np.mean(d <= radius)) - 0.5)
                        if best is None or near < best[0]:
                            best = (near, point, radius, d)
            if best is None:
                leaves += 1
                return -leaves
            _, point, radius, d = best
            at = len(points)
            points.append(point)
            radii.append(radius)
            inner.append(0)
            outer.append(0)
            inner[at] = grow(rows[d <= radius], (wanted + 1) // 2)
            outer[at] = grow(rows[d > radius], wanted // 2)
            return at

        grow(np.unique(sample), shards)
        return cls(
            np.array(points, dtype=np.uint64), np.array(radii, dtype=np.int64), np.array(inner, dtype=np.int64),
            np.array(outer, dtype=np.int64), leaves,
        )

    def route(self, rows: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(shard, indexes, home)``: who lives in a shard or must ask it."""
        stack = [(0 if len(self.points) else -1, np.arange(len(rows)), np.ones(len(rows), dtype=bool))]
        while stack:
            node, index, home = stack.pop()
            if not len(index):
                continue
            if node < 0:
                yield -1 - node, index, home
                continue
            d = distances(rows[index], self.points[node]).astype(np.int64)
            inside = d <= self.radii[node]
            into, out = d - distance <= self.radii[node], d + distance > self.radii[node]
            stack.append((int(self.inner[node]), index[into], (home & inside)[into]))
            stack.append((int(self.outer[node]), index[out], (home & ~inside)[out]))


class _Shard:
    """The fingerprints that live in one shard, joined into local groups."""

    def __init__(self, rows: np.ndarray, distance: int):
        self.distance = distance
        self.vantage = rows[0]
        d = distances(rows, self.vantage).astype(np.int64)
        order = np.argsort(d, kind="stable")
        self.rows, self.far = rows[order], d[order]
        self.parent = np.arange(len(rows))
        for a, b in self._near(self.rows, self.far):
            self._union(a, b)
        self.root = np.array([self._find(i) for i in range(len(rows))], dtype=np.int64)

    def _find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self._find(x), self._find(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def _near(self, asked: np.ndarray, far: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (asked, own) within the distance; ``asked`` is sorted by ``far``."""
        for at in range(0, len(asked), _BLOCK):
            block, reach = asked[at : at + _BLOCK], far[at : at + _BLOCK]
            low = np.searchsorted(self.far, reach[0] - self.distance, "left")
            high = np.searchsorted(self.far, reach[-1] + self.distance, "right")
            for start in range(low, high, 16 * _BLOCK):
                own = self.rows[start : min(high, start + 16 * _BLOCK)]
                i, j = np.nonzero(distances(block[:, None], own[None, :]) <= self.distance)
                if len(i):
                    yield i + at, j + start

    def own_edges(self) -> tuple[np.ndarray, np.ndarray]:
        moved = self.root != np.arange(len(self.root))
        return self.rows[moved], self.rows[self.root[moved]]

    def edges_to(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One edge from each asker to each local group it touches."""
        far = distances(asked, self.vantage).astype(np.int64)
        order = np.argsort(far, kind="stable")
        asked, far = asked[order], far[order]
        pairs = [np.unique(np.stack([i, self.root[j]]), axis=1) for i, j in self._near(asked, far)]
        if not pairs:
            return asked[:0], asked[:0]
        i, j = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return asked[i], self.rows[j]


def near_edges(fingerprints: DataFrame, *, distance: int = DISTANCE, shard_rows: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Edges ``a, b`` that connect the distinct ``fp`` within ``distance`` bits as all pairs would."""
    rows = fingerprints.count()
    shards = max(1, min(MOST_SHARDS, -(-rows // shard_rows)))
    fraction = min(MOST_SAMPLED, sample / max(rows, 1))
    seen = fingerprints.where(
        F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(1 << 40)) <= int(fraction * (1 << 40))
    ).select("fp").collect()
    tree = VantageTree.fit(np.array([r[0] for r in seen], dtype=np.int64).view(np.uint64), shards)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for shard, index, home in tree.route(own, distance):
                yield pd.DataFrame({"shard": shard, "asks": ~home, "fp": own[index].view(np.int64)})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sorted by shard, its own rows before those that only ask.
        number, own, built = None, [], None

        def edges(pair: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
            return pd.DataFrame({"a": pair[0].view(np.int64), "b": pair[1].view(np.int64)})

        def close() -> _Shard | None:
            return _Shard(np.concatenate(own), distance) if own else None

        for batch in batches:
            shard_of, asks = batch["shard"].to_numpy(), batch["asks"].to_numpy()
            fps = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            cuts = np.flatnonzero((shard_of[1:] != shard_of[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(fps)]):
                if shard_of[a] != number:
                    if built is None and own:
                        yield edges(close().own_edges())
                    number, own, built = shard_of[a], [], None
                if not asks[a]:
                    own.append(fps[a:b])
                    continue
                if built is None and own:
                    built = close()
                    yield edges(built.own_edges())
                if built is not None:
                    yield edges(built.edges_to(fps[a:b]))
        if built is None and own:
            yield edges(close().own_edges())

    routed = fingerprints.select("fp").mapInPandas(route, "shard int, asks boolean, fp long")
    return routed.repartition("shard").sortWithinPartitions("shard", "asks").mapInPandas(search, "a long, b long")


def simhash_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``doc_id, fp, component_id, component_size`` of every row; the size counts rows."""
    prints = staged(
        id_and_text(docs, id_col, text_col).select("doc_id", simhash_column("text", shingle).alias("fp")), "simhash"
    )
    distinct = staged(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-distinct"
    )
    groups = connected_components(near_edges(distinct, distance=distance))
    linked = staged(groups.join(distinct, groups["node"] == distinct["fp"]).select("fp", "component", "least", "n"), "simhash-linked")
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("size"))
    # In a form in which the rows of a large component can be split.
    joined = join_aggregate(linked.select("fp", "component"), named, ["component"]).drop("component")
    answer = distinct.join(joined, "fp", "left").select(
        "fp",
        F.coalesce("component_id", "least").alias("component_id"),
        F.coalesce("size", "n").alias("component_size"),
    )
    # Both sides come straight from a shuffle, so the rows of a hot fingerprint can be split.
    right = answer.select(F.struct("fp").alias("_key"), "component_id", "component_size")
    return prints.withColumn("_key", F.struct("fp")).join(right, "_key").drop("_key")
