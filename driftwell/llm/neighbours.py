"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is halved again and again at medians, so its cells are equally full; their means
are the centroids of the posting lists.  A graph over the centroids, held in memory by every task,
is walked to find the centroids near a vector.  Each distinct vector goes to its nearest list, and
to a few more whose centroids are hardly farther: those beyond whose boundary it almost lies.  A
query reads the lists whose centroids are within a ratio of its nearest centroid's distance; the
ratio is the smallest that finds ``RECALL`` of the true neighbours within the sample, whose
neighbours are farther than those in all rows.

Lists and the queries that read them meet in cells of bounded size, so a crowded list is work for
many tasks; its rows are dealt out, none is dropped.  Copies of a vector are one entry with its
``k + 1`` smallest ids, which are all that a result can hold.  A cell measures its queries against
its vectors by matrix products and computes every distance that may be among the nearest anew from
the vectors themselves; each query's cells are merged by their smallest distances.

Defined cases: null ids, and vectors that are null, empty, zero or hold a null or non-finite entry
take no part; where lengths differ, only those of the most frequent length do.  Rows are candidates
one by one: repeated rows are found as often as they stand there, and a query leaves out one row
with its own id and vector.  A query with fewer than ``k`` candidates in its lists reads all lists.
Without queries or candidates there are no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from driftwell.llm.common import ship_package, staged
from driftwell.llm.whitening import usable
from driftwell.session import delete_path, scratch_path
from driftwell.sources.writers import stage

K = 10
# There are as many lists as the root of the number of vectors, so that looking at centroids and looking
# at a list cost alike; beyond the most there are, lists grow and are cut into more cells.
MOST_LISTS = 16_384
# The index is fitted on at most so many rows, numbers and this share; all rows are indexed.
SAMPLE = 65_536
SAMPLE_VALUES = 1 << 22
MOST_SAMPLED = 0.25
# A vector has at most so many lists.  A boundary vector's centroids are up to a ratio of the nearest
# one's distance away; the ratio makes this share of the sample boundary vectors.
COPIES = 3
BOUNDARY_SHARE = 0.25
RECALL = 0.95
TRIALS = 512
# At least so many lists are read by a query.
LEAST_LISTS = 4
# Vectors and queries to a cell.
CELL_VECTORS = 4_096
CELL_QUERIES = 1_024
_DEGREE = 16
_BEAM = 24
_STEP = 4
_WALKERS = 256


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; added up in the order of the entries, so equal pairs give equal numbers anywhere."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += (a[:, i] - b[:, i]) ** 2
    return np.sqrt(total)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, rounded as products are."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Means of equally full cells, neighbouring cells one after the other."""
    random = np.random.default_rng(seed)
    found: list[np.ndarray] = []

    def halve(rows: np.ndarray, wanted: int) -> None:
        if wanted <= 1 or len(rows) <= 1:
            found.append(rows.mean(axis=0))
            return
        first, second = rows[random.choice(len(rows), 2, replace=False)]
        for _ in range(6):
            side = rows @ (second - first)
            cut = np.partition(side, len(side) // 2)[len(side) // 2]
            near, far = rows[side < cut], rows[side >= cut]
            if not len(near) or not len(far):
                break
            first, second = near.mean(axis=0), far.mean(axis=0)
        order = np.argsort(rows @ (second - first), kind="stable")
        left = wanted // 2
        at = max(1, min(len(rows) - 1, len(rows) * left // wanted))
        halve(rows[order[:at]], left)
        halve(rows[order[at:]], wanted - left)

    halve(sample, lists)
    return np.array(found)


@dataclass(frozen=True)
class CentroidGraph:
    """Centroids, each linked to its nearest ones and, by powers of two, along the order of cells."""

    points: np.ndarray
    links: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray) -> CentroidGraph:
        count = len(points)
        degree = min(_DEGREE, count - 1)
        near = np.empty((count, degree), dtype=np.int64)
        for at in range(0, count if degree else 0, 512):
            squares = _products(points[at : at + 512], points)
            squares[np.arange(len(squares)), np.arange(at, at + len(squares))] = np.inf
            near[at : at + 512] = np.argpartition(squares, degree - 1, axis=1)[:, :degree]
        steps = [1 << b for b in range(max(count - 1, 0).bit_length())]
        places = np.arange(count)[:, None]
        along = [(places + s) % count for s in steps] + [(places - s) % count for s in steps]
        return cls(points, np.hstack([near, *along]) if along else np.zeros((count, 1), dtype=np.int64))

    def near(self, rows: np.ndarray, ratio: float, least: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each row the lists found within ``ratio`` of the nearest, at least ``least``, nearest first."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(rows), _WALKERS):
            out += self._walk(rows[at : at + _WALKERS], ratio, least, max(64, 2 * least))
        return out

    def _walk(self, rows: np.ndarray, ratio: float, least: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Best-first from a few entries; ``width`` nodes are kept for each row, more where that is too few."""
        count, walkers = len(self.points), len(rows)
        width = min(width, count)
        beam = min(max(_BEAM, least), width)
        seen = np.zeros(walkers * count, dtype=bool)
        nodes = np.full((walkers, width), -1, dtype=np.int64)
        distance = np.full((walkers, width), np.inf)
        asked = np.zeros((walkers, width), dtype=bool)
        entries = np.unique(np.linspace(0, count - 1, min(count, 8)).astype(np.int64))
        keys = (np.arange(walkers)[:, None] * count + entries[None, :]).ravel()
        while True:
            keys = keys[~seen[keys]]
            if len(keys):
                seen[keys] = True
                walker, node = np.divmod(keys, count)
                new = np.bincount(walker, minlength=walkers)
                place = np.arange(len(keys)) - (np.cumsum(new) - new)[walker]
                more = np.full((walkers, new.max()), -1, dtype=np.int64)
                far = np.full(more.shape, np.inf)
                more[walker, place] = node
                far[walker, place] = _distances(rows[walker], self.points[node])
                nodes = np.hstack([nodes, more])
                distance = np.hstack([distance, far])
                asked = np.hstack([asked, np.zeros(more.shape, dtype=bool)])
                order = np.argsort(distance, axis=1, kind="stable")[:, :width]
                nodes, distance, asked = (np.take_along_axis(a, order, axis=1) for a in (nodes, distance, asked))
            limit = np.maximum(ratio * distance[:, 0], distance[:, beam - 1])
            ask = ~asked & (nodes >= 0) & (distance <= limit[:, None])
            ask &= np.cumsum(ask, axis=1) <= _STEP
            if not ask.any():
                break
            asked |= ask
            walker, place = np.nonzero(ask)
            keys = np.unique(walker[:, None] * count + self.links[nodes[walker, place]])
        within = (nodes >= 0) & ((distance <= ratio * distance[:, :1]) | (np.arange(width) < least))
        out = [(n[w], d[w]) for n, d, w in zip(nodes, distance, within)]
        crowded = np.flatnonzero(within[:, -1]) if width < count else []
        if len(crowded):
            for i, found in zip(crowded, self._walk(rows[crowded], ratio, least, 4 * width)):
                out[i] = found
        return out


def _nearest_lists(graph: CentroidGraph, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(nodes[:COPIES], far[:COPIES]) for nodes, far in graph.near(rows, 1.0, COPIES)]


def _homes(near: list[tuple[np.ndarray, np.ndarray]], boundary: float) -> list[np.ndarray]:
    """The lists of each row, its nearest first, from its nearest centroids."""
    return [nodes[(far <= boundary * far[0]) | (np.arange(len(far)) == 0)] for nodes, far in near]


def fitted_boundary(near: list[tuple[np.ndarray, np.ndarray]], share: float = BOUNDARY_SHARE) -> float:
    """The ratio of the two nearest centroids' distances that ``share`` of the rows stays below."""
    ratios = [far[1] / max(far[0], 1e-300) for _, far in near if len(far) > 1]
    return float(np.quantile(ratios, share)) if ratios else 1.0


def fitted_ratio(graph: CentroidGraph, sample: np.ndarray, homes: list[np.ndarray], k: int, recall: float = RECALL) -> float:
    """The smallest ratio at which queries of the sample meet ``recall`` of their neighbours in it."""
    if len(sample) <= k:
        return np.inf
    trials = np.unique(np.linspace(0, len(sample) - 1, TRIALS).astype(np.int64))
    needed = []
    for at in range(0, len(trials), 64):
        some = trials[at : at + 64]
        squares = _products(sample[some], sample)
        squares[np.arange(len(some)), some] = np.inf
        nearest = np.argpartition(squares, k - 1, axis=1)[:, :k]
        to_lists = np.sqrt(np.maximum(_products(sample[some], graph.points), 0))
        ranked = np.sort(to_lists, axis=1)
        free = ranked[:, min(LEAST_LISTS, ranked.shape[1]) - 1]
        for i in range(len(some)):
            for j in nearest[i]:
                distance = to_lists[i, homes[j]].min()
                needed.append(1.0 if distance <= free[i] else distance / max(ranked[i, 0], 1e-300))
    return float(np.quantile(needed, recall, method="higher")) * (1 + 1e-9)


@dataclass(frozen=True)
class PostingIndex:
    """The centroid graph, and every distinct vector with its lists as ``entry, ids, vector, lists``."""

    graph: CentroidGraph
    ratio: float
    entries: DataFrame
    # By list: entries in it, and those of them that have it as their nearest.
    sizes: np.ndarray
    nearest: np.ndarray
    k: int


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _sound(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`")
    found = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    return found.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).where(F.exists("vector", lambda c: c != 0))


def build_index(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> PostingIndex | None:
    """Index all rows for searches of up to ``k`` neighbours; None where no vector is usable."""
    spark = rows.sparkSession
    ship_package(spark)
    sound = _sound(rows, id_col, vector_col)
    # A limit by row number keeps k + 1 rows of a vector in each task before the shuffle.
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    copies = sound.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    grouped = copies.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    path = scratch_path(spark, "neighbours-distinct")
    distinct = stage(grouped.select(F.monotonically_increasing_id().alias("entry"), "ids", "vector"), path)
    lengths = distinct.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    shape = lengths.agg(F.max(F.struct("n", (-F.col("width")).alias("width")))).first()[0]
    if shape is None:
        return None
    count, width = shape["n"], -shape["width"]
    distinct = distinct.where(F.size("vector") == width)

    wanted = min(SAMPLE, max(SAMPLE_VALUES // width, 4 * K), max(int(count * MOST_SAMPLED), 4 * K))
    share = int(min(1.0, wanted / count) * (1 << 30))
    drawn = distinct.where(F.pmod(F.xxhash64("entry", "ids"), F.lit(1 << 30)) < share).select("entry", "vector").toPandas()
    if drawn.empty:
        drawn = distinct.select("entry", "vector").limit(1).toPandas()
    sample = _matrix(drawn.sort_values("entry")["vector"])
    graph = CentroidGraph.build(balanced_centroids(sample, max(1, min(MOST_LISTS, math.isqrt(count), len(sample) // 4))))
    near = _nearest_lists(graph, sample)
    boundary = fitted_boundary(near)
    ratio = fitted_ratio(graph, sample, _homes(near, boundary), k)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2_048):
                part = batch.iloc[at : at + 2_048]
                yield part.assign(lists=_homes(_nearest_lists(graph, _matrix(part["vector"])), boundary))

    kind = distinct.schema["vector"].dataType.simpleString()
    entries = staged(distinct.mapInPandas(assign, f"entry long, ids array<long>, vector {kind}, lists array<int>"), "neighbours-index")
    delete_path(spark, path)
    # One row for each list.
    held = entries.select(F.posexplode("lists").alias("place", "list")).groupBy("list")
    found = held.agg(F.count("*").alias("n"), F.count_if(F.col("place") == 0).alias("nearest")).collect()
    sizes, nearest = np.zeros(len(graph.points), dtype=np.int64), np.zeros(len(graph.points), dtype=np.int64)
    for row in found:
        sizes[row["list"]], nearest[row["list"]] = row["n"], row["nearest"]
    return PostingIndex(graph, ratio, entries, sizes, nearest, k)


def _measured(asking: pd.DataFrame, held: pd.DataFrame, k: int, own: bool) -> pd.DataFrame:
    """The ``k`` nearest rows of a cell for each of its queries."""
    vectors, queries = _matrix(held["vector"]), _matrix(asking["vector"])
    norms = (vectors * vectors).sum(axis=1)
    reach = min(k + 1, len(vectors))
    parts = []
    for at in range(0, len(queries), 128):
        block = queries[at : at + 128]
        squares = _products(block, vectors)
        # What rounding can move a product by; everything that may be near enough is measured.
        slack = 8 * np.finfo(float).eps * vectors.shape[1] * ((block * block).sum(axis=1) + norms.max())
        limit = np.partition(squares, reach - 1, axis=1)[:, reach - 1] + 2 * slack
        query, place = np.nonzero(~(squares > limit[:, None]))
        parts.append(pd.DataFrame({"query": query + at, "place": place, "score": _distances(block[query], vectors[place])}))
    found = pd.concat(parts, ignore_index=True)
    ids = held["ids"].to_numpy()[found["place"]]
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    rows = found.loc[found.index.repeat(sizes)].reset_index(drop=True)
    rows["vec_id"] = np.concatenate(ids).astype(np.int64)
    rows["nth"] = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows["entry"] = held["entry"].to_numpy()[rows["place"]]
    rows["query_row"] = asking["query_row"].to_numpy()[rows["query"]]
    rows["query_id"] = asking["query_id"].to_numpy()[rows["query"]]
    if own:
        itself = (rows["vec_id"] == rows["query_id"]) & (rows["score"] == 0)
        itself &= ~rows[itself].duplicated(["query_row", "entry", "vec_id"]).reindex(rows.index, fill_value=False)
        rows = rows[~itself]
    rows = rows.sort_values(["query", "score", "vec_id", "entry", "nth"])
    rows = rows[rows.groupby("query").cumcount() < k]
    return rows[["query_row", "query_id", "score", "vec_id", "entry", "nth"]]


def search(
    index: PostingIndex,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int | None = None,
    ratio: float | None = None,
    own: bool = True,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest rows in the lists it reads.

    With ``own`` the queries are indexed rows themselves and leave themselves out.  ``ratio`` in
    place of the index's own reads fewer or more lists; infinity reads all of them.
    """
    graph, nearest = index.graph, index.nearest
    k = index.k if k is None else k
    if k > index.k:
        raise ValueError(f"the index is built for up to {index.k} neighbours")
    ratio = index.ratio if ratio is None else ratio
    width = graph.points.shape[1]

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = np.arange(len(graph.points))
        for batch in batches:
            for at in range(0, len(batch), 1_024):
                part = batch.iloc[at : at + 1_024]
                if np.isfinite(ratio):
                    found = [nodes for nodes, _ in graph.near(_matrix(part["vector"]), ratio, LEAST_LISTS)]
                else:
                    found = [every] * len(part)
                # Every row is in one list as its nearest, so these have enough of them, or all are read.
                yield part.assign(lists=[n if nearest[n].sum() > k else every for n in found])

    sound = _sound(queries, id_col, vector_col).where(F.size("vector") == width)
    kind = sound.schema["vector"].dataType.simpleString()
    numbered = sound.select(F.monotonically_increasing_id().alias("query_row"), F.col("vec_id").alias("query_id"), "vector")
    schema = f"query_row long, query_id long, vector {kind}, lists array<int>"
    asked = staged(numbered.mapInPandas(choose, schema), "neighbours-queries")

    # One row for each list that is read; written, so that Spark knows how small it is.
    asking = asked.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("n"))
    plan = [
        (r["list"], -(-int(index.sizes[r["list"]]) // CELL_VECTORS), -(-r["n"] // CELL_QUERIES))
        for r in asking.collect()
        if index.sizes[r["list"]]
    ]
    cells = staged(queries.sparkSession.createDataFrame(plan, "list int, vector_cells int, query_cells int"), "neighbours-cells")

    def dealt(frame: DataFrame, number: str, own_cell: str, other_cell: str) -> DataFrame:
        """Rows by list and cell: to one of the cells of their own kind, and to each of the other kind."""
        listed = frame.withColumn("list", F.explode("lists")).drop("lists").join(cells, "list")
        place = F.pmod(F.xxhash64(number), F.col(f"{own_cell}s")).cast("int")
        others = F.sequence(F.lit(0), F.col(f"{other_cell}s") - 1)
        placed = listed.withColumn(own_cell, place).withColumn(other_cell, F.explode(others))
        return placed.drop("vector_cells", "query_cells")

    cell = ["list", "vector_cell", "query_cell"]
    asking_cells = dealt(asked, "query_row", "query_cell", "vector_cell").groupBy(*cell)
    held_cells = dealt(index.entries, "entry", "vector_cell", "query_cell").groupBy(*cell)

    def measure(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(held):
            return pd.DataFrame(columns=["query_row", "query_id", "score", "vec_id", "entry", "nth"])
        return _measured(asking, held, k, own)

    schema = "query_row long, query_id long, score double, vec_id long, entry long, nth long"
    found = asking_cells.cogroup(held_cells).applyInPandas(measure, schema)
    # A vector that was met in several lists gives equal rows, which share a rank.
    nearest_first = Window.partitionBy("query_row", "query_id").orderBy("score", "vec_id", "entry", "nth")
    ranked = found.withColumn("rank", F.dense_rank().over(nearest_first)).where(F.col("rank") <= k)
    merged = ranked.groupBy("query_row", "query_id", "rank").agg(F.min("vec_id").alias("vec_id"), F.min("score").alias("score"))
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_neighbours(
    rows: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest rows found; queries are rows too."""
    index = build_index(rows, id_col=id_col, vector_col=vector_col, k=k)
    if index is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, queries, id_col=id_col, vector_col=vector_col)
