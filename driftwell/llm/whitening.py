"""Embedding whitening from a covariance over distinct quantised vectors.

Entries become whole numbers ``floor(scale * c)``; equal vectors are grouped with their count, and
each distinct vector enters the fit with weight one or with that count.  Sums are whole numbers and
exact.  With them known, every task subtracts the mean and multiplies its own rows (centred GEMM);
its lines are added up in two levels, so no task stacks one row for each of all tasks.  The matrix
of one line per dimension is what the driver sees.  Each distinct vector is whitened once and joined
back to its rows; a vector that many rows share is split by the adaptive planner.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are dropped;
where vectors differ in length, those of the most frequent length (the smaller of equals) remain.
Whole numbers beyond 64 bits are held at the ends of that range.  A null id is kept as it is,
repeated rows keep their repeats, other columns are not looked at.
Vectors with fewer dimensions than ``components`` give as many components as they have.  A component
without variance has null ``whitened``, and ``explained`` is null where no component has any; a
``deviation`` beyond 64 bits is null.  Without a vector there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from driftwell.llm.common import ship_package, staged
from driftwell.operators.joins import join_aggregate

SCALE = 256
COMPONENTS = 4
# Partial lines are added up in so many buckets before they meet.
BUCKETS = 32
_ROWS = 4_096
# Variance below this share of the largest is rounding.
_FLAT = 1e-13
_LONGEST = 2**63 - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Entries as doubles, times ``scale``, rounded down."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null, NaN or infinite entries."""
    sound = F.forall(
        vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))
    )
    return F.coalesce((F.size(vector) > 0) & sound, F.lit(False))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), width)


def _steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), _ROWS):
            yield batch.iloc[at : at + _ROWS]


def _added(part: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(part["sums"].iloc[0]))
    for line in part["sums"]:
        total += line
    return pd.DataFrame({"line": [part["line"].iloc[0]], "sums": [total]})


def total_lines(partial: DataFrame, width: int) -> np.ndarray:
    """Rows ``line int, bucket int, sums array<double>`` of all tasks, added up by line."""
    schema = "line int, sums array<double>"
    first = partial.groupBy("line", "bucket").applyInPandas(lambda part: _added(part), schema)
    out = np.zeros((width, width))
    for row in first.groupBy("line").applyInPandas(lambda part: _added(part), schema).collect():
        out[row["line"]] = row["sums"]
    return out


class Centre:
    """Number of vectors in the fit, their sums by dimension, and exact deviations from their mean."""

    def __init__(self, count: int, sums: list[int], largest: int) -> None:
        self.count, self.sums = count, sums
        # Where n * x - S could leave 64 bits, Python's whole numbers take over.
        self.narrow = count * largest + max(map(abs, sums)) <= _LONGEST

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        if self.narrow:
            return self.count * x - np.array(self.sums, dtype=np.int64)
        return self.count * x.astype(object) - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` as doubles."""
        return self.scaled(x).astype(np.float64) / self.count

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of ``n * x - S``; None where it needs more than 64 bits."""
        scaled = self.scaled(x)
        if self.narrow and int(np.abs(scaled).max(initial=0)) ** 2 * x.shape[1] <= _LONGEST:
            return (scaled * scaled).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in scaled.tolist()]
        return [v if v <= _LONGEST else None for v in exact]


def _centre(distinct: DataFrame, width: int) -> Centre:
    """Exact sums; wide enough that no dimension can overflow."""
    places = distinct.select("weight", F.posexplode("x").alias("at", "value"))
    totals = places.groupBy("at").agg(
        F.sum(F.col("value").cast("decimal(38,0)") * F.col("weight")).alias("sum"),
        F.max(F.abs(F.col("value").cast("decimal(38,0)"))).alias("largest"),
        F.sum("weight").alias("n"),
    )
    found = {r["at"]: r for r in totals.collect()}
    sums = [int(found[i]["sum"]) for i in range(width)]
    return Centre(int(found[0]["n"]), sums, max(int(r["largest"]) for r in found.values()))


def covariance(distinct: DataFrame, centre: Centre, width: int) -> np.ndarray:
    """Weighted covariance of ``x array<long>, weight long``, divisor the sum of the weights."""

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros((width, width))
        seen = False
        for batch in _steps(batches):
            rows = centre.centred(_matrix(batch["x"], width))
            total += rows.T @ (rows * batch["weight"].to_numpy(dtype=np.float64)[:, None])
            seen = True
        if seen:
            bucket = TaskContext.get().partitionId() % BUCKETS
            yield pd.DataFrame({"line": np.arange(width), "bucket": bucket, "sums": list(total)})

    partial = distinct.select("x", "weight").mapInPandas(multiply, "line int, bucket int, sums array<double>")
    found = total_lines(partial, width) / centre.count
    return (found + found.T) / 2


def _identity_error(whitened: DataFrame, kept: list[int]) -> float | None:
    """Largest absolute entry of the whitened columns' weighted covariance minus the identity."""
    if not kept:
        return None
    total = F.sum("weight").cast("double")
    values = {i: F.col("w")[i] for i in kept}
    means = whitened.agg(*[(F.sum(values[i] * F.col("weight")) / total).alias(f"m{i}") for i in kept]).first()
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    products = [
        (F.sum((values[i] - F.lit(means[f"m{i}"])) * (values[j] - F.lit(means[f"m{j}"])) * F.col("weight")) / total).alias(f"c{i}_{j}")
        for i, j in pairs
    ]
    found = whitened.agg(*products).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten_embeddings(
    rows: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    weights: str = "one",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    One row for each remaining row of ``rows`` and each of the first ``components`` components,
    which are the unit eigenvectors of the covariance by falling eigenvalue, from 1.  ``weights`` is
    ``one`` or ``counts``: how much a distinct vector counts in the fit.  ``n`` is the sum of weights.
    """
    if weights not in ("one", "counts"):
        raise ValueError("weights is 'one' or 'counts'")
    schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    ship_package(rows.sparkSession)
    vector = F.col(f"`{vector_col}`")
    sound = rows.where(usable(vector)).select(F.col(f"`{id_col}`").alias("vec_id"), quantised(vector, scale).alias("x"))
    empty = rows.sparkSession.createDataFrame([], schema.format(sound.schema["vec_id"].dataType.simpleString()))
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("long")
    every = staged(sound.groupBy("x").agg(weight.alias("weight"), F.count("*").alias("copies")), "whitening-distinct")
    # One row: the most frequent length.
    lengths = every.groupBy(F.size("x").alias("width")).agg(F.sum("copies").alias("n"))
    frequent = lengths.agg(F.max_by("width", F.struct("n", -F.col("width"))).alias("width")).first()["width"]
    if frequent is None:
        return empty
    width = frequent
    distinct = every.where(F.size("x") == width).drop("copies")
    centre = _centre(distinct, width)
    values, vectors = np.linalg.eigh(covariance(distinct, centre, width))
    order = np.argsort(-values, kind="stable")[:components]
    eigenvalues, axes = np.maximum(values[order], 0.0), vectors[:, order]
    trace = float(values.sum())
    kept = [i for i, e in enumerate(eigenvalues) if e > _FLAT * max(values.max(), 0.0) and e > 0]
    divisors = np.array([np.sqrt(e) if i in kept else np.nan for i, e in enumerate(eigenvalues)])

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _steps(batches):
            x = _matrix(batch["x"], width)
            projected = (centre.centred(x) @ axes) / divisors
            values = [[None if np.isnan(v) else float(v) for v in row] for row in projected]
            deviations = pd.array(centre.deviation(x), dtype="Int64")
            yield pd.DataFrame({"x": batch["x"], "weight": batch["weight"], "deviation": deviations, "w": values})

    whitened = staged(
        distinct.mapInPandas(project, "x array<long>, weight long, deviation long, w array<double>"), "whitening-projected"
    )
    error = _identity_error(whitened, kept)
    joined = join_aggregate(sound.where(F.size("x") == width), whitened.drop("weight"), ["x"])
    shares = F.array(*[F.lit(float(e / trace) if trace > 0 else None).cast("double") for e in eigenvalues])
    return joined.select("vec_id", "deviation", F.posexplode("w").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(centre.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
