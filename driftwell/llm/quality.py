"""Quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a text.  Each
partition sums its part of the ridge normal equations, by fold; the sums meet as one row for each
(fold, equation).  Scores of rows left out of a fit are calibrated by isotonic regression.

Defined cases: a null text counts as empty and is scored like any other; labels that are null are
left out, repeated labels of a document are averaged; without any usable label every score is 0.5.
Repeated documents give repeated rows, a null id is scored but never learned from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from driftwell.llm.common import held_out, id_and_text, learnable, staged

FEATURES = 192
RIDGE = 1.0
FOLDS = 4
# Calibration looks at scores in this many equal steps between the two bounds.
STEPS, LOWEST, HIGHEST = 4096, -0.5, 1.5

_SYMBOLS = b"#$%&*|<>{}[]@^~\\_=+/"
_CLOSERS = b".,;:!?"


def text_statistics(text: str | None) -> list[float]:
    """Shares and logarithms that describe a whole text; all zero for an empty one."""
    raw = (text or "").encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = max(len(raw), 1)
    words = raw.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = raw.split(b"\n")
    filled = [x for x in lines if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    top = max(counts.values(), default=0)
    symbols = int(seen[list(_SYMBOLS)].sum())
    closers = seen[list(_CLOSERS)]
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        float(seen[65:91].sum() / size),
        float(seen[97:123].sum() / size),
        float(seen[48:58].sum() / size),
        float(seen[32] / size),
        float(seen[128:].sum() / size),
        float(symbols / size),
        float(seen[ord("|")] / size),
        float(closers.sum() / size),
        float(closers[4] / size),
        float(closers[0] / n),
        float(symbols / n),
        float(sum(w.isupper() for w in counts) / max(len(counts), 1)),
        float(lengths.mean()) if len(words) else 0.0,
        float(np.log1p(lengths.max())) if len(words) else 0.0,
        float(len(counts) / n),
        float(pairs / max(len(words) - 1, 1)),
        float(top / n),
        float(len(set(filled)) / max(len(filled), 1)),
        float(np.log1p(len(filled))),
        float(len(words) / max(len(filled), 1)) ** 0.5,
    ]


WIDTH = len(text_statistics(""))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([text_statistics(t) for t in texts])


@dataclass(frozen=True)
class Kernel:
    """A random Fourier map of standardised statistics, with a constant first feature."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, features: int, seed: int) -> Kernel:
        random = np.random.default_rng(seed)
        width = len(mean)
        return cls(
            mean,
            np.where(scale > 1e-12, scale, 1.0),
            random.normal(size=(width, features)) / np.sqrt(width),
            random.uniform(0, 2 * np.pi, features),
        )

    def map(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.weights + self.phases)
        return np.hstack([np.ones((len(rows), 1)), waves])


def _normal_equations(training: DataFrame, kernel: Kernel, folds: int) -> np.ndarray:
    """Per fold ``Z'Z | Z'y`` as one array (folds, D, D + 1).

    A partition sends one row for each fold and equation, whatever it holds; what reaches the
    driver is bounded by the number of features.
    """
    size = len(kernel.phases) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((folds, size, size + 1))
        for batch in batches:
            z = kernel.map(np.array(batch["x"].tolist(), dtype=float).reshape(len(batch), -1))
            y = batch["y"].to_numpy(dtype=float)
            fold = batch["fold"].to_numpy()
            for f in range(folds):
                part = z[fold == f]
                sums[f, :, :size] += part.T @ part
                sums[f, :, size] += part.T @ y[fold == f]
        if sums[:, 0, 0].any():
            yield pd.DataFrame(
                {
                    "fold": np.repeat(np.arange(folds), size),
                    "line": np.tile(np.arange(size), folds),
                    "sums": list(sums.reshape(folds * size, size + 1)),
                }
            )

    def total(part: pd.DataFrame) -> pd.DataFrame:
        first = part.iloc[0]
        return pd.DataFrame({"fold": [first["fold"]], "line": [first["line"]], "sums": [np.sum(np.stack(part["sums"]), axis=0)]})

    schema = "fold int, line int, sums array<double>"
    rows = training.mapInPandas(partial, schema).groupBy("fold", "line").applyInPandas(total, schema).collect()
    out = np.zeros((folds, size, size + 1))
    for r in rows:
        out[r["fold"], r["line"]] = r["sums"]
    return out


def _solve(equations: np.ndarray, ridge: float) -> np.ndarray:
    size = equations.shape[0]
    penalty = np.eye(size) * ridge
    penalty[0, 0] = 1e-6
    return np.linalg.solve(equations[:, :size] + penalty, equations[:, size])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and means of the blocks, both ascending; ``x`` is sorted."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    parts = np.array(blocks)
    return parts[:, 0] / parts[:, 2], parts[:, 1] / parts[:, 2]


@dataclass(frozen=True)
class QualityModel:
    kernel: Kernel
    folds: np.ndarray
    coefficients: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        raw = np.clip(self.kernel.map(rows) @ self.coefficients, LOWEST, HIGHEST)
        return np.clip(np.interp(raw, self.knots, self.levels), 0.0, 1.0)


def fit(training: DataFrame, *, features: int = FEATURES, ridge: float = RIDGE, folds: int = FOLDS, seed: int = 7) -> QualityModel | None:
    """Fit on ``x array<double>, y double, fold int``; None where there is no row."""
    numbered = [F.col("x")[i] for i in range(WIDTH)]
    wanted = [F.avg(c) for c in numbered] + [F.stddev_pop(c) for c in numbered] + [F.count("*")]
    found = training.agg(*wanted).first()
    if not found[-1]:
        return None
    kernel = Kernel.draw(np.array(found[:WIDTH], dtype=float), np.array(found[WIDTH:-1], dtype=float), features, seed)
    sums = _normal_equations(training, kernel, folds)
    total = sums.sum(axis=0)
    coefficients = _solve(total, ridge)
    without = np.stack([_solve(total - s if (total - s)[0, 0] > 0 else total, ridge) for s in sums])

    @F.pandas_udf("int")
    def step(x: pd.Series, fold: pd.Series) -> pd.Series:
        z = kernel.map(np.array(x.tolist(), dtype=float).reshape(len(x), -1))
        raw = np.einsum("nd,nd->n", z, without[fold.to_numpy()])
        place = (np.clip(raw, LOWEST, HIGHEST) - LOWEST) / (HIGHEST - LOWEST) * (STEPS - 1)
        return pd.Series(np.rint(place).astype(np.int32))

    seen = (
        training.select(step("x", "fold").alias("step"), "y")
        .groupBy("step")
        .agg(F.avg("y").alias("y"), F.count("*").alias("n"))
        .orderBy("step")
        .collect()
    )
    at = np.array([r["step"] for r in seen]) / (STEPS - 1) * (HIGHEST - LOWEST) + LOWEST
    knots, levels = isotonic(at, np.array([r["y"] for r in seen]), np.array([r["n"] for r in seen], dtype=float))
    return QualityModel(kernel, without, coefficients, knots, levels)


def score_column(model: QualityModel | None, statistics: Column) -> Column:
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), dtype=float).reshape(len(x), -1)))

    return scored(statistics)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; see the module text.

    Labels are learned only from documents outside the held-out fifth.
    """
    described = staged(
        id_and_text(docs, id_col, text_col).select("doc_id", statistics_of("text").alias("x")), "quality-statistics"
    )
    target = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
        .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )
    training = staged(
        described.where(learnable(F.col("doc_id")))
        .join(target, "doc_id")
        .select("x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")),
        "quality-training",
    )
    model = fit(training)
    return described.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("x")).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
