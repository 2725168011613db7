"""Language identification by mixture inference.

Character trigrams (hashed into a fixed number of cells) of all labelled documents give one
distribution per language.  A document is a mixture of languages: expectation-maximisation
estimates the proportions, and the set of languages is chosen by penalised likelihood, adding a
language as long as the gain pays for its parameter.

Defined cases: a null text, or one without any letter, is ``und`` with score 0 and no languages,
as is every text when nothing could be learned.  Rows with a null language or id are not learned
from.  Ties between languages go to the first in alphabetical order.  Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from driftwell.llm.common import held_out, id_and_text, learnable, ship_package

CELLS_BITS = 15
SMOOTHING = 0.05
ROUNDS = 40
TOLERANCE = 1e-4
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
# A table for code points below 128: letters stay, all else is a blank.
_ASCII = np.array([c if chr(c).isalpha() else 32 for c in range(128)], dtype=np.uint32)


def trigram_cells(text: str, bits: int = CELLS_BITS) -> np.ndarray:
    """The cell of each trigram of the lower-cased text, letters and single blanks only."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.where(points < 128, _ASCII[np.minimum(points, 127)], points)
    blank = points == 32
    points = points[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint64)
    if len(points) < 3:
        return np.empty(0, dtype=np.int64)
    mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA77C2B2AE63) + points[2:]
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    # log of P(cell | language), cells by languages
    logs: np.ndarray
    bits: int

    def proportions(self, text: str) -> dict[str, float]:
        """Proportions of the languages chosen for a text, largest first."""
        cells, counts = np.unique(trigram_cells(text, self.bits), return_counts=True)
        if not len(cells):
            # Fewer than three characters cannot be told apart: all languages are as likely.
            return {self.languages[0]: 1.0 / len(self.languages)}
        logs = self.logs[cells]
        total = counts.sum()
        singles = counts @ logs
        chosen = [int(np.argmax(singles))]
        share = np.ones(1)
        best = float(singles[chosen[0]])
        relative = np.exp(logs - logs.max(axis=1, keepdims=True))
        offset = float(counts @ logs.max(axis=1))
        penalty = 0.5 * np.log(total)
        while len(chosen) < len(self.languages):
            # The slope of the likelihood towards a language tells whether adding it can gain.
            mixture = relative[:, chosen] @ share
            slopes = (counts / mixture) @ relative / total
            slopes[chosen] = 0.0
            new = int(np.argmax(slopes))
            if slopes[new] <= 1.0:
                break
            trial, trial_share = [*chosen, new], np.append(share * 0.9, 0.1)
            columns = relative[:, trial]
            for _ in range(ROUNDS):
                weight = (counts / (columns @ trial_share)) @ columns * trial_share / total
                done = np.abs(weight - trial_share).max() < TOLERANCE
                trial_share = weight
                if done:
                    break
            value = float(counts @ np.log(columns @ trial_share)) + offset
            if value - best <= penalty:
                break
            chosen, share, best = trial, trial_share, value
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.languages[chosen[i]]))
        return {self.languages[chosen[i]]: float(share[i]) for i in order}


def learn(labelled: DataFrame, *, bits: int = CELLS_BITS, smoothing: float = SMOOTHING) -> LanguageModel | None:
    """Learn from ``text, lang``; None without a usable row.

    Every partition counts its trigrams into a fixed number of cells per language before anything
    is shuffled; the model that reaches the driver has at most ``2 ** bits`` numbers per language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                if has_letter(text):
                    into = sums.setdefault(lang, np.zeros(1 << bits, dtype=np.int64))
                    into += np.bincount(trigram_cells(text, bits), minlength=1 << bits)
        for lang, into in sums.items():
            cells = np.flatnonzero(into)
            yield pd.DataFrame({"lang": lang, "cell": cells, "n": into[cells]})

    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = usable.select("text", "lang").mapInPandas(count, "lang string, cell long, n long")
    rows = (
        counted.groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("cell", "n")).alias("counts"))
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: r["lang"])
    counts = np.full((1 << bits, len(rows)), smoothing)
    for i, r in enumerate(rows):
        cells, n = np.array([tuple(c) for c in r["counts"]]).T
        counts[cells, i] += n
    return LanguageModel([r["lang"] for r in rows], np.log(counts / counts.sum(axis=0)), bits)


def detect_column(model: LanguageModel | None, text: Column) -> Column:
    """A struct ``lang_pred, score, languages`` for a text column."""

    def one(value: str | None) -> tuple[str, float, str]:
        if model is None or not has_letter(value):
            return UNKNOWN, 0.0, ""
        shares = model.proportions(value)
        first = next(iter(shares))
        return first, min(1.0, shares[first]), ",".join(f"{k}:{v:.3f}" for k, v in shares.items())

    @F.pandas_udf("lang_pred string, score double, languages string")
    def detect(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score", "languages"])

    # Not to be computed again where a filter on the result is pushed down.
    return detect.asNondeterministic()(text)


def learn_from(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Learn from the documents outside the held-out fifth."""
    ship_package(docs.sparkSession)
    usable = docs.where(learnable(F.col(f"`{id_col}`")))
    return learn(usable.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")))


def identify_languages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` of every document."""
    model = learn_from(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = id_and_text(docs, id_col, text_col).select("doc_id", detect_column(model, F.col("text")).alias("found"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.*")
