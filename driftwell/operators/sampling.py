"""Random and repeatable sampling.

All forms choose by a row's id alone: the same rows come out again after a retry, on another
cluster, or in another engine.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.functions.numbers import hash_bucket


POISSON_STEPS = 65_536


def poisson_thresholds(rate: float) -> list[int]:
    """Of ``POISSON_STEPS`` buckets the numbers below which a row has at most 0, 1, 2 ... copies."""
    found, share, total, copies = [], math.exp(-rate), 0.0, 0
    while not found or found[-1] < POISSON_STEPS:
        total += share
        copies += 1
        share *= rate / copies
        found.append(POISSON_STEPS if share < 0.5 / POISSON_STEPS and copies > rate else round(total * POISSON_STEPS))
    return found


def sample_with_replacement(frame: DataFrame, row_id: str, rate: float, seed: int) -> DataFrame:
    """Each row 0, 1, 2 ... times, ``rate`` times on average, by a hash of its id and the seed."""
    bucket = hash_bucket(F.col(row_id), POISSON_STEPS, seed)
    copies = sum((F.when(bucket >= limit, 1).otherwise(0) for limit in poisson_thresholds(rate)), F.lit(0))
    drawn = frame.withColumn("_copies", copies).where("_copies > 0")
    repeated = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.drop("_copies", "_copy")


def stratified_downsample(frame: DataFrame, label: str, row_id: str, keep_percent: Mapping[float, int]) -> DataFrame:
    """Keep the given percentage of each listed label, and all rows of other labels."""
    share = F.lit(100)
    for value, percent in keep_percent.items():
        share = F.when(F.col(label) == value, F.lit(percent)).otherwise(share)
    return frame.where(hash_bucket(F.col(row_id)) < share)


def split_side(row_id: str, train_percent: int = 70) -> Column:
    """``train`` or ``test``, by a bucket unrelated to the one ``stratified_downsample`` reads."""
    return F.when(hash_bucket(F.col(row_id), salt=1_000_003) < train_percent, "train").otherwise("test")


def train_test_split(frame: DataFrame, row_id: str, train_percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """Two frames; both read the input, so for one pass over a long pipeline add ``split_side`` as a column."""
    side = split_side(row_id, train_percent)
    return frame.where(side == "train"), frame.where(side == "test")
