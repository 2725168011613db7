"""Joins beyond a plain ``DataFrame.join``.

None of them hints a broadcast: Spark broadcasts a side whose size it knows to be below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a shuffled join, in which the adaptive
planner splits a hot key's partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def anti_nullsafe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows, duplicates kept, whose key is not on the right; null equals null.

    The right side is cut to its distinct keys before the shuffle, so a key repeated there costs
    one row.
    """
    keys = right.select(*[F.col(c).alias(f"_r_{c}") for c in on]).distinct()
    match = reduce(lambda a, b: a & b, [left[c].eqNullSafe(keys[f"_r_{c}"]) for c in on])
    return left.join(keys, match, "left_anti")


def join_aggregate(frame: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows joined to an aggregate that has one row for each key; null equals null.

    The join is on the keys as one struct rather than on the columns the aggregate is grouped by.
    So the aggregate is shuffled once more for the join, which is little, and both inputs of the
    join come straight from a shuffle, which the adaptive planner asks for before it splits the
    rows of a hot key.
    """
    others = [F.col(f"`{c}`") for c in per_key.columns if c not in keys]
    right = per_key.select(F.struct(*keys).alias("_key"), *others)
    return frame.withColumn("_key", F.struct(*keys)).join(right, "_key").drop("_key")


def count_back(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Every row with the number of rows that share its key; rows with a null key drop.

    Counted map-side first and joined back, rather than counted in a window: a window would bring
    all rows of a hot key to one task.
    """
    keyed = frame.where(F.col(key).isNotNull())
    return join_aggregate(keyed, keyed.groupBy(key).agg(F.count("*").alias(name)), [key])


def greatest_per_group(frame: DataFrame, key: str, measure: str) -> DataFrame:
    """All rows that hold the largest measure of their key; ties and duplicates stay, null keys drop.

    The maxima are combined map-side.  The join back is on key and value, so neither a large group
    nor a large tie is gathered in one task.
    """
    valued = frame.where(F.col(key).isNotNull() & F.col(measure).isNotNull())
    return join_aggregate(valued, valued.groupBy(key).agg(F.max(measure).alias(measure)), [key, measure])


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Inner join of a fact with ``(dimension, shared key column)`` pairs."""
    for dimension, key in dimensions:
        fact = fact.join(dimension, key)
    return fact


def join_pairs(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``(k, v)`` with ``(k, w)`` to ``(k, v, w)``, outer sides null."""
    return left.toDF("k", "v").join(right.toDF("k", "w"), "k", how)
