"""Aggregations over key-value frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.operators.joins import join_aggregate

# A list longer than this is delivered in parts.
LIST_PART = 100_000


def aggregate_by_key(frame: DataFrame, key: str, **accumulators: Column) -> DataFrame:
    """Named aggregates per key.

    Built-in aggregates run as a partial aggregate before the shuffle and a merge behind it, which
    is what a pair of sequence and combine functions spells out by hand.
    """
    return frame.groupBy(key).agg(*[column.alias(name) for name, column in accumulators.items()])


def sum_by_key(frame: DataFrame, key: str, value: str) -> DataFrame:
    return aggregate_by_key(frame, key, total=F.sum(value))


def count_by_key(frame: DataFrame, key: str) -> DataFrame:
    return aggregate_by_key(frame, key, n=F.count("*"))


def values_by_key(
    frame: DataFrame, key: str, value: str, row_id: str, *, part_size: int = LIST_PART
) -> DataFrame:
    """All values of each key as sorted lists: ``key, part, parts, values``.

    A key with up to ``part_size`` values has one part, a larger one as many as it needs, its rows
    dealt out by a hash of ``row_id``: no task has to hold the whole of a hot key and no value is
    left out.  Sizes are counted, not estimated, and a key's parts depend on that key alone, so any
    partitioning gives the same rows.  The null key is a group like any other.
    """
    rows = frame.select(F.col(key), F.col(value).alias("_v"), F.col(row_id).alias("_id"))
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / F.lit(part_size)).cast("bigint").alias("parts"))
    joined = join_aggregate(rows, sizes, [key]).withColumn("part", F.pmod(F.xxhash64("_id"), F.col("parts")))
    # Grouped by key and part, not where the join has left the key's rows together.
    dealt = joined.repartition(key, "part")
    return (
        dealt.groupBy(key, "parts", "part")
        .agg(F.sort_array(F.collect_list("_v")).alias("values"))
        .select(key, "part", "parts", "values")
    )


def word_counts(frame: DataFrame, words: Column) -> DataFrame:
    """Occurrences of each element of an array expression."""
    return frame.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
