"""Snapshots and data-quality slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.functions.numbers import safe_ratio


def matched_snapshot(frame: DataFrame) -> DataFrame:
    """Distinct rows of a three-column match table, its columns named by position and reordered."""
    return frame.toDF("mvid", "pwsid", "pwid").distinct().select("mvid", "pwid", "pwsid")


def over_long(frame: DataFrame, column: str, limit: int = 50) -> DataFrame:
    """Rows whose text is longer than ``limit`` characters."""
    return frame.where(F.length(column) > limit)


def distinct_ratio(frame: DataFrame, first: str, second: str, where: Column) -> DataFrame:
    """Distinct values of two columns among the chosen rows, and their ratio."""
    counts = frame.where(where).agg(
        F.count_distinct(first).alias("first_ids"), F.count_distinct(second).alias("second_ids")
    )
    return counts.withColumn("ratio", safe_ratio(F.col("first_ids"), F.col("second_ids")))
