"""Set and bag operations; null equals null in all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from driftwell.operators.joins import anti_nullsafe


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second).distinct()


def intersect(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows found on both sides.

    Both sides are made distinct before they are matched: the repeats of a hot value are dropped
    map-side instead of being shuffled.
    """
    return first.distinct().intersect(second.select(*first.columns).distinct())


def subtract_bag(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of the first side, repeats kept, that the second side does not hold."""
    return anti_nullsafe(first, second, first.columns)
