"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return safe_ratio(numerator, denominator) * F.lit(100.0)


def hash_bucket(row_id: Column, buckets: int = 100, salt: int = 0) -> Column:
    """A bucket in ``[0, buckets)`` that depends on nothing but the integer ``row_id``.

    Multiplicative hashing on the id folded modulo a prime, so any bigint fits and a rerun, a lost
    executor or another partitioning gives the same bucket.  ``buckets`` may go up to 65536;
    another ``salt`` gives buckets unrelated to the first ones.
    """
    prime = F.lit(2147483647)
    folded = F.pmod(F.pmod(row_id.cast("bigint"), prime) + F.lit(salt), prime)
    mixed = F.pmod(folded * F.lit(2654435761), F.lit(4294967296))
    return (F.shiftright(mixed, 16) % F.lit(buckets)).cast("int")
