"""Date and time expressions; days are UTC."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

MILLIS_PER_DAY = 86_400_000


def epoch_ms_to_day(millis: Column) -> Column:
    """``yyyy-MM-dd`` (UTC) of an epoch in milliseconds, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(millis / MILLIS_PER_DAY).cast("int")).cast("string")


def day_bounds_ms(day: str) -> tuple[int, int]:
    """First millisecond of a day (UTC) and of the next one."""
    first = (date.fromisoformat(day) - date(1970, 1, 1)).days * MILLIS_PER_DAY
    return first, first + MILLIS_PER_DAY


def days_before(run_date: str | Column, days: int = 1) -> Column:
    """The date ``days`` before the run date (``yyyy-MM-dd``)."""
    day = F.lit(run_date) if isinstance(run_date, str) else run_date
    return F.date_sub(F.to_date(day, "yyyy-MM-dd"), days)


def previous_day(run_date: str, days: int = 1) -> str:
    """The same as text, for the name of an output directory."""
    return (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()
