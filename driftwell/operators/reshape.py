"""Long to wide, and filling of gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


# Pivot columns beyond this number are taken for a mistake.
MOST_PIVOT_COLUMNS = 1_000


def _label(pivot: str) -> Column:
    return F.coalesce(F.col(pivot).cast("string"), F.lit("null"))


def pivot_first(
    frame: DataFrame,
    keys: Sequence[str],
    pivot: str,
    value: str,
    order: str,
    values: Sequence[str],
) -> DataFrame:
    """One column for each pivot value, holding the value of the row that is first by ``order``.

    ``values`` are given, so there is no hidden pass to find them.  A null pivot value makes the
    column ``null``.
    """
    labelled = frame.withColumn(pivot, _label(pivot))
    grouped = labelled.groupBy(*keys).pivot(pivot, list(values))
    return grouped.agg(F.min_by(value, order))


def pivot_values(frame: DataFrame, pivot: str, *, limit: int = MOST_PIVOT_COLUMNS) -> list[str]:
    """The values of a column as names of pivot columns, in order, ``null`` for null.

    At most one more than ``limit`` of them reach the driver; more than ``limit`` are an error, since
    leaving some out would leave rows out.
    """
    labels = frame.select(_label(pivot).alias("label")).distinct()
    found = sorted(r["label"] for r in labels.limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"{pivot} has more than {limit} values; raise the limit, or group by it instead")
    return found


def pivot_discovered(
    frame: DataFrame,
    keys: Sequence[str],
    pivot: str,
    value: str,
    order: str,
    *,
    limit: int = MOST_PIVOT_COLUMNS,
) -> DataFrame:
    """``pivot_first`` for all values the column has, which a first pass over that column finds.

    The columns stand in the order of their names, whatever the order of the rows.  A value named
    like a key is an error.
    """
    values = pivot_values(frame, pivot, limit=limit)
    if clashing := sorted(set(values) & set(keys)):
        raise ValueError(f"pivot values named like keys: {clashing}")
    return pivot_first(frame, keys, pivot, value, order, values)


def fill_null(frame: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Replace nulls in those of the columns the frame has."""
    present = [c for c in columns if c in frame.columns]
    return frame.na.fill(text, present) if present else frame


def eav_to_wide(
    frame: DataFrame, entity: str, field: str, value: str, position: str, fields: Sequence[str]
) -> DataFrame:
    """One row for each entity that has every one of ``fields``; a field may be present as null.

    One aggregation in place of one self join for each field.  Where an entity has a field more
    than once, the value with the highest position is taken.
    """
    aggregates = []
    for name in fields:
        is_field = F.col(field) == name
        # max_by ignores rows whose order is null, so rows of other fields do not take part
        aggregates.append(F.max_by(value, F.when(is_field, F.col(position))).alias(name))
        aggregates.append(F.count(F.when(is_field, 1)).alias(f"_n_{name}"))
    wide = frame.where(F.col(field).isin(*fields)).groupBy(entity).agg(*aggregates)
    for name in fields:
        wide = wide.where(F.col(f"_n_{name}") > 0)
    return wide.select(entity, *fields)


def duplicate_profile(frame: DataFrame) -> DataFrame:
    """One row: the number of rows and of distinct rows, nulls counted.

    What is shuffled is a hash of each row.  A hash met once is a distinct row; only rows whose hash
    is met again, copies and the few rows that share a hash by chance, are compared as they are.
    """
    columns = [F.col(f"`{c}`") for c in frame.columns]
    hashes = frame.select(F.xxhash64(*columns).alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_n"))
    alone = hashes.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"), F.count_if(F.col("_n") == 1).alias("distinct_rows"))
    again = hashes.where("_n > 1").select("_hash")
    repeated = frame.withColumn("_hash", F.xxhash64(*columns)).join(again, "_hash", "left_semi").groupBy("_hash", *columns).agg(F.lit(1))
    compared = repeated.agg(F.lit(0).cast("bigint").alias("rows"), F.count("*").alias("distinct_rows"))
    return alone.unionAll(compared).agg(F.sum("rows").alias("rows"), F.sum("distinct_rows").alias("distinct_rows"))
