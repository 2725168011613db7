"""Window functions, whole or in slices.

``OVER (PARTITION BY k ORDER BY o)`` brings all rows of a key to one task.  With ``slices`` given,
the rows are first dealt out by ranges of (key, order) and staged, so that a key which holds much of
the data is spread over many tasks; the window runs within (key, slice), and what the earlier or
the next slices contribute is added from a summary that has one row for each (key, slice).  Both
ways give the same rows and types for any sortable order; which one is used is the caller's choice
and never depends on the data.

``order`` columns must tell the rows of a key apart, except for ``rank``, ``dense_rank`` and
``running_sum``, where rows with equal ``order`` are peers.  They are names, with ``-`` in front for
descending.  Nulls sort as in Spark: first ascending, last descending.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from driftwell.operators.joins import join_aggregate
from driftwell.session import scratch_path
from driftwell.sources.writers import stage


@dataclass(frozen=True)
class _Output:
    name: str
    kind: str  # row_number, running_sum, lead or lag
    value: str | None = None


def row_number(frame: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, *, slices: int | None = None) -> DataFrame:
    return _scan(frame, keys, order, _Output(name, "row_number"), slices)


def lead(frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, *, slices: int | None = None) -> DataFrame:
    return _scan(frame, keys, order, _Output(name, "lead", value), slices)


def lag(frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, *, slices: int | None = None) -> DataFrame:
    return _scan(frame, keys, order, _Output(name, "lag", value), slices)


def rank(frame: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, *, slices: int | None = None) -> DataFrame:
    return _over_peers(frame, keys, order, name, "rank", None, slices)


def dense_rank(frame: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, *, slices: int | None = None) -> DataFrame:
    return _over_peers(frame, keys, order, name, "dense_rank", None, slices)


def running_sum(frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, *, slices: int | None = None) -> DataFrame:
    """Running total in the default RANGE frame: rows with equal ``order`` share the total.

    Use an integer or decimal value; sums of doubles depend on the order of addition.
    """
    return _over_peers(frame, keys, order, name, "running_sum", value, slices)


def first_value(frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Value of the key's first row, joined back to all of its rows."""
    return _edge(frame, keys, _sort_columns(order), value, name)


def last_value(frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Value of the key's last row (whole-partition frame, not up to the current row)."""
    return _edge(frame, keys, _sort_columns(order, backwards=True), value, name)


def _edge(frame: DataFrame, keys: Sequence[str], sort: list[Column], value: str, name: str) -> DataFrame:
    # Spark keeps one row per key in each task before the shuffle: a filter on the row number is a limit.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
    edges = frame.select(*keys, F.col(value).alias(name), place.alias("_place")).where("_place = 1").drop("_place")
    return join_aggregate(frame, edges, keys)


def _over_peers(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, kind: str, value: str | None, slices: int | None
) -> DataFrame:
    over = Window.partitionBy(*keys).orderBy(*_sort_columns(order))
    plain = F.sum(value).over(over) if kind == "running_sum" else getattr(F, kind)().over(over).cast("bigint")
    ordinary = frame.withColumn(name, plain)
    if slices is None:
        return ordinary
    # Rows with equal order collapse to one, so a hot value costs one row behind the shuffle.
    columns = [*keys, *[_name(o) for o in order]]
    aggregates = [F.count("*").alias("_n")]
    if value is not None:
        aggregates.append(F.sum(value).alias("_v"))
    peers = frame.groupBy(*columns).agg(*aggregates)
    if kind == "rank":
        scanned = _scan(peers, keys, order, _Output("_upto", "running_sum", "_n"), slices)
        result = F.col("_upto") - F.col("_n") + 1
    elif kind == "dense_rank":
        scanned = _scan(peers, keys, order, _Output("_upto", "row_number"), slices)
        result = F.col("_upto")
    else:
        scanned = _scan(peers, keys, order, _Output("_upto", "running_sum", "_v"), slices)
        result = F.col("_upto")
    totals = scanned.select(*columns, result.cast(ordinary.schema[name].dataType).alias(name))
    return join_aggregate(frame, totals, columns)


def _scan(frame: DataFrame, keys: Sequence[str], order: Sequence[str], out: _Output, slices: int | None) -> DataFrame:
    """A window function over rows that ``order`` tells apart."""
    ordinary = frame.withColumn(out.name, _local(out, Window.partitionBy(*keys).orderBy(*_sort_columns(order))))
    if slices is None:
        return ordinary
    dealt = frame.repartitionByRange(slices, *[F.col(k) for k in keys], *_sort_columns(order))
    # Staged: where a range ends comes from a sample, and must be the same for all that reads it.
    keyed = dealt.withColumn("_k", _key_struct(keys)).withColumn("_s", F.spark_partition_id())
    sliced = stage(keyed, scratch_path(frame.sparkSession, "slices"))
    within = Window.partitionBy("_k", "_s").orderBy(*_sort_columns(order))
    backwards = Window.partitionBy("_k", "_s").orderBy(*_sort_columns(order, backwards=True))

    # The summary has one row for each (key, slice); its window sees one row per slice of a key.
    of_key = Window.partitionBy("_k").orderBy("_s")
    earlier = of_key.rowsBetween(Window.unboundedPreceding, -1)
    here, carried, edge = F.col(out.name), F.col("_carry"), F.lit(None)
    if out.kind in ("row_number", "running_sum"):
        part = F.count("*") if out.kind == "row_number" else F.sum(out.value)
        parts = sliced.groupBy("_k", "_s").agg(part.alias("_part"))
        carry = F.sum("_part").over(earlier)
        result = F.when(here.isNull(), carried).otherwise(here + F.coalesce(carried, F.lit(0)))
    else:
        # The last row of a slice takes the next slice's first value, null or not; for lag the other way.
        ahead = out.kind == "lead"
        first = F.row_number().over(within if ahead else backwards)
        parts = sliced.select("_k", "_s", F.col(out.value).alias("_part"), first.alias("_place")).where("_place = 1").drop("_place")
        carry = (F.lead if ahead else F.lag)("_part").over(of_key)
        edge = F.row_number().over(within) == 1 if not ahead else F.lead(F.lit(True)).over(within).isNull()
        result = F.when(F.col("_edge"), carried).otherwise(here)

    local = sliced.withColumn(out.name, _local(out, within)).withColumn("_edge", edge)
    summary = parts.select("_k", "_s", carry.alias("_carry"))
    joined = local.join(summary, ["_k", "_s"])
    kind = ordinary.schema[out.name].dataType
    return joined.select(*[F.col(f"`{c}`") for c in frame.columns], result.cast(kind).alias(out.name))


def _local(out: _Output, over: Window) -> Column:
    if out.kind == "row_number":
        return F.row_number().over(over).cast("bigint")
    if out.kind == "running_sum":
        return F.sum(out.value).over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (F.lead if out.kind == "lead" else F.lag)(out.value).over(over)


def _name(order: str) -> str:
    return order.removeprefix("-")


def _sort_columns(order: Sequence[str], backwards: bool = False) -> list[Column]:
    """Spark's own null order: first ascending, last descending; reversed with the direction."""
    return [F.col(_name(o)).desc() if o.startswith("-") != backwards else F.col(_name(o)).asc() for o in order]


def _key_struct(keys: Sequence[str]) -> Column:
    """The key as one value that is never null, so null keys meet under plain equality."""
    return F.struct(F.lit(0).alias("_"), *[F.col(k) for k in keys])
