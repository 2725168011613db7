"""All combinations of what a key has in each of several parts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.operators.joins import join_aggregate
from driftwell.session import scratch_path
from driftwell.sources.writers import stage

# Values of a part that stay together, and copies of a row made by one step of a generator.
BLOCK = 8
CHUNK = 65_536


def _product(numbers: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a * b, numbers, F.lit(1).cast("bigint"))


def product_by_key(frame: DataFrame, key: str, part: str, value: str, parts: Sequence[str], *, block: int = BLOCK) -> DataFrame:
    """``key`` and one column for each of ``parts``: every combination of a key's values.

    ``frame`` has one row for each value.  A key lacks rows where it lacks a part, repeated values
    count as often as they stand there, a null value is a value, and null keys drop: what joining
    one frame per part by the key gives.

    The joins would bring all rows of a key to one task, part after part.  Here the values of a key
    and part are dealt into blocks of about ``block``, as many as exact counts ask for, and the
    combinations of blocks are numbered by mixed radix.  A value goes to the numbers that have its
    block as their digit, so one shuffle by (key, number) brings the blocks of each combination
    together, and a key with many values is as many groups as its product needs.  A row is copied
    less often than the combinations it is in, so the shuffle is never larger than the result.
    The values are staged first: each must be in the same block whenever it is read.
    """
    rows = frame.where(F.col(key).isNotNull() & F.col(part).isin(*parts)).select(
        F.col(key).alias("_id"),
        F.col(part).alias("_part"),
        # a struct, so that a null value is still an element
        F.struct(F.col(value).alias("v")).alias("_value"),
        F.monotonically_increasing_id().alias("_row"),
    )
    stored = stage(rows, scratch_path(frame.sparkSession, "product"))
    sizes = [F.ceil(F.count_if(F.col("_part") == p) / block).cast("bigint").alias(f"_b{i}") for i, p in enumerate(parts)]
    blocks = [F.col(f"_b{i}") for i in range(len(parts))]
    planned = stored.groupBy("_id").agg(*sizes).where(reduce(lambda a, b: a & b, [b > 0 for b in blocks]))
    strides = [_product(blocks[i + 1 :]) for i in range(len(parts))]
    planned = planned.select(
        "_id",
        F.map_from_arrays(F.array(*[F.lit(p) for p in parts]), F.array(*blocks)).alias("_blocks"),
        F.map_from_arrays(F.array(*[F.lit(p) for p in parts]), F.array(*strides)).alias("_strides"),
        _product(blocks).alias("_total"),
    )
    joined = join_aggregate(stored, planned, ["_id"]).select(
        "_id",
        "_part",
        "_value",
        F.col("_blocks")[F.col("_part")].alias("_n"),
        F.col("_strides")[F.col("_part")].alias("_stride"),
        "_total",
        F.pmod(F.xxhash64("_row"), F.col("_blocks")[F.col("_part")]).alias("_own"),
    )
    # The numbers with the own block as their digit, in two steps so that no array is long.
    copies = (F.col("_total") / F.col("_n")).cast("bigint")
    begun = joined.withColumn("_copies", copies).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(CHUNK).cast("bigint"))))
    last = F.least(F.col("_from") + CHUNK, F.col("_copies")) - 1
    copied = begun.withColumn("_j", F.explode(F.sequence(F.col("_from"), last)))
    number = F.expr("_j div _stride * (_stride * _n) + _own * _stride + _j % _stride")
    dealt = copied.select("_id", number.alias("_number"), "_part", "_value").repartition("_id", "_number")
    found = dealt.groupBy("_id", "_number").agg(
        *[F.collect_list(F.when(F.col("_part") == p, F.col("_value"))).alias(f"_l{i}") for i, p in enumerate(parts)]
    )
    for i in range(len(parts)):
        found = found.withColumn(f"_l{i}", F.explode(f"_l{i}"))
    return found.select(F.col("_id").alias(key), *[F.col(f"_l{i}.v").alias(p) for i, p in enumerate(parts)])
