"""Exact distinct counts that add up over days.

The ids of a day are kept as bitmaps, one for each measure and bucket of 32,768 neighbouring ids.
Bitmaps of several days are merged by OR, so a count over any span of days reads their bitmaps and
not the days again, and a new day costs that day alone.  Ids are whole numbers; dense ones pack well.
Number other ids first (``plans.features.category_index``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftwell.functions.numbers import safe_ratio

SCHEMA = "measure string, bucket bigint, bitmap binary, dt string"


def id_bitmaps(frame: DataFrame, measures: Mapping[str, Column], day: str | None = None) -> DataFrame:
    """``[dt,] measure, bucket, bitmap`` of the ids that each measure gives, null for a row outside it.

    ``day`` names a column that tells days apart.  Bitmaps are built map-side, so a hot id or day
    costs one bitmap for each bucket and task.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("measure"), ids.cast("bigint").alias("id")) for name, ids in measures.items()])
    keys = [] if day is None else [F.col(day).cast("string").alias("dt")]
    rows = frame.select(*keys, F.explode(entries).alias("e")).where("e.id IS NOT NULL")
    bucket = F.bitmap_bucket_number("e.id").alias("bucket")
    named = [F.col("dt")] if keys else []
    return rows.groupBy(*named, F.col("e.measure").alias("measure"), bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("e.id")).alias("bitmap")
    )


def write_days(frame: DataFrame, path: str, measures: Mapping[str, Column], day: str) -> None:
    """Bitmaps of all days of ``frame`` below ``path``, one directory a day; days there before are replaced."""
    bitmaps = id_bitmaps(frame, measures, day).hint("rebalance", "dt")
    writer = bitmaps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt").parquet(path)


def add_day(frame: DataFrame, path: str, measures: Mapping[str, Column], day: str, value: str) -> None:
    """Bitmaps of one day, whose rows alone are read; a day without rows leaves an empty directory's day out."""
    write_days(frame.where(F.col(day) == value), path, measures, day)


def stored_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def distinct_between(stored: DataFrame, first: str, last: str) -> DataFrame:
    """``measure, n``: distinct ids over the days from ``first`` to ``last``, from their bitmaps alone."""
    days = stored.where(F.col("dt").between(first, last))
    merged = days.groupBy("measure", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("measure").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))


def distinct_ratio_between(stored: DataFrame, above: str, below: str, first: str, last: str) -> DataFrame:
    """One row: the distinct ids of two measures over a span of days, and their ratio."""
    counts = distinct_between(stored, first, last)

    def of(measure: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("measure") == measure, F.col("n"))), F.lit(0).cast("bigint"))

    both = counts.agg(of(above).alias("first_ids"), of(below).alias("second_ids"))
    return both.withColumn("ratio", safe_ratio(F.col("first_ids"), F.col("second_ids")))
