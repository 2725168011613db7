"""Iterators over partitions, and distinct counts that are merged over days."""

import datetime
import os

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from conftest import rows
from driftwell.operators import bitmaps, partitions
from driftwell.session import scratch_path


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    yield
    spark.conf.set(key, before)


def laid(spark, n=20_000, parts=4):
    frame = spark.range(0, n, 1, 7).select((n - F.col("id")).alias("id"), F.lit("x").alias("partition_name"))
    return partitions.laid_out(frame, F.col("id") % parts, parts, ["id"])


def test_rows_lie_where_they_are_told_in_order(spark):
    found = laid(spark, 1000).withColumn("at", F.spark_partition_id()).collect()
    assert all(r["id"] % 4 == r["at"] for r in found)
    for part in range(4):
        assert [r["id"] for r in found if r["at"] == part] == sorted(i for i in range(1, 1001) if i % 4 == part)


def test_first_rows_of_each_partition(spark):
    assert rows(partitions.first_rows(laid(spark, 1000), 2), "partition", "id") == [
        (0, 4), (0, 8), (1, 1), (1, 5), (2, 2), (2, 6), (3, 3), (3, 7),
    ]
    few = partitions.laid_out(spark.range(3), F.col("id"), 5, ["id"])
    assert rows(partitions.first_rows(few, 10)) == [(0, 0), (1, 1), (2, 2)]
    assert partitions.first_rows(few, 0).count() == 0
    assert partitions.first_rows(few.where("id < 0")).count() == 0


def test_what_follows_the_first_row_is_not_pulled(spark, small_batches, tmp_path):
    """5,000 rows in each partition, 100 to a batch: one batch of 50 is pulled."""

    def counting(function):
        def over(batches):
            def told():
                for batch in batches:
                    with open(tmp_path / f"{os.getpid()}-{pc.min(batch.column(0)).as_py()}", "w"):
                        yield batch

            yield from function(told())

        return over

    def first(batches):
        for batch in batches:
            yield batch.slice(0, 1)
            return

    placed = laid(spark)
    found = partitions.map_partitions(placed, counting(first), placed.schema)
    assert rows(found, "id") == [(1,), (2,), (3,), (4,)]
    assert len(list(tmp_path.iterdir())) == 4
    partitions.map_partitions(placed, counting(lambda batches: batches), placed.schema).count()
    assert len(list(tmp_path.iterdir())) >= 200


def test_tagged_rows(spark):
    frame = spark.createDataFrame([(0, "a"), (1, None), (1, "é|")], "k int, v string")
    placed = partitions.laid_out(frame, F.col("k"), 3, ["k"])
    assert rows(partitions.tag_rows(placed, "v")) == [(None,), ("0|a",), ("1|é|",)]
    assert rows(partitions.tag_rows(placed, "k", "tag")) == [("0|0",), ("1|1",), ("1|1",)]


def visits(spark, data):
    return spark.createDataFrame([(datetime.date(2024, 1, d), who, kind) for d, who, kind in data], "day date, who long, kind string")


def measures():
    return {"all": F.col("who"), "buyers": F.when(F.col("kind") == "buy", F.col("who"))}


def between(spark, path, first, last):
    return {r["measure"]: r["n"] for r in bitmaps.distinct_between(bitmaps.stored_bitmaps(spark, path), first, last).collect()}


def test_counts_over_days_and_a_day_added_or_replaced(spark):
    path = scratch_path(spark, "bitmaps")
    data = [(1, 1, "buy"), (1, 1, "buy"), (1, 40_000, "see"), (2, 1, "see"), (2, -7, "buy"), (2, None, "buy"), (3, 2**40, "buy")]
    bitmaps.write_days(visits(spark, data).repartition(5), path, measures(), "day")
    assert between(spark, path, "2024-01-01", "2024-01-03") == {"all": 4, "buyers": 3}
    assert between(spark, path, "2024-01-02", "2024-01-02") == {"all": 2, "buyers": 1}
    assert between(spark, path, "2024-02-01", "2024-02-02") == {}
    kept = {f: os.stat(f).st_mtime_ns for f in _files(path)}
    bitmaps.add_day(visits(spark, data + [(4, 5, "buy"), (1, 9, "buy")]), path, measures(), "day", "2024-01-04")
    assert {f: t for f, t in ((f, os.stat(f).st_mtime_ns) for f in _files(path)) if "dt=2024-01-04" not in f} == kept
    assert between(spark, path, "2024-01-01", "2024-01-04") == {"all": 5, "buyers": 4}
    bitmaps.add_day(visits(spark, [(4, 6, "see")]), path, measures(), "day", "2024-01-04")
    assert between(spark, path, "2024-01-04", "2024-01-04") == {"all": 1}
    ratio = bitmaps.distinct_ratio_between(bitmaps.stored_bitmaps(spark, path), "buyers", "all", "2024-01-01", "2024-01-02").first()
    assert tuple(ratio) == (2, 3, 2 / 3)
    none = bitmaps.distinct_ratio_between(bitmaps.stored_bitmaps(spark, path), "buyers", "all", "2025-01-01", "2025-01-02").first()
    assert tuple(none) == (0, 0, None)


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file://")) for f in names if f.startswith("part-")]


def test_only_the_days_asked_for_are_read(spark):
    path = scratch_path(spark, "bitmaps")
    bitmaps.write_days(visits(spark, [(d, d, "buy") for d in range(1, 9)]), path, measures(), "day")
    found = bitmaps.distinct_between(bitmaps.stored_bitmaps(spark, path), "2024-01-02", "2024-01-03")
    assert "PartitionFilters: [isnotnull(dt" in found._jdf.queryExecution().executedPlan().toString()


def test_one_day_reaches_the_scan(spark, tmp_path):
    visits(spark, [(1, 1, "buy")]).write.parquet(f"{tmp_path}/in")
    read = spark.read.parquet(f"{tmp_path}/in")
    plan = bitmaps.id_bitmaps(read.where(F.col("day") == "2024-01-01"), measures(), "day")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day,2024-01-01)" in plan and "partial_bitmap_construct_agg" in plan
