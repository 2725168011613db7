"""Days of many tables: whole before, whole behind, few jobs."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from driftwell.operators.reshape import duplicate_profile
from driftwell.plans import audit_log as plan
from driftwell.queries.audit_data import audit_log
from driftwell.queries.catalog import Tables
from driftwell.session import scratch_path
from driftwell.sources import publish

DAY = "2024-01-01"


def tables_of(spark, n, also=()):
    same = {f"kind/{i}": spark.range(i, i + n).withColumn("name", F.lit(f"t{i}")) for i in range(4)}
    return same | {"other": spark.range(n).select(F.col("id").cast("string").alias("x"))} | dict(also)


def contents(spark, target, names):
    return {n: rows(spark.read.parquet(f"{target}/{n}/dt={DAY}")) for n in names}


def test_tables_are_where_they_should_be_with_their_own_columns(spark):
    target = scratch_path(spark, "publish")
    tables = tables_of(spark, 3, {"kind": spark.range(2), "empty": spark.range(0).withColumn("y", F.lit("y"))})
    publish.publish_day(spark, target, DAY, tables)
    assert contents(spark, target, tables) == {n: rows(f) for n, f in tables.items()}
    assert all(spark.read.parquet(f"{target}/{n}/dt={DAY}").columns == f.columns for n, f in tables.items())
    assert publish.day_is_whole(spark, target, DAY) and not publish.day_is_whole(spark, target, "2024-01-02")
    publish.publish_day(spark, target, DAY, tables_of(spark, 1), ["kind", "empty"])
    assert contents(spark, target, tables_of(spark, 1)) == {n: rows(f) for n, f in tables_of(spark, 1).items()}
    assert not os.path.exists(f"{target}/empty/dt={DAY}") and os.path.exists(f"{target}/kind/0/dt={DAY}")
    assert not os.listdir(f"{target}/_incoming")
    with pytest.raises(FileExistsError):
        publish.publish_day(spark, target, DAY, tables, overwrite=False)


def test_a_failure_before_the_renames_leaves_the_old_day_whole(spark):
    target = scratch_path(spark, "publish-fail")
    old, new = tables_of(spark, 2), tables_of(spark, 5)
    publish.publish_day(spark, target, DAY, old)

    def die():
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        publish.publish_day(spark, target, DAY, new, before_renames=die)
    broken = new | {"broken": spark.range(1).select(F.raise_error(F.lit("no")).alias("x"))}
    with pytest.raises(Exception, match="no"):
        publish.publish_day(spark, target, DAY, broken)
    assert contents(spark, target, old) == {n: rows(f) for n, f in old.items()}
    assert publish.day_is_whole(spark, target, DAY)
    publish.publish_day(spark, target, DAY, new)
    assert contents(spark, target, new) == {n: rows(f) for n, f in new.items()}


@pytest.mark.parametrize("at", range(5))
def test_a_failure_between_the_renames_is_made_good(spark, monkeypatch, at):
    target = scratch_path(spark, "publish-between")
    old, new = tables_of(spark, 2, {"left": spark.range(1)}), tables_of(spark, 5)
    publish.publish_day(spark, target, DAY, old)
    real, made = publish._rename, []

    def rename(spark, before, after):
        if "dt=" in after:
            if len(made) == at:
                raise OSError("lost")
            made.append(after)
        real(spark, before, after)

    monkeypatch.setattr(publish, "_rename", rename)
    with pytest.raises(OSError):
        publish.publish_day(spark, target, DAY, new, ["left"])
    assert not publish.day_is_whole(spark, target, DAY)
    monkeypatch.setattr(publish, "_rename", real)
    assert publish.finish_day(spark, target, DAY) and not publish.finish_day(spark, target, DAY)
    assert contents(spark, target, new) == {n: rows(f) for n, f in new.items()}
    assert publish.day_is_whole(spark, target, DAY) and not os.path.exists(f"{target}/left/dt={DAY}")


def test_written_tables_hold_what_each_output_gives(spark, tables_dir, monkeypatch):
    """Row by row, every table of the shredding job; as many jobs write them as there are schemas."""
    log = audit_log(Tables(spark, tables_dir))
    target = scratch_path(spark, "shred-contents")
    groups = []
    real = publish._by_schema
    monkeypatch.setattr(publish, "_by_schema", lambda tables: groups.extend(real(tables)) or groups)
    names = plan.shred_day(log, target, DAY, f"{target}-staging")
    parsed = plan.parse_log(log).cache()
    assert len(names) == len(plan.OUTPUTS) and len(groups) < len(names) * 2 / 3
    for name in names:
        written = spark.read.parquet(f"{target}/{name}/dt={DAY}")
        expected = plan.OUTPUTS[name].build(parsed)
        assert written.columns == expected.columns
        digest = [F.count("*"), F.sum(F.xxhash64(*expected.columns).cast("decimal(38,0)"))]
        assert written.agg(*digest).first() == expected.agg(*digest).first(), name
    parsed.unpersist()


def test_duplicate_profile_counts_rows_that_are_equal(spark):
    nan = float("nan")
    data = [(1, "a", 0.0), (1, "a", -0.0), (1, "a", 0.0), (2, None, nan), (2, None, nan), (None, None, None), (None, None, None), (3, "x", 1.0)]
    frame = spark.createDataFrame(data, "_n int, `a b` string, _hash2 double").repartition(3)
    assert tuple(duplicate_profile(frame).first()) == (8, 4)
    assert tuple(duplicate_profile(frame.where("false")).first()) == (0, 0)
    plan_ = duplicate_profile(spark.range(10).selectExpr("id", "'wide' AS w"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_hash" in plan_ and plan_.count("Exchange hashpartitioning(id") == 0
