"""Products by key against nested loops, hot keys, and dictionaries of large columns."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftwell.operators.products import product_by_key
from driftwell.operators.reshape import pivot_discovered, pivot_values
from driftwell.plans import features, keyword_reports
from driftwell.schemas import AUDIT_LOG

PARTS = ("a", "b", "c")


def nested(rows, parts):
    held = {}
    for key, part, value in rows:
        held.setdefault(key, {}).setdefault(part, []).append(value)
    found = Counter()
    for key, by_part in held.items():
        if key is not None and all(p in by_part for p in parts):
            found.update((key, *combined) for combined in itertools.product(*[by_part[p] for p in parts]))
    return found


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "id long, part string, value string").repartition(4)


@pytest.mark.parametrize("block", [1, 2, 8])
def test_agrees_with_nested_loops(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice([1, 1, 2, 3, 4, None]), rng.choice("aabcx"), rng.choice(["u", "v", None, str(rng.random())])) for _ in range(150)]
    rows += [(9, "a", "x"), (9, "b", "x"), (8, "a", None), (8, "b", None), (8, "c", None)]
    found = product_by_key(frame_of(spark, rows), "id", "part", "value", PARTS, block=block)
    assert found.columns == ["id", *PARTS]
    assert Counter(map(tuple, found.collect())) == nested(rows, PARTS)


def test_one_part_and_no_rows(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "b", "y")]
    assert Counter(map(tuple, product_by_key(frame_of(spark, rows), "id", "part", "value", ["a"]).collect())) == Counter({(1, "x"): 2})
    assert product_by_key(frame_of(spark, []), "id", "part", "value", PARTS).count() == 0


def test_a_key_with_a_third_of_the_rows_is_spread(spark):
    """6,000 values of one key, all in one part: its result must come from many tasks, in even shares."""
    hot = [(0, "a", str(i)) for i in range(6000)] + [(0, p, p) for p in "bc"]
    rest = [(1 + i % 4000, PARTS[i % 3], "v") for i in range(12000)]
    found = product_by_key(frame_of(spark, hot + rest), "id", "part", "value", PARTS)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by_task = found.where("id = 0").groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    counts = [r["n"] for r in by_task]
    assert sum(counts) == 6000 and len(counts) == 8 and max(counts) < 2 * 6000 / 8


def test_repeats_of_all_six_fields(spark):
    import json

    fields = [(name, f"{name}{i}") for n, name in enumerate(keyword_reports.CREATE_FIELDS) for i in range(1 + n % 3)]
    halves = [fields[::2], fields[1::2]]

    def record(user, given):
        details = {"fields": [{"fieldName": f, "newValue": v, "oldValue": None} for f, v in given]}
        return (5, user, 1, "MV_Keyword", "Create", json.dumps(details), "t", "w")

    log = spark.createDataFrame([record("ann", halves[0]), record("bob", halves[1]), record("eve", [])], AUDIT_LOG)
    found = keyword_reports.create_report(keyword_reports.keyword_records(log))
    held = [[f"{name}{i}" for i in range(1 + n % 3)] for n, name in enumerate(keyword_reports.CREATE_FIELDS)]
    expected = Counter((5, user, "t", *combined) for user in ("ann", "bob", "eve") for combined in itertools.product(*held))
    assert sum(expected.values()) == 3 * 36
    assert Counter(map(tuple, found.collect())) == expected


def test_dictionary_numbers_every_column_in_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "é", "a", "B", "", f"v{rng.randrange(300)}"]), rng.randrange(40), "same") for _ in range(2000)]
    frame = spark.createDataFrame(rows, "x string, column int, value string").repartition(5)
    expected = set()
    for i, name in enumerate(["x", "column", "value"]):
        texts = {None if r[i] is None else str(r[i]) for r in rows}
        ordered = sorted(texts, key=lambda v: (v is not None, (v or "").encode()))
        expected |= {(name, v, n) for n, v in enumerate(ordered)}
    for slices in (None, 1, 7, 50):
        assert {tuple(r) for r in features.category_indexes(frame, ["x", "column", "value"], slices=slices).collect()} == expected
    assert features.category_indexes(frame.where("false"), ["x"]).count() == 0


def test_rows_meet_their_indexes_in_one_join(spark):
    rows = [(i, None if i % 5 == 0 else f"c{i % 7}", i % 3, float(i)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, carrier string, dest int, rest double")
    found = features.with_category_indexes(frame, ["carrier", "dest"])
    carriers = sorted({r[1] for r in rows}, key=lambda v: (v is not None, v or ""))
    expected = {(i, float(carriers.index(c)), float(d), r) for i, c, d, r in rows}
    assert found.columns == frame.columns and {tuple(r) for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "RowNumber" not in plan


def test_no_window_numbers_a_column(spark):
    frame = spark.range(100).selectExpr("cast(id % 13 AS string) AS c")
    plan = features.category_indexes(frame, ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_pivot_finds_its_columns(spark):
    rows = [("k", "b", "2", 2), ("k", "b", "1", 1), ("k", None, "n", 3), ("l", "a c", None, 4), ("l", "é", "x", 5)]
    frame = spark.createDataFrame(rows, "tid string, p string, stat string, id int").repartition(3)
    wide = pivot_discovered(frame, ["tid"], "p", "stat", "id")
    assert wide.columns == ["tid", "a c", "b", "null", "é"]
    assert sorted(map(tuple, wide.collect())) == [("k", None, "1", "n", None), ("l", None, None, None, "x")]
    assert pivot_discovered(frame.where("false"), ["tid"], "p", "stat", "id").columns == ["tid"]


def test_too_many_or_clashing_pivot_values_are_an_error(spark):
    frame = spark.range(20).selectExpr("id AS tid", "id AS p", "id AS stat")
    assert len(pivot_values(frame, "p", limit=20)) == 20
    with pytest.raises(ValueError, match="more than 19"):
        pivot_discovered(frame, ["tid"], "p", "stat", "stat", limit=19)
    with pytest.raises(ValueError, match="tid"):
        pivot_discovered(frame.withColumn("p", F.lit("tid")), ["tid"], "p", "stat", "stat")
