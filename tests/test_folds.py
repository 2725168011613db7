"""Folds with the caller's own functions: results, hot keys, what is sent, awkward keys."""

import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftwell.operators import folds

SUM = folds.Fold(lambda: 0, folds.each(lambda s, v: s + int(v)), lambda a, b: a + b, lambda s: (s,), "total long")


def histogram(values, bins):
    """Straight from the definition."""
    if not values:
        return 1, None, [], 0
    shift = 0
    while (max(values) >> shift) - (min(values) >> shift) >= bins:
        shift += 1
    counts = Counter(v >> shift for v in values)
    places = range(min(counts), max(counts) + 1)
    return 1 << shift, places[0] << shift, [counts[p] for p in places], len(values)


def test_histogram_agrees_with_its_definition(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcd"), rng.randrange(-50, 50) * rng.choice([1, 1, 1000])) for _ in range(2000)]
    rows += [("big", v) for v in (2**62, -(2**62), 0)] + [("one", 7)] * 50 + [("none", None)] * 3 + [("some", None), ("some", 3)]
    frame = spark.createDataFrame(rows, "k string, v long").repartition(7)
    found = {r["k"]: (r["width"], r["first"], r["counts"], r["n"]) for r in folds.fold_by_key(frame, ["k"], ["v"], folds.bounded_histogram(5)).collect()}
    assert found == {k: histogram([v for key, v in rows if key == k and v is not None], 5) for k in {r[0] for r in rows}}


def test_function_of_single_values(spark):
    rows = [(i % 3, str(i)) for i in range(100)]
    found = folds.fold_by_key(spark.createDataFrame(rows, "k int, v string").repartition(4), ["k"], ["v"], SUM)
    assert {r["k"]: r["total"] for r in found.collect()} == {k: sum(range(k, 100, 3)) for k in range(3)}


def test_several_values_and_a_state_of_its_own(spark):
    """Covers of intervals: no built-in aggregate merges them."""

    def merged(spans):
        out = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return out

    fold = folds.Fold(
        list,
        folds.each(lambda s, a, b: [*s, [a, b]]),
        lambda a, b: merged(a + b),
        lambda s: (sum(b - a for a, b in merged(s)),),
        "covered long",
    )
    rows = [(i % 2, i, i + 3) for i in range(0, 60, 5)] + [(0, 100, 101), (0, 100, 101)]
    frame = spark.createDataFrame(rows, "k int, a long, b long").repartition(5)
    found = {r["k"]: r["covered"] for r in folds.fold_by_key(frame, ["k"], ["a", "b"], fold).collect()}
    assert found == {0: 18 + 1, 1: 18}


def test_without_keys(spark):
    frame = spark.range(1000, numPartitions=9)
    assert [r["total"] for r in folds.fold_by_key(frame, [], ["id"], SUM).collect()] == [499500]
    assert [r["total"] for r in folds.fold_by_key(frame.where("id < 0"), [], ["id"], SUM).collect()] == [0]
    counting = folds.Fold(lambda: 0, lambda s, v: s + len(v), lambda a, b: a + b, lambda s: (s,), "n long")
    assert folds.fold_by_key(frame, [], [], counting).first()["n"] == 1000
    assert folds.fold_by_key(frame.where("id < 0"), ["id"], ["id"], SUM).count() == 0


def test_awkward_keys_keep_their_types(spark):
    day = "DATE '2024-02-29'"
    texts = ["", "null", "a,b", '"', "é\n", None]
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(texts)] * 2, "key string, v0 long")
    frame = frame.withColumns(
        {
            "k 1": F.when(F.col("v0") > 1, F.col("v0") + 2**60),
            "state": F.expr(f"IF(v0 > 2, {day}, NULL)"),
            "_key": F.col("v0").cast("decimal(20,3)"),
            "k0": F.col("v0") > 3,
        }
    )
    keys = ["key", "k 1", "state", "_key", "k0"]
    found = folds.fold_by_key(frame.repartition(3), keys, ["v0"], SUM)
    assert [found.schema[k].dataType for k in keys] == [frame.schema[k].dataType for k in keys]
    expected = frame.groupBy(*keys).agg(F.sum("v0").alias("total"))
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    assert Decimal("3.000") in {r["_key"] for r in found.collect()}
    with pytest.raises(ValueError, match="double"):
        folds.fold_by_key(frame.withColumn("x", F.lit(1.0)), ["x"], ["v0"], SUM)


def test_a_hot_key_costs_a_state_a_task(spark, tmp_path):
    """Half of all rows share a key, and each combine is told: no values are sent, only states."""
    told = tmp_path / "combined"
    told.mkdir()

    def comb(a, b):
        with (told / f"{a}-{b}-{random.random()}").open("w"):
            return a + b

    fold = folds.Fold(lambda: 0, lambda s, v: s + len(v), comb, lambda s: (s,), "n long")
    tasks = 20
    rows = spark.range(40_000, numPartitions=tasks).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"))
    found = {r["k"]: r["n"] for r in folds.fold_by_key(rows, ["k"], [], fold).collect()}
    assert found["hot"] == 20_000 and len(found) == 51
    assert len(list(told.iterdir())) == 51 * (tasks - 1)


def test_many_open_keys_are_sent_on(spark):
    rows = spark.range(3000, numPartitions=2).select((F.col("id") % 500).alias("k"), "id")
    found = folds.fold_by_key(rows, ["k"], ["id"], SUM, open_keys=10)
    assert {r["k"]: r["total"] for r in found.collect()} == {k: sum(range(k, 3000, 500)) for k in range(500)}


def test_nothing_but_maps_and_sorted_shuffles(spark):
    plan = folds.fold_by_key(spark.range(10), ["id"], ["id"], SUM)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "FlatMapGroups" not in plan and "Window" not in plan
    assert plan.count("MapInPandas") == 3


def no_frames(*_args):
    raise AssertionError("a frame for one key")


def test_a_histogram_takes_the_keys_of_a_batch_together():
    """No call of the fold by a frame of one key: as many keys as rows were as many such calls."""
    whole = folds.bounded_histogram(5)
    fold = folds.Fold(whole.zero, no_frames, whole.comb, whole.finish, whole.schema, seq_keys=whole.seq_keys)
    rng = random.Random(2)
    states, rows = {}, []
    for _ in range(3):
        part = [(f"k{rng.randrange(200)}", rng.choice([None, 0, -1, 5, 2**40, -(2**50), rng.randrange(-99, 99)])) for _ in range(300)]
        folds._fold_in(fold, states, pd.DataFrame(part, columns=["key", "v0"]))
        rows += part
    limits = [("far", v) for v in (2**63 - 1, -(2**63), 0, 1)]
    folds._fold_in(fold, states, pd.DataFrame(limits, columns=["key", "v0"]))
    found = {k: fold.finish(s) for k, s in states.items()}
    expected = {k: histogram([v for key, v in rows + limits if key == k and v is not None], 5) for k in {r[0] for r in rows + limits}}
    assert found == expected


def test_frames_of_a_key_hold_its_rows_of_many_batches(spark):
    """Five batches of 10,000 rows of 100 keys: one call for a key, where five were made."""
    calls = folds.Fold(lambda: 0, lambda s, v: s + 1, lambda a, b: a + b, lambda s: (s,), "calls long")
    rows = spark.range(50_000, numPartitions=1).select((F.col("id") % 100).alias("k"), "id")
    assert {r["calls"] for r in folds.fold_by_key(rows, ["k"], ["id"], calls).collect()} == {1}


def test_batches_are_put_together_within_bounds(monkeypatch):
    monkeypatch.setattr(folds, "TOGETHER_ROWS", 25)
    whole, holes = pd.DataFrame({"key": ["a"] * 10, "v0": range(10)}), pd.DataFrame({"key": ["a"] * 10, "v0": [None, *range(9)]})
    given = [whole, whole, whole, holes, whole]
    found = list(folds._together(iter(given)))
    assert [len(f) for f in found] == [20, 10, 10, 10]
    assert [f["v0"].dtype for f in found] == [np.int64, np.int64, np.float64, np.int64]
    monkeypatch.setattr(folds, "TOGETHER_BYTES", 1)
    assert [len(f) for f in folds._together(iter(given))] == [10] * 5


def test_functions_of_single_rows_meet_no_frame(monkeypatch):
    """As many keys as rows were as many frames."""
    monkeypatch.setattr(pd.DataFrame, "itertuples", no_frames)
    fold = folds.Fold(lambda: 0, folds.each(lambda s, a, b: s + int(a) * b), lambda a, b: a + b, lambda s: (s,), "n long")
    states = {"k1": 5}
    folds._fold_in(fold, states, pd.DataFrame([("k1", "2", 3), ("k2", "7", 1), ("k1", "1", 1)], columns=["key", "v0", "v1"]))
    assert states == {"k1": 12, "k2": 7}
