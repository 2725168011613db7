"""Ordinary and sliced windows against hand-made and brute-force results."""

import random
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from conftest import rows
from driftwell.operators import windows
from driftwell.sources.writers import stage

EMPLOYEES = [
    (1, "north", 900),
    (2, "north", 1250),
    (3, "north", 1250),
    (4, "north", 3000),
    (5, "south", 1100),
    (6, "south", None),
    (7, "south", 1100),
    (8, None, 700),
    (9, None, 800),
]


def employees(spark):
    return spark.createDataFrame(EMPLOYEES, "id int, dept string, sal int").repartition(3)


BOTH = pytest.mark.parametrize("slices", [None, 1, 5])


@BOTH
def test_row_number(spark, slices):
    got = rows(windows.row_number(employees(spark), ["dept"], ["id"], "n", slices=slices), "id", "n")
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (6, 2), (7, 3), (8, 1), (9, 2)]


@BOTH
def test_rank_and_dense_rank_descending_with_ties_and_null(spark, slices):
    got = rows(windows.rank(employees(spark), ["dept"], ["-sal"], "r", slices=slices), "id", "r")
    assert got == [(1, 4), (2, 2), (3, 2), (4, 1), (5, 1), (6, 3), (7, 1), (8, 2), (9, 1)]
    got = rows(windows.dense_rank(employees(spark), ["dept"], ["-sal"], "r", slices=slices), "id", "r")
    assert got == [(1, 3), (2, 2), (3, 2), (4, 1), (5, 1), (6, 2), (7, 1), (8, 2), (9, 1)]


@BOTH
def test_running_sum_is_shared_by_ties(spark, slices):
    got = rows(windows.running_sum(employees(spark), ["dept"], ["sal"], "sal", "t", slices=slices), "id", "t")
    assert got == [
        (1, 900), (2, 3400), (3, 3400), (4, 6400), (5, 2200), (6, None), (7, 2200), (8, 700), (9, 1500),
    ]


@BOTH
def test_lead_and_lag(spark, slices):
    frame = employees(spark)
    got = rows(windows.lead(frame, ["dept"], ["sal", "id"], "id", "x", slices=slices), "id", "x")
    assert got == [(1, 2), (2, 3), (3, 4), (4, None), (5, 7), (6, 5), (7, None), (8, 9), (9, None)]
    got = rows(windows.lag(frame, ["dept"], ["sal", "id"], "id", "x", slices=slices), "id", "x")
    assert got == [(1, None), (2, 1), (3, 2), (4, 3), (5, 6), (6, None), (7, 5), (8, None), (9, 8)]


def test_first_and_last_value(spark):
    frame = employees(spark)
    got = rows(windows.first_value(frame, ["dept"], ["sal", "id"], "id", "x"), "id", "x")
    assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 6), (6, 6), (7, 6), (8, 8), (9, 8)]
    got = rows(windows.last_value(frame, ["dept"], ["sal", "id"], "id", "x"), "id", "x")
    assert got == [(1, 4), (2, 4), (3, 4), (4, 4), (5, 7), (6, 7), (7, 7), (8, 9), (9, 9)]


ROW = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "cold", None]),
    st.one_of(st.none(), st.integers(-3, 3), st.just(7)),
    st.one_of(st.none(), st.integers(0, 9)),
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(ROW, min_size=1, max_size=80))
def test_sliced_equals_ordinary(spark, data):
    frame = spark.createDataFrame(
        [(i, k, o, v) for i, (k, o, v) in enumerate(data)], "id int, k string, o int, v int"
    ).repartition(4)
    for call in (
        lambda h: windows.row_number(frame, ["k"], ["o", "id"], "x", slices=h),
        lambda h: windows.row_number(frame, ["k"], ["-o", "id"], "x", slices=h),
        lambda h: windows.row_number(frame, [], ["-o", "-id"], "x", slices=h),
        lambda h: windows.lead(frame, ["k"], ["o", "id"], "v", "x", slices=h),
        lambda h: windows.lag(frame, ["k"], ["-o", "id"], "v", "x", slices=h),
        lambda h: windows.rank(frame, ["k"], ["o"], "x", slices=h),
        lambda h: windows.dense_rank(frame, ["k"], ["-o"], "x", slices=h),
        lambda h: windows.running_sum(frame, ["k"], ["o"], "v", "x", slices=h),
    ):
        assert rows(call(4), "id", "x") == rows(call(None), "id", "x")


def test_sliced_orders_and_values_of_other_types(spark):
    """Any sortable type in either direction; the same rows and the same result types both ways."""
    chosen = random.Random(5)
    data = [(i, chosen.choice("abé") * chosen.randint(0, 4) if i % 9 else None, date(2020, 1, 1 + i % 28), i / 7) for i in range(200)]
    chosen.shuffle(data)
    frame = spark.createDataFrame(data, "id int, s string, d date, f double").withColumns(
        {
            "t": F.expr("timestamp_micros(id % 40 * 3600000000)"),
            "b": F.expr("id % 2 = 0"),
            "raw": F.expr("cast(s AS binary)"),
            "m": F.expr("cast(if(id % 5 = 0, null, id) / 3 AS decimal(18,2))"),
            "k": F.expr("named_struct('a', id % 3)"),
        }
    )
    for order in (["s", "id"], ["-s", "id"], ["raw", "-id"], ["-raw", "id"], ["-d", "s", "id"], ["-f"], ["-t", "id"], ["-b", "id"], ["-m", "id"]):
        for call in (
            lambda n: windows.row_number(frame, ["k"], order, "x", slices=n),
            lambda n: windows.lead(frame, [], order, "m", "x", slices=n),
            lambda n: windows.lag(frame, [], order, "s", "x", slices=n),
            lambda n: windows.rank(frame, [], order[:1], "x", slices=n),
            lambda n: windows.dense_rank(frame, [], order[:1], "x", slices=n),
            lambda n: windows.running_sum(frame, [], order[:1], "m", "x", slices=n),
        ):
            sliced, ordinary = call(7), call(None)
            assert sliced.schema["x"].dataType == ordinary.schema["x"].dataType
            assert rows(sliced, "id", "x") == rows(ordinary, "id", "x")
        first = {r["id"]: r for r in windows.first_value(frame, [], order, "id", "x").collect()}
        last = {r["id"]: r for r in windows.last_value(frame, [], order, "id", "x").collect()}
        placed = rows(windows.row_number(frame, [], order, "n"), "n", "id")
        assert {r["x"] for r in first.values()} == {placed[0][1]} and {r["x"] for r in last.values()} == {placed[-1][1]}


def test_hot_key_is_cut_into_balanced_slices(spark, monkeypatch):
    """A key with a third of the rows, and an order value held by half of them."""
    staged = []
    monkeypatch.setattr(windows, "stage", lambda frame, path: staged.append(stage(frame, path)) or staged[-1])
    frame = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "CASE WHEN id % 2 = 0 THEN 5 ELSE id END AS o"
    )
    sliced = windows.row_number(frame, ["k"], ["o", "id"], "x", slices=16)
    ordinary = windows.row_number(frame, ["k"], ["o", "id"], "x")
    assert sliced.exceptAll(ordinary).count() == 0 and sliced.count() == 30_000
    assert staged[0].groupBy("_s").count().selectExpr("max(count)").first()[0] < 2 * 30_000 / 16
    assert staged[0].where("k = -1").select("_s").distinct().count() > 4
