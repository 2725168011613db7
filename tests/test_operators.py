"""Joins, keyed aggregation, sets, reshaping, partitions, expressions."""

import math
import time
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from driftwell.functions.numbers import percent, safe_ratio
from driftwell.functions.text import is_json_array, jvm_split
from driftwell.functions.time import day_bounds_ms, days_before, epoch_ms_to_day, previous_day
from driftwell.operators import joins, keyed, partitions, reshape, sampling, sets
from driftwell.plans.auctions import bids_per_item


def pairs(spark, data, schema="k int, v int"):
    return spark.createDataFrame(data, schema)


def test_anti_join_keeps_repeats_and_matches_nulls(spark):
    left = pairs(spark, [(1, 0), (1, 1), (2, 0), (None, 0), (None, 1), (3, 0)])
    right = pairs(spark, [(2, 9), (2, 9), (None, 9)])
    assert rows(joins.anti_nullsafe(left, right, ["k"]), "k", "v") == [(1, 0), (1, 1), (3, 0)]


VALUES = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=VALUES, second=VALUES)
def test_set_laws(spark, first, second):
    a, b = pairs(spark, [(v,) for v in first], "k int"), pairs(spark, [(v,) for v in second], "k int")

    def bag(frame):
        return Counter(r[0] for r in frame.collect())

    assert bag(sets.union_all(a, b)) == Counter(first) + Counter(second)
    assert bag(sets.union_distinct(a, b)) == Counter(set(first) | set(second))
    assert bag(sets.intersect(a, b)) == Counter(set(first) & set(second))
    assert bag(sets.subtract_bag(a, b)) == Counter(v for v in first if v not in set(second))


def test_ranges_of_the_tour(spark):
    a, b = spark.range(5, 11), spark.range(7, 16)
    union = sets.union_all(a, b)
    common = sets.intersect(a, b)
    assert [r[0] for r in rows(common)] == [7, 8, 9, 10]
    assert [r[0] for r in rows(sets.subtract_bag(union, common))] == [5, 6, 11, 12, 13, 14, 15]


def test_count_back_drops_null_keys(spark):
    frame = pairs(spark, [(1, 5), (1, 6), (2, 7), (None, 8)])
    assert rows(joins.count_back(frame, "k", "n"), "k", "v", "n") == [(1, 5, 2), (1, 6, 2), (2, 7, 1)]


def test_greatest_per_group_keeps_ties_and_repeats(spark):
    frame = pairs(spark, [(1, 5), (1, 9), (1, 9), (2, None), (2, 3), (None, 4), (3, None)])
    assert rows(joins.greatest_per_group(frame, "k", "v"), "k", "v") == [(1, 9), (1, 9), (2, 3)]


def test_join_pairs(spark):
    a, b = pairs(spark, [("abe", 1), ("apple", 1)], "k string, v int"), pairs(spark, [("apple", 2), ("bea", 2)], "k string, v int")
    assert rows(joins.join_pairs(a, b)) == [("apple", 1, 2)]
    assert rows(joins.join_pairs(a, b, "left")) == [("abe", 1, None), ("apple", 1, 2)]
    assert rows(joins.join_pairs(a, b, "right")) == [("apple", 1, 2), ("bea", None, 2)]


def test_values_by_key_splits_hot_keys_and_keeps_every_value(spark):
    data = [(i % 4 if i % 3 else 0, i) for i in range(600)] + [(None, 1000), (None, 1001)]
    lists = keyed.values_by_key(pairs(spark, data), "k", "v", "v", part_size=50).collect()
    found = {}
    for row in lists:
        assert row["values"] == sorted(row["values"]) and len(row["values"]) < 100
        found.setdefault(row["k"], []).extend(row["values"])
    expected = {}
    for k, v in data:
        expected.setdefault(k, []).append(v)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    parts = {row["k"]: row["parts"] for row in lists}
    assert parts[0] == -(-len(expected[0]) // 50) and parts[None] == 1


def test_keyed_sums_and_counts(spark):
    frame = pairs(spark, [("a", "1"), ("a", "2"), ("b", "5")], "k string, v string")
    assert rows(keyed.sum_by_key(frame, "k", "v")) == [("a", 3.0), ("b", 5.0)]
    assert rows(keyed.count_by_key(frame, "k")) == [("a", 2), ("b", 1)]


def test_sums_and_means_keep_every_digit(spark):
    frame = spark.createDataFrame([("a", 0.9), ("a", 0.9), ("b", 1e17)], "k string, v double")
    assert rows(keyed.sum_by_key(frame, "k", "v")) == [("a", 1.8), ("b", 1e17)]
    bids = spark.createDataFrame([("x", 0.001), ("x", 0.002), ("x", 0.004), ("y", 1e17), ("z", None)], "item string, bid double")
    means = {r["item"]: r["avg_bid"] for r in bids_per_item(bids).collect()}
    assert means["x"] == pytest.approx(0.007 / 3) and means["y"] == 1e17 and means["z"] is None


def test_pivot_takes_the_first_row_and_names_the_null_column(spark):
    data = [(1, "A", "201701", "I", 1), (1, "A", "201701", "Z", 2), (1, "A", "201702", "D", 3), (2, None, None, None, 4)]
    frame = spark.createDataFrame(data, "tid int, tkr string, dt string, stat string, id int")
    labelled = frame.withColumn("p", F.concat(F.lit("T"), "dt"))
    wide = reshape.pivot_first(labelled, ["tid", "tkr"], "p", "stat", "id", ["T201701", "T201702", "null"])
    assert rows(wide, "tid", "T201701", "T201702", "null") == [(1, "I", "D", None), (2, None, None, None)]
    filled = reshape.fill_null(wide, "N/A", ["T201701", "T209901"])
    assert rows(filled, "tid", "T201701", "T201702") == [(1, "I", "D"), (2, "N/A", None)]
    # long again
    back = wide.unpivot(["tid", "tkr"], ["T201701", "T201702"], "p", "stat").where("stat is not null")
    assert rows(back, "tid", "p", "stat") == [(1, "T201701", "I"), (1, "T201702", "D")]


def test_eav_to_wide(spark):
    data = [
        (1, "a", "x", 0), (1, "b", "y", 1), (1, "a", "z", 2), (1, "c", "w", 3),  # a twice, c not asked for
        (2, "a", None, 0), (2, "b", "y", 1),  # present but null
        (3, "a", "x", 0),  # b missing
    ]
    frame = spark.createDataFrame(data, "id int, f string, v string, pos int")
    assert rows(reshape.eav_to_wide(frame, "id", "f", "v", "pos", ["a", "b"])) == [(1, "z", "y"), (2, None, "y")]


def test_duplicate_profile(spark):
    frame = pairs(spark, [(1, None), (1, None), (1, 2)])
    assert rows(reshape.duplicate_profile(frame)) == [(3, 2)]
    assert rows(reshape.duplicate_profile(frame.limit(0))) == [(0, 0)]


def test_values_by_key_depend_on_the_key_alone(spark):
    """The same parts for any partitioning and whatever other keys hold."""
    frame = spark.range(1050).selectExpr("1 AS k", "id AS v")
    other = spark.range(5000).selectExpr("2 AS k", "id AS v")
    expected = rows(keyed.values_by_key(frame, "k", "v", "v", part_size=1000))
    assert [r[2] for r in expected] == [2, 2]
    for n in (1, 3, 9):
        found = keyed.values_by_key(frame.union(other).repartition(n), "k", "v", "v", part_size=1000)
        assert rows(found.where("k = 1")) == expected


def test_partitions(spark):
    ids = partitions.id_range(spark, 0, 10, partitions=4)
    assert ids.rdd.getNumPartitions() == 4
    assert rows(partitions.first_per_partition(ids, "id")) == [(0, 0), (1, 2), (2, 5), (3, 7)]
    assert {"0|1", "3|9"} <= {r[0] for r in partitions.tag_partition(ids, "id").collect()}
    assert rows(partitions.id_range(spark, 5, 11, step=5, partitions=1)) == [(5,), (10,)]
    assert partitions.id_range(spark, 0, 0, partitions=3).count() == 0


def test_sample_with_replacement_repeats_and_can_be_repeated(spark):
    ids = spark.range(20_000)
    drawn = sampling.sample_with_replacement(ids, "id", 0.4, 3)
    copies = Counter(Counter(r[0] for r in drawn.collect()).values())
    expected = [20_000 * share for share in (0.4 * math.exp(-0.4), 0.08 * math.exp(-0.4))]
    assert all(abs(copies[n + 1] - e) < 0.1 * e for n, e in enumerate(expected))
    for n in (2, 3, 5):
        assert rows(sampling.sample_with_replacement(ids.repartition(n), "id", 0.4, 3)) == rows(drawn)
    assert rows(sampling.sample_with_replacement(ids, "id", 0.4, 4)) != rows(drawn)
    assert sampling.poisson_thresholds(2.5)[-1] == sampling.POISSON_STEPS


@pytest.mark.parametrize(
    "text, separator, expected",
    [
        ("a b", " ", ["a", "b"]), ("", " ", [""]), ("   ", " ", []), (" a  b  ", " ", ["", "a", "", "b"]),
        ("a,,b,,", ",", ["a", "", "b"]), ("x|y", "|", ["x", "y"]), ("a \n", " ", ["a", "\n"]), ("l1\n\nl2\n", "\n", ["l1", "", "l2"]),
    ],
)
def test_jvm_split(spark, text, separator, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(jvm_split(F.col("t"), separator)).first()[0] == expected


def test_jvm_split_is_linear(spark):
    """Long inner runs of the separator must not be looked at again and again."""
    run = 100_000
    frame = spark.range(20).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), run), F.lit("b")).alias("t"))
    frame.select(F.size(jvm_split(F.col("t"), " "))).first()
    began = time.perf_counter()
    assert {r[0] for r in frame.select(F.size(jvm_split(F.col("t"), " "))).collect()} == {run + 1}
    assert time.perf_counter() - began < 10
    with pytest.raises(ValueError):
        jvm_split(F.col("t"), "||")


def test_expressions(spark):
    frame = spark.createDataFrame([(1, 4, "[1]"), (1, 0, " [2]"), (None, 1, "x"), (2, 8, None)], "a int, b int, t string")
    assert [r[0] for r in frame.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None, 0.25]
    assert [r[0] for r in frame.select(percent(F.col("a"), F.col("b"))).collect()] == [25.0, None, None, 25.0]
    assert [r[0] for r in frame.select(is_json_array(F.col("t"))).collect()] == [True, True, False, False]


def test_dates(spark):
    frame = spark.createDataFrame([(1_704_931_199_999,), (1_704_931_200_000,), (-1,)], "ms bigint")
    assert [r[0] for r in frame.select(epoch_ms_to_day(F.col("ms"))).collect()] == ["2024-01-10", "2024-01-11", "1969-12-31"]
    assert day_bounds_ms("2024-01-10") == (1_704_844_800_000, 1_704_931_200_000)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert [r[0] for r in frame.select(epoch_ms_to_day(F.col("ms"))).collect()] == ["2024-01-10", "2024-01-11", "1969-12-31"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    assert str(frame.select(days_before("2024-03-01")).first()[0]) == "2024-02-29"
    assert previous_day("2024-03-01") == "2024-02-29" and previous_day("2024-01-01", 2) == "2023-12-30"
