"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from driftwell.operators import joins, keyed, windows
from driftwell.plans import match_rate
from driftwell.queries import QUERIES


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Queries that run a caller's own Python functions; those run over Arrow batches.
OWN_FUNCTIONS = {"kv_fold_histogram", "fold_histogram", "kv_fold_each", "partition_first_row", "partition_index_rows"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, tables_dir, name):
    plan = plan_of(QUERIES[name](spark, tables_dir))
    for banned in ("BatchEvalPython", "ArrowEvalPython", "PythonRDD", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    assert ("MapInPandas" in plan or "MapInArrow" in plan) == (name in OWN_FUNCTIONS)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("filter_eq", ["PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]"]),
        ("filter_and", ["EqualTo(o_orderstatus,F)", "GreaterThan(o_totalprice,100000.0)"]),
        ("src_parquet", ["GreaterThanOrEqual(l_quantity,49.0)", "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>"]),
        ("rpt_unassigned_groups", ["Not(EqualTo(s_suppkey,85))"]),
        ("kv_count", ["ReadSchema: struct<l_suppkey:bigint>", "partial_count"]),
        ("agg_min_max_avg", ["partial_min", "partial_avg"]),
        ("topk", ["TakeOrderedAndProject"]),
        ("win_first_value", ["WindowGroupLimit"]),
    ],
)
def test_pushdown_pruning_and_partial_aggregates(spark, tables_dir, name, expected):
    plan = plan_of(QUERIES[name](spark, tables_dir))
    for text in expected:
        assert text in plan


def test_details_are_parsed_once(spark, tables_dir):
    for name in ("audit_fields", "audit_entity", "audit_array_elements", "rpt_keyword_create"):
        plan = plan_of(QUERIES[name](spark, tables_dir))
        assert plan.count("from_json(StructField(entityId") + plan.count("from_json(StructField(fields") <= 1


@pytest.fixture
def small_thresholds(spark):
    """Sizes at which the planner acts, scaled down to test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        # the planner must split on its own, without being told to accept extra shuffles
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def skewed(spark):
    """A third of the rows has one key."""
    return spark.range(0, 200_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 5000 END AS k", "xxhash64(id) AS v", "id"
    )


def _collected_plan(frame):
    frame._jdf.collectToPython()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "build",
    [
        lambda f: joins.count_back(f, "k", "n"),
        lambda f: joins.anti_nullsafe(f, f.where("k > 4000"), ["k"]),
        lambda f: windows.first_value(f, ["k"], ["id"], "v", "x"),
        lambda f: keyed.values_by_key(f, "k", "v", "id", part_size=1000),
        lambda f: joins.star_join(f, (f.sparkSession.range(5000).selectExpr("id AS k", "id * 2 AS w"), "k")),
        lambda f: joins.greatest_per_group(f.withColumn("v", F.lit(1)), "k", "v"),
        lambda f: windows.rank(f.withColumn("o", F.lit(1)), ["k"], ["o"], "r", slices=8),
    ],
    ids=["count_back", "anti_nullsafe", "first_value", "values_by_key", "star_join", "greatest_per_group", "rank"],
)
def test_hot_keys_are_split(spark, small_thresholds, build):
    assert "skew=true" in _collected_plan(build(skewed(spark)))


def test_day_of_visits_reaches_the_scan(spark, tmp_path):
    visits = spark.range(10).selectExpr("id AS idvisit", "'u' AS idvisitor", "id * 86400000 AS visit_last_action_time")
    visits.write.parquet(f"{tmp_path}/visits")
    names = {
        "matched": "mvid string, pwid string, pwsid int", "actions": "idaction bigint, name string",
        "links": "idvisit bigint, idaction_url bigint", "profiles": "mvid string, tdid string, bmid string",
    }
    frames = {k: spark.createDataFrame([], v) for k, v in names.items() if k != "links"}
    links = spark.range(10).selectExpr("id AS idvisit", "1L AS idaction_url")
    frames["actions"] = spark.range(1, 2).selectExpr("id AS idaction", "'x' AS name")
    rates = match_rate.match_rate(
        spark, frames["matched"], frames["actions"], spark.read.parquet(f"{tmp_path}/visits"), links, frames["profiles"], url="x", run_date="1970-01-03"
    )
    plan = plan_of(rates)
    assert "GreaterThanOrEqual(visit_last_action_time,86400000)" in plan and "LessThan(visit_last_action_time,172800000)" in plan
    assert rates.first()["unmatched_piwik_users"] == 1.0
