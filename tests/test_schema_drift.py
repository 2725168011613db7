"""Paths of JSON documents against a plain walk, and drift against the fixed schema."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftwell.operators import json_paths
from driftwell.plans import schema_drift


def walk(value, path="$"):
    if isinstance(value, dict):
        yield path, "OBJECT"
        for key, inner in value.items():
            plain = key.isascii() and key.replace("_", "a").isalnum()
            yield from walk(inner, f"{path}.{key}" if plain else f'{path}."{key}"')
    elif isinstance(value, list):
        yield path, "ARRAY"
        for inner in value:
            yield from walk(inner, f"{path}[]")
    else:
        kinds = {type(None): "VOID", bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", str: "STRING"}
        yield path, kinds[type(value)]


DOCUMENTS = [
    {"a": 1, "b": [1, 2.5, {"c": "x", "d": None}], "e": {}, "f": [], "g.h": True},
    {"a": "one", "b": {"c": [[], [[1]], None]}},
    {"a": None, "": 3, "é": "x"},
    [1, [2, "q"], {}],
    [],
    "text",
    7,
    None,
    {"deep": {"er": {"and": {"er": [1]}}}},
]


def paths(frame, *columns):
    return Counter({tuple(r[c] for c in columns): r["n"] for r in frame.collect()})


def test_paths_and_types_as_by_a_plain_walk(spark):
    rows = [(i % 2, json.dumps(d)) for i, d in enumerate(DOCUMENTS)] * 3 + [(0, None), (1, "{no"), (None, '{"a": 1}')]
    frame = spark.createDataFrame(rows, "path int, type string").repartition(4)
    found = json_paths.path_counts(frame.withColumn("v", F.try_parse_json("type")), "v", ["path"])
    # the key has the name of an output column, so columns are told apart by place
    got = Counter({tuple(r)[:3]: r[3] for r in found.collect()})
    expected = Counter()
    for key, text in rows:
        if text and text != "{no":
            expected.update((key, *step) for step in walk(json.loads(text)))
    assert got == expected


def test_values_below_the_depth_count_with_their_schema(spark):
    frame = spark.createDataFrame([('{"a": {"b": {"c": [1]}}}',)], "t string").select(F.parse_json("t").alias("v"))
    found = paths(json_paths.path_counts(frame, "v", depth=2), "path", "type")
    assert found == Counter({("$", "OBJECT"): 1, ("$.a", "OBJECT"): 1, ("$.a.b", "OBJECT<c: ARRAY<BIGINT>>"): 1})


def test_one_scan_no_python_and_only_counts_are_shuffled(spark, tables_dir):
    frame = spark.read.parquet(f"{tables_dir}/events.parquet").select(F.try_parse_json("props").alias("v"))
    plan = json_paths.path_counts(frame, "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2  # the initial and the current plan of the adaptive planner
    assert "Join" not in plan and "Python" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def test_merged_schemas(spark):
    rows = [("a", '{"x": 1}'), ("a", '{"y": "s"}'), ("b", '{"x": 1}'), ("b", '{"x": "s"}'), ("b", None)]
    frame = spark.createDataFrame(rows, "k string, t string").withColumn("v", F.parse_json("t"))
    found = {r["k"]: (r["schema"], r["n"]) for r in json_paths.merged_schemas(frame, "v", ["k"]).collect()}
    assert found == {"a": ("OBJECT<x: BIGINT, y: STRING>", 2), "b": ("OBJECT<x: VARIANT>", 2)}


def record(fields, **more):
    return json.dumps({"entityId": 1, "entityType": "t", "parentId": None, "fields": fields, **more})


def change(name, new, old=None):
    return {"fieldName": name, "newValue": new, "oldValue": old}


AS_FORESEEN = [
    record([change("name", "x", 5), change("anything", {"deep": [1]}, [[2]])]),
    record([change("dayPartings", [{"bidAdjustment": 1.5, "dayOfWeek": "Mon", "dayPartingId": 3, "endHour": None}], [])]),
    record([change("geoFences", [{"coordinates": {"x": 1, "y": 2.5}, "geoFenceTypeId": 1}])]),
    record([change("postalCodes", ["1", "2"])]),
    record(None),
    record([]),
]


def log_of(spark, *records, source="MV_AdGroup"):
    return spark.createDataFrame([(source, r) for r in records], "Source string, Details string")


def test_nothing_drifts_where_the_log_is_as_foreseen(spark):
    assert schema_drift.schema_drift(log_of(spark, *AS_FORESEEN)).collect() == []


@pytest.mark.parametrize(
    "details, expected",
    [
        (record([], added=1), (None, "$.added", "BIGINT")),
        (record([change("dayPartings", 7)]), ("dayPartings", "$.fields[].newValue", "BIGINT")),
        (record([change("geoFences", [{"coordinates": [1]}])]), ("geoFences", "$.fields[].newValue[].coordinates", "ARRAY")),
        (record([change("postalCodes", [3])]), ("postalCodes", "$.fields[].newValue[]", "BIGINT")),
        (record([{**change("name", "x"), "by": "me"}]), ("name", "$.fields[].by", "STRING")),
        (record([{"fieldName": 5}]), ("5", "$.fields[].fieldName", "BIGINT")),
        (record(["bare"]), (None, "$.fields[]", "STRING")),
        (record({"a": [1]}), (None, "$.fields.a[]", "BIGINT")),
        ("not json", (None, "$", "MALFORMED")),
        (None, (None, "$", "MISSING")),
        ("[1]", (None, "$", "ARRAY")),
    ],
)
def test_each_kind_of_drift_is_reported(spark, details, expected):
    found = paths(schema_drift.schema_drift(log_of(spark, *AS_FORESEEN, details)), "fieldName", "path", "type")
    assert found[expected] == 1


def test_fields_with_a_schema_of_their_own_are_the_ad_groups_alone(spark):
    odd = record([change("dayPartings", 7)])
    assert schema_drift.schema_drift(log_of(spark, odd, source="MV_Site")).collect() == []


def test_empty_log(spark):
    assert schema_drift.log_paths(log_of(spark, "x").where("false")).count() == 0
