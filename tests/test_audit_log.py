"""The shredder on hand-made records."""

import json
import os

import pytest

from conftest import rows
from driftwell.plans import audit_log as plan
from driftwell.schemas import AUDIT_LOG
from driftwell.session import scratch_path
from driftwell.sources.readers import read_delimited
from driftwell.sources.writers import write_report


def record(number, source, details, summary="Write"):
    text = details if details is None or isinstance(details, str) else json.dumps(details)
    return (number, f"u{number}", 1, source, summary, text, "2024-01-01 10:00:00", "w")


def change(name, new, old):
    return {"fieldName": name, "newValue": new, "oldValue": old}


def part(bid, day=2):
    return {"bidAdjustment": bid, "dayOfWeek": day, "dayPartingId": 7, "endHour": 18, "startHour": 9}


GROUP = {"entityId": 10, "entityType": "ADGROUP", "parentId": 5}
LOG = [
    record(1, "MV_AdGroup", {**GROUP, "fields": [change("dayPartings", [part(1.5), part(2)], [part(0.5)])]}),
    record(2, "MV_AdGroup", {**GROUP, "fields": [change("dayPartings", [part(3)], None)]}),
    record(3, "MV_AdGroup", {**GROUP, "fields": [change("dayPartings", [part(4, "MONDAY")], 17)]}),
    record(4, "MV_AdGroup", {**GROUP, "fields": [change("dayPartings", None, [part("6.5")])]}),
    record(5, "MV_AdGroup", {**GROUP, "fields": [change("dayPartings", [], [])]}),
    record(6, "MV_AdGroup", {**GROUP, "fields": [change("audienceId", 44, "none"), change("name", 'a|"b"\nc', None)]}),
    record(7, "MV_AdGroup", {**GROUP, "fields": [{"fieldName": "postalCodes", "newValue": ["60601", 75001]}]}),
    record(8, "MV_AdGroup", {**GROUP, "fields": [change("postalCodes", ["1"], ["2", "3"]), change("postalCodes", ["4"], "5")]}),
    record(9, "MV_AdGroup", {**GROUP, "fields": [change("geoFences", [{"coordinates": {"x": 1.25, "y": -2}, "geoFenceTypeId": 3}], [])]}),
    record(10, "MV_AdGroup", GROUP),
    record(11, "MV_AdGroup", "{broken"),
    record(12, "MV_AdGroup", None),
    record(13, "MV_Site", {"entityId": "77", "entityType": "SITE", "fields": [change("urls", "http://a", ["x"])]}),
    record(14, "Audience", {"entityId": 3, "entityType": "AUDIENCE", "parentId": 1, "fields": []}),
    record(15, "MV_AdGroup", {**GROUP, "fields": [change("dayPartings", "[{\"bidAdjustment\": 9}]", "[not json")]}),
]


@pytest.fixture(scope="module")
def parsed(spark):
    return plan.parse_log(spark.createDataFrame(LOG, AUDIT_LOG))


def spec(name):
    return next(s for s in plan.ELEMENT_FIELDS if s.name == name)


def groups(parsed):
    return plan.field_rows(parsed, "MV_AdGroup")


def test_new_elements(parsed):
    got = rows(plan.new_elements(groups(parsed), spec("dayPartings")), "eid", "NewBidAdjustment", "NewDayOfWeek", "NewEndHour")
    # an array given as text counts as the array; a null or empty new value has no element
    assert got == [(1, 1.5, "2", 18), (1, 2.0, "2", 18), (2, 3.0, "2", 18), (3, 4.0, "MONDAY", 18), (15, 9.0, None, None)]


def test_old_elements_or_raw_value(parsed):
    got = rows(plan.old_elements(groups(parsed), spec("dayPartings")), "eid", "OldBidAdjustment", "OldStartHour", "OldValue")
    assert got == [
        (1, 0.5, 9, None),
        (2, None, None, None),  # null stays as a row
        (3, None, None, "17"),
        (4, 6.5, 9, None),  # a number written as text
        (15, None, None, "[not json"),
    ]


def test_postal_codes(parsed):
    assert rows(plan.new_elements(groups(parsed), spec("postalCodes"))) == [(7, "60601"), (7, "75001"), (8, "1"), (8, "4")]
    # a missing old value is a null one
    assert rows(plan.old_elements(groups(parsed), spec("postalCodes"))) == [(7, None), (8, "2"), (8, "3"), (8, "5")]


def test_nested_coordinates(parsed):
    assert rows(plan.new_elements(groups(parsed), spec("geoFences"))) == [(9, 1.25, -2.0, 3)]
    assert rows(plan.old_elements(groups(parsed), spec("geoFences"))) == []


def test_scalar_changes(parsed):
    assert rows(plan.audience_changes(groups(parsed))) == [(6, "none", "44")]
    assert rows(plan.site_urls(plan.field_rows(parsed, "MV_Site"))) == [(13, "http://a", '["x"]')]


def test_entity_rows(parsed):
    got = {r["Id"]: r for r in plan.entity_rows(parsed, plan.AD_GROUP).collect()}
    assert sorted(got) == list(range(1, 13)) + [15]
    assert (got[6]["fieldName"], got[6]["newValue"]) == (["audienceId", "name"], ["44", 'a|"b"\nc'])
    assert got[10]["entityId"] == 10 and got[10]["fieldName"] is None
    assert got[11]["entityId"] is None and got[12]["entityId"] is None
    site = plan.entity_rows(parsed, plan.SITE)
    assert site.columns == ["Id", "entityId", "entityType", "fieldName", "newValue", "oldValue"]
    assert site.first()["entityId"] == 77
    domain = plan.entity_rows(parsed, next(e for e in plan.ENTITIES if e.output == "global_domain"))
    assert domain.columns == ["Id", "entityId", "parentId", "fieldName", "newValue", "oldValue"]


def test_records_without_fields_have_no_field_rows(parsed):
    assert {r["eid"] for r in groups(parsed).collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 15}


def test_rejects(parsed):
    assert rows(plan.rejects(parsed)) == [(11, "MV_AdGroup", "{broken")]


def test_whole_day(spark):
    log = spark.createDataFrame(LOG, AUDIT_LOG)
    target = scratch_path(spark, "shred-test")
    names = plan.shred_day(log, target, "2024-01-01", f"{target}-a")
    # the kinds and fields present, each with its tables
    assert set(names) == {
        "logmaster", "logadgroup", "site", "siteurls", "audience", "adgroup/audienceid",
        "adgroup/dayparting/new", "adgroup/dayparting/old", "adgroup/postal_codes/new", "adgroup/postal_codes/old",
        "adgroup/geofences/new", "adgroup/geofences/old", "rejects",
    }
    assert spark.read.parquet(f"{target}/logmaster").count() == len(LOG)
    assert spark.read.parquet(f"{target}/adgroup/dayparting/old").count() == 5
    # a rerun replaces the day
    plan.shred_day(log, target, "2024-01-01", f"{target}-b")
    assert spark.read.parquet(f"{target}/logmaster").count() == len(LOG)
    assert set(spark.read.parquet(f"{target}/logmaster").columns) == {
        "Id", "UserName", "AuditTypeId", "Source", "Summary", "LogDateTime", "WhoId", "dt",
    }


def test_gate_of_two_rows_leaves_out_single_records(spark):
    target = scratch_path(spark, "shred-gate")
    names = plan.shred_day(spark.createDataFrame(LOG, AUDIT_LOG), target, "2024-01-01", f"{target}-s", min_rows=2)
    assert "site" not in names and "audience" not in names and "adgroup/geofences/new" not in names
    assert "adgroup/postal_codes/new" in names


def test_output_names():
    assert len(plan.OUTPUTS) == 32


def test_log_survives_a_delimited_file(spark):
    log = spark.createDataFrame(LOG, AUDIT_LOG)
    path = scratch_path(spark, "log")
    write_report(log, path, sep="|", header=False, quote_all=True)
    back = read_delimited(spark, path, AUDIT_LOG, multi_line=True)
    assert back.exceptAll(log).count() == 0 and back.count() == len(LOG)


def test_shred_undoes_wrapping(spark):
    """Fields wrapped into details and shredded again are the same fields."""
    fields = [(i, f"f{i % 3}", str(i * 7), None if i % 2 else f"v {i}") for i in range(40)]
    wrapped = [record(i, "MV_Campaign", {"entityId": i, "fields": [change(f, n, o)]}) for i, f, n, o in fields]
    got = rows(plan.field_rows(plan.parse_log(spark.createDataFrame(wrapped, AUDIT_LOG)), "MV_Campaign"))
    assert got == fields


def test_new_values_that_are_no_array_are_rejects(spark):
    values = [{"x": 1}, 5, "text", [{"dayOfWeek": 1}], None, "[broken"]
    log = [record(i, "MV_AdGroup", {"entityId": i, "fields": [change("dayPartings", v, None)]}) for i, v in enumerate(values)]
    parsed = plan.parse_log(spark.createDataFrame([*log, (9, "u", 1, "MV_Site", "Write", "{broken", "d", "w")], AUDIT_LOG))
    found = rows(plan.all_rejects(parsed), "Id", "Source", "fieldName")
    assert [r[0] for r in found] == [0, 1, 2, 5, 9] and found[-1] == (9, "MV_Site", None)
    assert rows(plan.rejected_values(plan.field_rows(parsed), plan.ELEMENT_FIELDS[0]), "eid") == [(0,), (1,), (2,), (5,)]


def test_rerun_with_less_leaves_nothing_behind_and_empty_sources_survive(spark):
    target = scratch_path(spark, "shred-less")
    odd = [(50, "u", 1, "", "Write", None, "d", "w"), (51, "u", 1, None, "Write", None, "d", "w")]
    plan.shred_day(spark.createDataFrame(LOG, AUDIT_LOG), target, "2024-01-01", f"{target}-a")
    without = [r for r in LOG if r[3] != "MV_Site"] + odd
    names = plan.shred_day(spark.createDataFrame(without, AUDIT_LOG), target, "2024-01-01", f"{target}-b")
    assert "site" not in names and not os.path.exists(f"{target}/site/dt=2024-01-01")
    master = spark.read.parquet(f"{target}/logmaster")
    assert {r["Source"] for r in master.where("Id >= 50").collect()} == {"", None}
    # one file for each kind, not one for each kind and task
    assert all(len([f for f in os.listdir(d) if f.endswith(".parquet")]) <= 2 for d, _, _ in os.walk(f"{target}-b/records") if "kind=" in d)
