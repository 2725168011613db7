"""The jobs from files to files."""

import json
import os
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from driftwell import jobs, session
from driftwell.session import scratch_path
from driftwell.schemas import AUDIT_LOG
from driftwell.sources.writers import write_report

RUN, DAY = "2024-01-02", "2024-01-01"


def put(path, *lines):
    os.makedirs(path)
    with open(f"{path}/data.txt", "w") as out:
        out.write("\n".join(lines) + "\n")


def wide(length, **cells):
    return "|".join(str(cells.get(f"c{i}", f"x{i}")) for i in range(length))


def masters(root):
    put(f"{root}/masters/keyword", "1|shoes|0.5|2|100|c|m", "2|hats|null|3|null|c|m")
    put(
        f"{root}/masters/ad_group",
        wide(50, c0=100, c1="g100", c2=7, c28=70, c47="null"),
        wide(50, c0=200, c1="g200", c2=7, c28=70, c47="5"),
    )
    put(f"{root}/masters/campaign", wide(12, c0=7, c1=70, c2="spring", c10=2))
    put(f"{root}/masters/advertiser", "70|acme", "8583|hidden")


def audit(spark, root):
    def record(i, source, summary, fields, kind="KEYWORD"):
        details = {"entityId": 1, "entityType": kind, "parentId": 4, "fields": [dict(zip(("fieldName", "newValue", "oldValue"), f)) for f in fields]}
        return (i, "ann", 1, source, summary, json.dumps(details), f"{DAY} 08:00", "w")

    create = [(n, i, None) for i, n in enumerate(("id", "name", "createdDateTime", "lastModifiedDateTime", "adGroupId", "stateId"))]
    log = [
        record(1, "MV_Keyword", "Write", [("bid", "a|\"b\"\nc", None), ("state", 1, 2)]),
        record(2, "MV_Keyword", "Create", create),
        record(3, "MV_AdGroup", "Write", [("postalCodes", ["1"], None)], kind="ADGROUP"),
    ]
    write_report(spark.createDataFrame(log, AUDIT_LOG), f"{root}/auditlog/source/dt={DAY}", sep="|", header=False, quote_all=True)


def text(spark, path):
    return [r[0] for r in rows(spark.read.text(path))]


def test_audit_and_keyword_jobs(spark):
    root = scratch_path(spark, "jobs")
    masters(root)
    audit(spark, root)
    assert set(jobs.shred_audit_log(spark, root, RUN)) == {
        "logmaster", "logadgroup", "adgroup/postal_codes/new", "adgroup/postal_codes/old", "rejects",
    }
    assert spark.read.parquet(f"{root}/auditlog/logmaster/dt={DAY}").count() == 3
    for _ in range(2):  # a rerun replaces the day
        assert jobs.report_keywords(spark, root, RUN) == ["keyword_write", "keyword_summary", "keyword_create"]
    assert text(spark, f"{root}/reports/keyword_summary/dt={DAY}") == [
        "ann|100|acme|g100|spring|2|2|bid", "ann|100|acme|g100|spring|2|2|state",
    ]
    created = spark.read.option("header", True).csv(f"{root}/reports/keyword_create/dt={DAY}")
    assert rows(created, "AUDIT ID", "KEYWORD ID", "STATE ID") == [("2", "0", "5")]


def test_jobs_without_input(spark):
    root = scratch_path(spark, "jobs")
    for job in (jobs.shred_audit_log, jobs.report_keywords):
        with pytest.raises(AnalysisException):
            job(spark, root, RUN)
        assert job(spark, root, RUN, allow_missing=True) == []
    assert jobs.summarize_keywords(spark, root, RUN) is False


def test_absent_input_leaves_a_good_day(spark):
    root = scratch_path(spark, "jobs")
    masters(root)
    audit(spark, root)
    jobs.shred_audit_log(spark, root, RUN)
    jobs.report_keywords(spark, root, RUN)
    os.rename(f"{root}/auditlog/source", f"{root}/auditlog/gone")
    for job in (jobs.shred_audit_log, jobs.report_keywords):
        with pytest.raises(AnalysisException):
            job(spark, root, RUN)
        job(spark, root, RUN, allow_missing=True)
    assert spark.read.parquet(f"{root}/auditlog/logmaster/dt={DAY}").count() == 3
    assert len(text(spark, f"{root}/reports/keyword_summary/dt={DAY}")) == 2


def test_rerun_with_other_input_replaces_the_reports(spark):
    root = scratch_path(spark, "jobs")
    masters(root)
    audit(spark, root)
    jobs.report_keywords(spark, root, RUN)
    less = spark.createDataFrame([(3, "ann", 1, "MV_AdGroup", "Write", "{}", f"{DAY} 08:00", "w")], AUDIT_LOG)
    write_report(less, f"{root}/auditlog/source/dt={DAY}", sep="|", header=False, quote_all=True, mode="overwrite")
    assert jobs.report_keywords(spark, root, RUN) == []
    assert not any(os.path.exists(f"{root}/reports/keyword_{name}/dt={DAY}") for name in ("write", "summary", "create"))


def test_scratch_is_deleted_at_the_end_of_a_job(spark, monkeypatch):
    root = scratch_path(spark, "jobs")
    masters(root)
    audit(spark, root)
    used = []
    monkeypatch.setattr(session, "scratch_path", lambda s, label: used.append(scratch_path(s, label)) or used[-1])
    jobs.shred_audit_log(spark, root, RUN)
    jobs.report_keywords(spark, root, RUN)
    assert used and not any(os.path.exists(path) for path in used)


def test_unassigned_ad_groups(spark):
    root = scratch_path(spark, "jobs")
    masters(root)
    jobs.report_unassigned_ad_groups(spark, root, RUN)
    assert text(spark, f"{root}/reports/unassigned_ad_groups/dt={DAY}") == ["100|g100|7|spring|70|acme"]


def test_match_jobs(spark, monkeypatch):
    root = scratch_path(spark, "jobs")
    suffix = uuid.uuid4().hex[:8]
    for name in ("ACTIONS", "VISITS", "LINKS", "STATISTICS"):
        monkeypatch.setattr(jobs, name, f"{getattr(jobs, name)}_{suffix}")
    spark.createDataFrame([("m1", 1, "p1"), ("m1", 1, "p1")], "a string, b int, c string").write.parquet(f"{root}/matching_all")
    spark.createDataFrame([("m1", "t", "")], "mvid string, tdid string, bmid string").write.parquet(f"{root}/user_profile")
    spark.createDataFrame([(1, "http://shop")], "idaction int, name string").createOrReplaceTempView(jobs.ACTIONS)
    spark.createDataFrame([(5, "u", 1_704_067_200_000)], "idvisit int, idvisitor string, visit_last_action_time bigint").createOrReplaceTempView(jobs.VISITS)
    spark.createDataFrame([(5, 1)], "idvisit int, idaction_url int").createOrReplaceTempView(jobs.LINKS)
    jobs.snapshot_matches(spark, root, RUN)
    for _ in range(2):
        jobs.record_match_rate(spark, root, RUN, url="shop")
    assert rows(spark.table(jobs.STATISTICS)) == [(2.0, 1.0, 1.0, 50.0, 0.0, 100.0, DAY, "shop")]
    spark.sql(f"DROP TABLE {jobs.STATISTICS}")


def test_export(spark):
    root = scratch_path(spark, "jobs")
    spark.createDataFrame([("m", "p", None, "b", "d", 1)], "mvid string, pwid string, tdid string, bmid string, dt string, x int").createOrReplaceTempView("users_to_export")
    jobs.export_users(spark, root, RUN, table="users_to_export")
    assert text(spark, f"{root}/exports/users/dt={DAY}") == ["mvid|pwid|tdid|bmid|dt", "m|p||b|d"] or text(
        spark, f"{root}/exports/users/dt={DAY}"
    ) == ["m|p||b|d", "mvid|pwid|tdid|bmid|dt"]


def test_auctions_and_events(spark):
    root = scratch_path(spark, "jobs")
    put(f"{root}/auctions", "a,1.5,0.1,x,1,1,80,palm,3", "a,2.5,0.2,y,1,1,80,palm,3", "b,9,0.2,y,1,1,70,xbox,3")
    jobs.report_auctions(spark, root, RUN)
    base = f"{root}/reports/auctions/dt={DAY}"
    assert text(spark, f"{base}/total") == ["2", "auctions"]
    assert text(spark, f"{base}/items") == ["item,bids,min_bid,max_bid,avg_bid", "palm,2,1.5,2.5,2.0", "xbox,1,9.0,9.0,9.0"]
    assert "a,palm,80.0" in text(spark, f"{base}/expensive")
    spark.createDataFrame([("1" * 60, 1), ("2", 1), ("2", 1)], "ip string, id int").write.parquet(f"{root}/events/dt={DAY}")
    jobs.check_events(spark, root, RUN)
    assert text(spark, f"{root}/quality/over_long/dt={DAY}") == [json.dumps({"ip": "1" * 60, "id": 1}, separators=(",", ":"))]
    assert "3,2" in text(spark, f"{root}/quality/duplicates/dt={DAY}")


def test_flights(spark):
    root = scratch_path(spark, "jobs")
    put(f"{root}/flights", *[f"{1 + i % 28},{1 + i % 7},A{i % 3},N{i},1,1,JFK,2,LAX,900,914,{i % 60},1225,1238,13,{i},2475" for i in range(600)])
    jobs.prepare_flights(spark, root, RUN)
    base = f"{root}/flight_features/dt={DAY}"
    train, test = spark.read.parquet(f"{base}/train"), spark.read.parquet(f"{base}/test")
    delayed = sum(f.where("label = 1").count() for f in (train, test))
    assert delayed == sum(1 for i in range(600) if i % 60 > 40)
    assert 0.6 < train.count() / (train.count() + test.count()) < 0.8
    assert len(train.first()["features"]) == 8
    assert spark.read.parquet(f"{base}/rejects").count() == 0


def test_flights_that_lack_a_feature_are_set_aside(spark):
    root = scratch_path(spark, "jobs")
    put(f"{root}/flights", *[f"{1 + i % 28},{1 + i % 7},A{i % 3},N{i},1,1,JFK,2,LAX,{900 if i % 5 else ''},914,50,1225,1238,13,{i},2475" for i in range(100)])
    jobs.prepare_flights(spark, root, RUN)
    base = f"{root}/flight_features/dt={DAY}"
    counts = [spark.read.parquet(f"{base}/{name}").count() for name in ("train", "test", "rejects")]
    assert counts[2] == 20 and sum(counts) == 100


def test_word_stream(spark):
    root = scratch_path(spark, "jobs")
    put(f"{root}/lines", "a b a")
    jobs.count_words(spark, root, RUN, available_now=True)
    assert rows(spark.read.json(f"{root}/word_counts"), "word", "n") == [("a", 2), ("b", 1)]


def test_persisted_is_released(spark):
    frame = spark.range(10).select(F.col("id") + 1)
    with jobs.persisted(frame) as kept:
        assert kept.count() == 10 and kept.storageLevel.useMemory
    assert not frame.storageLevel.useMemory
