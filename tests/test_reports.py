"""Report plans on hand-made inputs."""

import json

from conftest import rows
from driftwell.plans import ad_groups, auctions, features, keyword_reports, match_rate, quality
from driftwell.operators.sampling import stratified_downsample, train_test_split
from driftwell.schemas import AUDIT_LOG, KEYWORD_MASTER


def keyword(number, user, entity, fields, summary="Write", kind="KEYWORD"):
    details = {"entityId": entity, "entityType": kind, "fields": [{"fieldName": f, "newValue": n, "oldValue": o} for f, n, o in fields]}
    return (number, user, 1, "MV_Keyword", summary, json.dumps(details), f"t{number}", "w")


def records(spark, *log):
    return keyword_reports.keyword_records(spark.createDataFrame(list(log), AUDIT_LOG))


def master(spark):
    data = [(1, "shoes", "1", "A", "100", "c", "m"), (2, "hats", "1", "B", "200", "c", "m"), (3, "socks", "1", "C", None, "c", "m")]
    return spark.createDataFrame(data, KEYWORD_MASTER)


def test_write_report(spark):
    report = keyword_reports.write_report(
        records(
            spark,
            keyword(1, "ann", 1, [("bid", 2, 1), ("state", "on", None)]),
            keyword(2, "bob", 9, [("bid", 3, 2)]),  # not in the master
            keyword(3, "bob", 2, [("bid", 4, 3)], kind="OTHER"),
            keyword(4, "bob", 2, []),
            keyword(5, "bob", 2, [("bid", 4, 3)], summary="Create"),
        ),
        master(spark),
    )
    assert rows(report) == [
        (1, "100", "ann", "t1", "shoes", "bid", "2", "1", "A"),
        (1, "100", "ann", "t1", "shoes", "state", "on", None, "A"),
        (2, None, "bob", "t2", None, "bid", "3", "2", None),
    ]


def test_write_report_fans_out_where_records_share_an_id(spark):
    report = keyword_reports.write_report(
        records(spark, keyword(1, "ann", 1, [("bid", 2, 1)]), keyword(1, "bob", 2, [("state", 3, 2)])), master(spark)
    )
    # 2 keywords x 2 changes x 2 users
    got = rows(report, "NAME", "KEYWORD", "USER ID")
    assert got == sorted((n, k, u) for n in ("shoes", "hats") for k in ("bid", "state") for u in ("ann", "bob"))


def test_summary(spark):
    report = keyword_reports.write_report(
        records(
            spark,
            keyword(1, "ann", 1, [("bid", 2, 1), ("bid", 3, 2), ("state", 1, 0)]),
            keyword(2, "bob", 1, [("bid", 2, 1)]),
            keyword(3, "bob", 3, [("bid", 2, 1)]),  # no ad group
            keyword(4, "eve", 2, [("bid", 2, 1)]),
        ),
        master(spark),
    )
    groups = spark.createDataFrame([(100, "g1", 7), (200, "g2", 8)], "`ADGROUP ID` int, `ADGROUP NAME` string, `CAMPAIGN ID` int")
    campaigns = spark.createDataFrame([(7, 70, "c1")], "`CAMPAIGN ID` int, `ADV ID` int, `CAMPAIGN NAME` string")
    advertisers = spark.createDataFrame([(70, "acme")], "`ADV ID` int, `ADV NAME` string")
    got = keyword_reports.write_summary(report, groups, campaigns, advertisers)
    assert got.columns == list(keyword_reports.SUMMARY_COLUMNS)
    assert rows(got) == [
        ("ann", "100", "acme", "g1", "c1", "A", 4, "bid"),
        ("ann", "100", "acme", "g1", "c1", "A", 4, "state"),
        ("bob", "100", "acme", "g1", "c1", "A", 4, "bid"),
    ]


def test_create_report_needs_every_field_and_keeps_nulls_and_repeats(spark):
    def given(**values):
        return [(k, v, None) for k, v in values.items()]

    full = given(id=5, name="n", createdDateTime="c", lastModifiedDateTime="m", adGroupId=8, stateId=1)
    report = keyword_reports.create_report(
        records(
            spark,
            keyword(1, "ann", 0, full, summary="Create"),
            keyword(2, "ann", 0, full[:-1], summary="Create"),
            keyword(3, "ann", 0, full[:-1] + [("stateId", None, None)], summary="Create"),
            keyword(4, "ann", 0, full + [("stateId", 2, None), ("other", 3, None)], summary="Create"),
        )
    )
    assert report.columns == list(keyword_reports.CREATE_COLUMNS)
    assert rows(report, "AUDIT ID", "KEYWORD ID", "ADGROUP ID", "STATE ID") == [
        (1, "5", "8", "1"), (3, "5", "8", None), (4, "5", "8", "1"), (4, "5", "8", "2"),
    ]


def test_create_report_gathers_the_records_of_an_audit_id(spark):
    full = [(k, v, None) for k, v in zip(keyword_reports.CREATE_FIELDS, (5, "n", "c", "m", 8, 1))]
    report = keyword_reports.create_report(
        records(spark, keyword(1, "ann", 0, full[:3], summary="Create"), keyword(1, "bob", 0, full[3:], summary="Create"))
    )
    assert rows(report, "AUDIT ID", "USER ID", "KEYWORD ID", "STATE ID") == [(1, "ann", "5", "1"), (1, "bob", "5", "1")]


def test_unassigned_ad_groups(spark):
    groups = spark.createDataFrame(
        [(1, "a", 7, 70, "null"), (2, "b", 7, 70, "33"), (3, "c", 8, 70, "null"), (4, "d", 7, 8583, "null"), (5, "e", 7, 71, None)],
        "AdGroupId int, AdGroupName string, CampaignId int, AdvertiserId int, AudienceId string",
    )
    campaigns = spark.createDataFrame([(7, "c7", 2), (8, "c8", 3)], "CampaignId int, CampaignName string, VendorId int")
    advertisers = spark.createDataFrame([(70, "x"), (71, "y"), (8583, "z")], "AdvertiserId int, AdvertiserName string")
    assert rows(ad_groups.unassigned_ad_groups(groups, campaigns, advertisers)) == [(1, "a", 7, "c7", 70, "x")]


def _match(spark, matched, visitors, url="shop"):
    day = 1_704_844_800_000  # 2024-01-10 in ms
    visits = [(i, v, day + i) for i, v in enumerate(visitors)] + [(99, "late", day + 86_400_000)]
    links = [(i, 1) for i in range(len(visitors))] + [(99, 1), (0, None), (0, 2)]
    return match_rate.match_rate(
        spark,
        spark.createDataFrame(matched, "mvid string, pwid string, pwsid int"),
        spark.createDataFrame([(1, "http://shop/1"), (2, "http://other")], "idaction int, name string"),
        spark.createDataFrame(visits, "idvisit int, idvisitor string, visit_last_action_time bigint"),
        spark.createDataFrame(links, "idvisit int, idaction_url int"),
        spark.createDataFrame([("m1", "t", None), ("m2", "", "b"), ("m1", "t2", "b"), ("zz", "t", "b")], "mvid string, tdid string, bmid string"),
        url=url,
        run_date="2024-01-11",
    ).collect()


def test_match_rate_counts_unmatched_visits_with_repeats(spark):
    matched = [("m1", "p1", 1), ("m1", "p1", 1), ("m2", "p2", 1), ("m3", "p3", 2)]
    [row] = _match(spark, matched, ["p1", "u1", "u1", None, "p3"])
    assert tuple(row) == ("2024-01-10", "shop", 6.0, 3.0, 3.0, 50.0, 100.0, 100.0)


def test_match_rate_without_denominator(spark):
    [row] = _match(spark, [("m3", "p3", 2)], [], url="no' such \" url")
    assert tuple(row)[2:] == (1.0, 1.0, 0.0, 100.0, None, None)


def test_snapshot_and_quality(spark):
    frame = spark.createDataFrame([("a", 1, "p"), ("a", 1, "p"), (None, 2, "q")], "x string, y int, z string")
    assert rows(quality.matched_snapshot(frame)) == [(None, "q", 2), ("a", "p", 1)]
    ips = spark.createDataFrame([("1" * 50,), ("1" * 51,), (None,)], "ip string")
    assert rows(quality.over_long(ips, "ip")) == [("1" * 51,)]
    got = quality.distinct_ratio(frame, "x", "z", frame.y > 5).first()
    assert tuple(got) == (0, 0, None)


def test_auctions(spark):
    bids = spark.createDataFrame(
        [("a1", 10.0, 1.0, "x", 1, 1.0, 80.0, "palm", 3), ("a1", 20.0, 1.0, "y", 1, 1.0, 80.0, "palm", 3), ("a2", 5.0, 1.0, "x", 1, 1.0, 75.0, "xbox", 3)],
        auctions.AUCTIONS,
    )
    assert auctions.auction_total(bids).first()[0] == 2
    assert rows(auctions.bids_per_item(bids)) == [("palm", 2, 10.0, 20.0, 15.0), ("xbox", 1, 5.0, 5.0, 5.0)]
    assert rows(auctions.expensive_auctions(bids)) == [("a1", "palm", 80.0)]


def _flights(spark, lines):
    texts = spark.createDataFrame([(line,) for line in lines], "value string")
    return texts.selectExpr(f"from_csv(value, '{features.FLIGHT}') AS f").select("f.*")


LINES = [
    "1,3,AA,N1,1,12478,JFK,12892,LAX,900,914,14,1225,1238,13,385,2475",
    "2,4,UA,N2,2,12478,SFO,12892,LAX,1900.5,1959,59,2225,2238,13,380.5,2475",
    "31,7,AA,N3,3,12478,BOS,12892,JFK,100,140,40,1225,1238,13,60,187",
]


def test_feature_rows(spark):
    got = rows(features.feature_rows(_flights(spark, LINES), ["tailnum"]))
    assert got == [
        ("N1", 0.0, 0.0, 2.0, 900.0, 1225.0, 0.0, 385.0, 1.0, 1.0),
        ("N2", 1.0, 1.0, 3.0, 1900.0, 2225.0, 1.0, 380.5, 2.0, 1.0),
        ("N3", 0.0, 30.0, 6.0, 100.0, 1225.0, 0.0, 60.0, 0.0, 0.0),
    ]
    points = features.labelled_points(features.feature_rows(_flights(spark, LINES)))
    assert points.columns == ["label", "features"]
    assert sorted(list(p.features) for p in points.collect())[0] == [0.0, 2.0, 900.0, 1225.0, 0.0, 385.0, 1.0, 1.0]


def test_category_index_with_null(spark):
    frame = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    for slices in (None, 3):
        assert rows(features.category_index(frame, "c", slices=slices)) == [(None, 0), ("a", 1), ("b", 2)]


def test_samples_are_repeatable_and_sized(spark):
    frame = spark.range(20_000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN 1.0D ELSE 0.0D END AS label")
    kept = stratified_downsample(frame, "label", "id", {0.0: 15})
    assert kept.where("label = 1").count() == 5000
    zeros = kept.where("label = 0").count()
    assert 0.13 * 15000 < zeros < 0.17 * 15000
    train, test = train_test_split(frame, "id")
    assert train.intersect(test).count() == 0 and train.count() + test.count() == 20_000
    assert 0.68 * 20000 < train.count() < 0.72 * 20000
    # another layout, the same rows
    again, _ = train_test_split(frame.repartition(5), "id")
    assert again.exceptAll(train).count() == 0


def test_hash_bucket_takes_any_bigint(spark):
    frame = spark.createDataFrame([(0,), (-1,), (2**63 - 1,), (-(2**63),), (None,)], "id bigint")
    train, test = train_test_split(frame.where("id is not null"), "id")
    assert train.count() + test.count() == 4
