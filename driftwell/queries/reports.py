"""Report pipelines on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.operators.sampling import split_side, stratified_downsample
from driftwell.plans import ad_groups, auctions, features, keyword_reports, match_rate, quality
from driftwell.queries.audit_data import KIND_SQL, audit_log
from driftwell.queries.catalog import Tables, exact_mean_sql, query
from driftwell.queries.sets_and_samples import bucket_sql
from driftwell.schemas import WRITE_REPORT
from driftwell.sources.readers import read_delimited, wide_cells
from driftwell.sources.writers import stage, write_report, write_snapshot


# Lines as ad groups, parts as campaigns (vendor = size modulo 5), suppliers as advertisers.
@query("""
SELECT l_orderkey AS "AdGroupId", l_returnflag AS "AdGroupName", l_partkey AS "CampaignId", p_name AS "CampaignName",
       l_suppkey AS "AdvertiserId", s_name AS "AdvertiserName"
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_linestatus = 'O' AND p_size % 5 = 2 AND s_suppkey <> 85
ORDER BY 1
""")
def rpt_unassigned_groups(t: Tables) -> DataFrame:
    audience = F.when(F.col("l_linestatus") == "O", "null").otherwise(F.col("l_linestatus"))
    groups = t.lineitem.select(
        F.col("l_orderkey").alias("AdGroupId"),
        F.col("l_returnflag").alias("AdGroupName"),
        F.col("l_partkey").alias("CampaignId"),
        F.col("l_suppkey").alias("AdvertiserId"),
        audience.alias("AudienceId"),
    )
    campaigns = t.part.select(
        F.col("p_partkey").alias("CampaignId"), F.col("p_name").alias("CampaignName"), (F.col("p_size") % 5).alias("VendorId")
    )
    advertisers = t.supplier.select(F.col("s_suppkey").alias("AdvertiserId"), F.col("s_name").alias("AdvertiserName"))
    report = ad_groups.unassigned_ad_groups(groups, campaigns, advertisers, excluded_advertiser=85)
    return report.orderBy("AdGroupId", "CampaignId", "AdvertiserId")


def keyword_master(t: Tables) -> DataFrame:
    """Parts as keywords; the ad group is the customer with the part's number."""
    return t.part.select(
        F.col("p_partkey").alias("Id"),
        F.col("p_name").alias("Name"),
        F.col("p_size").cast("string").alias("StateId"),
        F.col("p_partkey").cast("string").alias("AdGroupId"),
    )


# A keyword record's entity is twice its order's customer key: some are not in the master.
_WRITES_SQL = f"""
  SELECT o_orderkey AS audit_id, CAST(p_partkey AS VARCHAR) AS adgroup_id, 'user' || (o_custkey % 50) AS user_id,
         strftime(o_orderdate, '%Y-%m-%d') AS log_time, p_name AS keyword_name, f.name AS field,
         CASE WHEN f.name = 'name' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS new_value,
         CASE WHEN f.name = 'name' THEN NULL ELSE o_orderstatus END AS old_value,
         CAST(p_size AS VARCHAR) AS state_id
  FROM orders CROSS JOIN (VALUES ('name'), ('status')) f(name) LEFT JOIN part ON p_partkey = o_custkey * 2
  WHERE {KIND_SQL} = 'MV_Keyword' AND o_orderstatus <> 'P'
"""


def _records(t: Tables) -> DataFrame:
    return stage(keyword_reports.keyword_records(audit_log(t)), t.scratch("keyword-records"))


def _write_report(t: Tables) -> DataFrame:
    return keyword_reports.write_report(_records(t), keyword_master(t))


@query(f"""
SELECT audit_id AS "AUDIT ID", adgroup_id AS "ADGROUP ID", user_id AS "USER ID", log_time AS "LOG DATE TIME", keyword_name AS "NAME",
       field AS "KEYWORD", new_value AS "NEW VALUE", old_value AS "OLD VALUE", state_id AS "STATE ID"
FROM ({_WRITES_SQL})
""")
def rpt_keyword_write(t: Tables) -> DataFrame:
    return _write_report(t)


def _summary(t: Tables, report: DataFrame) -> DataFrame:
    # customers as ad groups, nations as campaigns, regions as advertisers
    groups = t.customer.select(
        F.col("c_custkey").alias("ADGROUP ID"), F.col("c_name").alias("ADGROUP NAME"), F.col("c_nationkey").alias("CAMPAIGN ID")
    )
    campaigns = t.nation.select(
        F.col("n_nationkey").alias("CAMPAIGN ID"), F.col("n_regionkey").alias("ADV ID"), F.col("n_name").alias("CAMPAIGN NAME")
    )
    advertisers = t.region.select(F.col("r_regionkey").alias("ADV ID"), F.col("r_name").alias("ADV NAME"))
    summary = keyword_reports.write_summary(report, groups, campaigns, advertisers)
    return summary.orderBy("ADGROUP ID", "USER ID", "STATUS", "MODIFIED VALUE")


_SUMMARY_SQL = f"""
WITH w AS ({_WRITES_SQL})
SELECT DISTINCT w.user_id AS "USER ID", w.adgroup_id AS "ADGROUP ID", r_name AS "COMPANY", c_name AS "ADGROUP NAME",
       n_name AS "CAMPAIGN NAME", w.state_id AS "STATUS", k.n AS "TOTAL KW EDITS", w.field AS "MODIFIED VALUE"
FROM w JOIN (SELECT adgroup_id, count(*) AS n FROM w GROUP BY 1) k ON k.adgroup_id = w.adgroup_id
JOIN customer ON c_custkey = CAST(w.adgroup_id AS BIGINT) JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
ORDER BY 2, 1, 6, 8
"""


@query(_SUMMARY_SQL)
def rpt_keyword_summary(t: Tables) -> DataFrame:
    return _summary(t, _write_report(t))


@query(_SUMMARY_SQL)
def rpt_keyword_summary_from_csv(t: Tables) -> DataFrame:
    path = t.scratch("keyword-write")
    write_report(_write_report(t), path)
    return _summary(t, read_delimited(t.spark, path, WRITE_REPORT, sep=",", header=True, multi_line=True))


@query(f"""
SELECT o_orderkey AS "AUDIT ID", 'user' || (o_custkey % 50) AS "USER ID",
       strftime(o_orderdate, '%Y-%m-%d') AS "LOG DATE TIME",
       CAST(o_orderkey AS VARCHAR) AS "KEYWORD ID", nullif(o_orderpriority, '5-LOW') AS "NAME",
       strftime(o_orderdate, '%Y-%m-%d') AS "CREATED", strftime(o_orderdate, '%Y-%m-%d') AS "LAST MODIFIED",
       CAST(o_custkey AS VARCHAR) AS "ADGROUP ID", s.state AS "STATE ID"
FROM orders JOIN (VALUES ('1', false), ('2', true)) s(state, twice) ON NOT s.twice OR o_orderpriority = '1-URGENT'
WHERE {KIND_SQL} = 'MV_Keyword' AND o_orderstatus = 'P' AND o_orderpriority <> '3-MEDIUM'
""")
def rpt_keyword_create(t: Tables) -> DataFrame:
    return keyword_reports.create_report(keyword_reports.keyword_records(audit_log(t)))


_RUN_DATE = "2024-01-11"


@query(f"""
WITH matched AS (SELECT DISTINCT c_custkey AS mvid, nullif(c_custkey, 3) AS pwid, c_nationkey % 3 AS pwsid
                 FROM customer WHERE c_acctbal > 2000),
     known AS (SELECT DISTINCT pwid FROM matched),
     hits AS (SELECT nullif(e.user_id, 5) AS idvisitor
              FROM events e JOIN pages p ON p.page_id = CAST(json_extract(e.props, '$.k') AS BIGINT)
              WHERE e.event_type <> 'error' AND instr(p.url, 'example.com') > 0
                AND CAST(e.ts AS DATE) = DATE '{_RUN_DATE}' - INTERVAL 1 DAY),
     own AS (SELECT DISTINCT mvid FROM matched WHERE pwsid = 1),
     prof AS (SELECT c_custkey AS mvid, nullif(c_mktsegment, 'BUILDING') AS tdid,
                     CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END AS bmid FROM customer),
     n AS (SELECT (SELECT count(*) FROM known) AS m,
                  (SELECT count(*) FROM hits h WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.pwid IS NOT DISTINCT FROM h.idvisitor)) AS u,
                  (SELECT count(*) FROM own) AS o,
                  (SELECT count(*) FROM prof JOIN own USING (mvid) WHERE bmid IS NOT NULL AND bmid <> '') AS b,
                  (SELECT count(*) FROM prof JOIN own USING (mvid) WHERE tdid IS NOT NULL AND tdid <> '') AS d)
SELECT '2024-01-10' AS "Date", 'example.com' AS url, CAST(m + u AS DOUBLE) AS total_piwik_users, CAST(m AS DOUBLE) AS matched_piwik_users,
       CAST(u AS DOUBLE) AS unmatched_piwik_users,
       CAST(m AS DOUBLE) / nullif(CAST(m + u AS DOUBLE), 0) * 100.0::DOUBLE AS piwik_match_rate,
       CAST(b AS DOUBLE) / nullif(CAST(o AS DOUBLE), 0) * 100.0::DOUBLE AS bombora_match_rate,
       CAST(d AS DOUBLE) / nullif(CAST(o AS DOUBLE), 0) * 100.0::DOUBLE AS td_match_rate
FROM n
""")
def rpt_match_rate(t: Tables) -> DataFrame:
    # events as visits (the page is the number in their properties), pages as actions, customers as profiles
    rich = t.customer.where("c_acctbal > 2000")
    matched = rich.select(
        F.col("c_custkey").alias("mvid"),
        F.nullif(F.col("c_custkey"), F.lit(3)).alias("pwid"),
        (F.col("c_nationkey") % 3).alias("pwsid"),
    )
    visits = t.events.select(
        F.col("event_id").alias("idvisit"),
        F.nullif(F.col("user_id"), F.lit(5)).alias("idvisitor"),
        F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("visit_last_action_time"),
    )
    page = F.from_json("props", "k bigint")["k"]
    links = t.events.select(
        F.col("event_id").alias("idvisit"), F.when(F.col("event_type") != "error", page).alias("idaction_url")
    )
    actions = t.pages.select(F.col("page_id").alias("idaction"), F.col("url").alias("name"))
    segment = F.col("c_mktsegment")
    wide = t.customer.select(
        F.col("c_custkey").alias("inf/mv/userid"),
        F.nullif(segment, F.lit("BUILDING")).alias("inf/200/userid"),
        F.when(segment == "MACHINERY", "").otherwise(segment).alias("inf/300/userid"),
    )
    profiles = wide_cells(wide, {"inf/mv/userid": "mvid", "inf/200/userid": "tdid", "inf/300/userid": "bmid"})
    profiles = profiles.withColumn("mvid", F.col("mvid").cast("bigint"))
    return match_rate.match_rate(
        t.spark, matched, actions, visits, links, profiles, url="example.com", run_date=_RUN_DATE
    )


@query("SELECT DISTINCT l_suppkey AS mvid, l_partkey AS pwid, l_linenumber AS pwsid FROM lineitem")
def rpt_snapshot_dedup(t: Tables) -> DataFrame:
    path = t.scratch("matched-daily")
    write_snapshot(quality.matched_snapshot(t.lineitem.select("l_suppkey", "l_linenumber", "l_partkey")), path)
    return t.spark.read.parquet(path)


def _bids(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("Auction Id"), F.col("l_extendedprice").alias("bid"), F.col("l_partkey").alias("item")
    )


@query(f"""
SELECT l_partkey AS item, count(*) AS bids, min(l_extendedprice) AS min_bid, max(l_extendedprice) AS max_bid,
       {exact_mean_sql("l_extendedprice")} AS avg_bid
FROM lineitem GROUP BY 1
""")
def rpt_auction_summary(t: Tables) -> DataFrame:
    # as decimals, since the last digits of a mean of doubles depend on the order of addition
    bids = _bids(t).withColumn("bid", F.col("bid").cast("decimal(18,2)"))
    return auctions.bids_per_item(bids).withColumns({c: F.col(c).cast("double") for c in ("min_bid", "max_bid", "avg_bid")})


@query("SELECT count(DISTINCT l_orderkey) AS auctions FROM lineitem")
def rpt_auction_total(t: Tables) -> DataFrame:
    return auctions.auction_total(_bids(t))


_INDEX_SQL = "SELECT {c}, dense_rank() OVER (ORDER BY {c}) - 1 AS index FROM (SELECT DISTINCT {c} FROM {t})"


@query(_INDEX_SQL.format(c="p_name", t="part"))
def ml_category_index(t: Tables) -> DataFrame:
    return features.category_index(t.part, "p_name")


@query(_INDEX_SQL.format(c="text", t="documents"))
def ml_category_index_sliced(t: Tables) -> DataFrame:
    return features.category_index(t.documents, "text", slices=16)


def _flights(t: Tables) -> DataFrame:
    """Orders as flights: priority as carrier, the customer's segment and nation as airports."""
    places = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return t.orders.join(places, "o_custkey").select(
        "o_orderkey",
        F.dayofmonth("o_orderdate").cast("string").alias("dofM"),
        F.dayofweek("o_orderdate").cast("string").alias("dofW"),
        F.col("o_orderpriority").alias("carrier"),
        F.col("c_mktsegment").alias("origin"),
        F.col("c_nationkey").cast("string").alias("dest"),
        (F.col("o_custkey") % 2400).cast("double").alias("crsdeptime"),
        (F.col("o_orderkey") % 2400).cast("double").alias("crsarrtime"),
        F.col("o_totalprice").alias("crselapsedtime"),
        (F.col("o_custkey") % 60).cast("double").alias("depdelaymins"),
    )


_FEATURES_SQL = """
SELECT o_orderkey, CASE WHEN o_custkey % 60 > 40 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       CAST(day(o_orderdate) - 1 AS DOUBLE) AS monthday, CAST(dayofweek(o_orderdate) AS DOUBLE) AS weekday,
       CAST(o_custkey % 2400 AS DOUBLE) AS crsdeptime, CAST(o_orderkey % 2400 AS DOUBLE) AS crsarrtime,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS carrier, o_totalprice AS crselapsedtime,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS origin,
       CAST(dense_rank() OVER (ORDER BY CAST(c_nationkey AS VARCHAR)) - 1 AS DOUBLE) AS dest
FROM orders JOIN customer ON o_custkey = c_custkey
"""


@query(_FEATURES_SQL)
def ml_feature_rows(t: Tables) -> DataFrame:
    return features.feature_rows(_flights(t), ["o_orderkey"])


@query(f"""
SELECT *, CASE WHEN {bucket_sql('o_orderkey', 1000003)} < 70 THEN 'train' ELSE 'test' END AS side
FROM ({_FEATURES_SQL}) WHERE label <> 0 OR {bucket_sql('o_orderkey')} < 15
""")
def ml_training_sets(t: Tables) -> DataFrame:
    rows = features.feature_rows(_flights(t), ["o_orderkey"])
    balanced = stratified_downsample(rows, "label", "o_orderkey", {0.0: 15})
    return balanced.withColumn("side", split_side("o_orderkey"))
