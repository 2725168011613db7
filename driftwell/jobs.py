"""The daily jobs, from files and tables to files and tables.

    spark-submit driftwell/jobs.py <job> --root <path> --run-date <yyyy-MM-dd> [job options]

A job works on the day before its run date.  Everything lies below ``--root``, on any file system
Spark can reach; master files are headerless and ``|``-separated.  A rerun replaces its day.  A day
without a source is an error, or with ``--allow-missing`` leaves everything as it is.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from driftwell.functions.time import previous_day
from driftwell.operators.reshape import duplicate_profile
from driftwell.operators.sampling import stratified_downsample, train_test_split
from driftwell.plans import ad_groups, audit_log, auctions, features, keyword_reports, match_rate, quality
from driftwell.schemas import AUDIT_LOG, KEYWORD_MASTER, WRITE_REPORT
from driftwell.session import build_session, delete_path, scratch
from driftwell.sources.readers import read_delimited, read_ordinal, read_or_empty
from driftwell.sources.writers import replace_partitions, stage, write_lines, write_report, write_snapshot
from driftwell.streaming.word_count import file_lines, start_word_count

# Positions of the used columns in the master files.
KEYWORD_AD_GROUP = {0: "ADGROUP ID", 1: "ADGROUP NAME", 2: "CAMPAIGN ID"}
KEYWORD_CAMPAIGN = {0: "CAMPAIGN ID", 1: "ADV ID", 2: "CAMPAIGN NAME"}
KEYWORD_ADVERTISER = {0: "ADV ID", 1: "ADV NAME"}
AUDIENCE_AD_GROUP = {0: "AdGroupId", 1: "AdGroupName", 2: "CampaignId", 28: "AdvertiserId", 47: "AudienceId"}
AUDIENCE_CAMPAIGN = {0: "CampaignId", 2: "CampaignName", 10: "VendorId"}
AUDIENCE_ADVERTISER = {0: "AdvertiserId", 1: "AdvertiserName"}
# Catalog tables of the match rate, and the columns exported from the user table.
ACTIONS, VISITS, LINKS, STATISTICS = "piwik_log_action", "piwik_visits", "piwik_log_link_visit_action", "cookie_matching_stats"
USER_TABLE, USER_COLUMNS = "user_id2", ("mvid", "pwid", "tdid", "bmid", "dt")
# Share of on-time flights kept, in percent.
ON_TIME_KEPT = 15


@contextmanager
def persisted(frame: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame for the length of a block in which it is used more than once."""
    frame.persist(level)
    try:
        yield frame
    finally:
        frame.unpersist()


def _log(spark: SparkSession, root: str, day: str, allow_missing: bool) -> DataFrame | None:
    """The log of a day.  JSON escapes its newlines, so a record is a line and large files can be split.

    Without a source the result is None if that is allowed: an absent input must never replace a
    day that is there.
    """
    path = f"{root}/auditlog/source/dt={day}"
    try:
        return read_delimited(spark, path, AUDIT_LOG)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND" or not allow_missing:
            raise
        return None


def shred_audit_log(
    spark: SparkSession, root: str, run_date: str, *, min_rows: int = 1, allow_missing: bool = False
) -> list[str]:
    """Shred the day's log; returns the names of the tables written."""
    day = previous_day(run_date)
    log = _log(spark, root, day, allow_missing)
    if log is None:
        return []
    with scratch(spark, "audit-log") as staging:
        return audit_log.shred_day(log, f"{root}/auditlog", day, staging, min_rows=min_rows)


def report_keywords(
    spark: SparkSession, root: str, run_date: str, *, min_rows: int = 1, allow_missing: bool = False
) -> list[str]:
    """Write, summary and create report of the day's keyword changes; returns those written.

    Reports without enough rows are deleted, should an earlier run have left them.
    """
    log = _log(spark, root, previous_day(run_date), allow_missing)
    if log is None:
        return []
    with scratch(spark, "keyword-records") as staging:
        records = stage(keyword_reports.keyword_records(log), staging)
        return _keyword_reports(spark, root, run_date, records, min_rows)


def _keyword_reports(spark: SparkSession, root: str, run_date: str, records: DataFrame, min_rows: int) -> list[str]:
    day = previous_day(run_date)
    # at most one row per report
    kinds = records.where(F.col("Summary").isin(keyword_reports.WRITE, keyword_reports.CREATE))
    sizes = {r["Summary"]: r["count"] for r in kinds.groupBy("Summary").count().collect()}
    written = []
    if sizes.get(keyword_reports.WRITE, 0) >= min_rows:
        keywords = read_delimited(spark, f"{root}/masters/keyword", KEYWORD_MASTER, null_token="null")
        path = f"{root}/reports/keyword_write/dt={day}"
        write_report(keyword_reports.write_report(records, keywords), path, mode="overwrite")
        # the summary starts from the report as written
        summarize_keywords(spark, root, run_date)
        written += ["keyword_write", "keyword_summary"]
    if sizes.get(keyword_reports.CREATE, 0) >= min_rows:
        path = f"{root}/reports/keyword_create/dt={day}"
        write_report(keyword_reports.create_report(records), path, mode="overwrite")
        written.append("keyword_create")
    for name in {"keyword_write", "keyword_summary", "keyword_create"} - set(written):
        delete_path(spark, f"{root}/reports/{name}/dt={day}")
    return written


def summarize_keywords(spark: SparkSession, root: str, run_date: str) -> bool:
    """Summary of the day's write report; False where there is no such report."""
    day = previous_day(run_date)
    path = f"{root}/reports/keyword_write/dt={day}"
    # A value may hold a newline.  The report's files are of the size the writer gives them, so
    # one task per file, which multi-line reading means, is no burden.
    report = read_or_empty(
        spark, lambda: read_delimited(spark, path, WRITE_REPORT, sep=",", header=True, multi_line=True), WRITE_REPORT
    )
    if report.isEmpty():
        return False
    summary = keyword_reports.write_summary(
        report,
        read_ordinal(spark, f"{root}/masters/ad_group", KEYWORD_AD_GROUP),
        read_ordinal(spark, f"{root}/masters/campaign", KEYWORD_CAMPAIGN),
        read_ordinal(spark, f"{root}/masters/advertiser", KEYWORD_ADVERTISER),
    )
    write_report(
        summary,
        f"{root}/reports/keyword_summary/dt={day}",
        sep="|",
        header=False,
        sort_by=["ADGROUP ID", "USER ID", "STATUS", "MODIFIED VALUE"],
        mode="overwrite",
    )
    return True


def report_unassigned_ad_groups(spark: SparkSession, root: str, run_date: str) -> None:
    report = ad_groups.unassigned_ad_groups(
        read_ordinal(spark, f"{root}/masters/ad_group", AUDIENCE_AD_GROUP),
        read_ordinal(spark, f"{root}/masters/campaign", AUDIENCE_CAMPAIGN),
        read_ordinal(spark, f"{root}/masters/advertiser", AUDIENCE_ADVERTISER),
    )
    write_report(
        report,
        f"{root}/reports/unassigned_ad_groups/dt={previous_day(run_date)}",
        sep="|",
        header=False,
        sort_by=["AdGroupId", "CampaignId", "AdvertiserId"],
        mode="overwrite",
    )


def snapshot_matches(spark: SparkSession, root: str, run_date: str) -> None:
    """The day's distinct copy of the match table."""
    matches = spark.read.parquet(f"{root}/matching_all")
    write_snapshot(quality.matched_snapshot(matches), f"{root}/matched_daily/{previous_day(run_date)}")


def record_match_rate(spark: SparkSession, root: str, run_date: str, *, url: str) -> None:
    """The day's match rates of a url in the statistics table, which has a partition for each."""
    rates = match_rate.match_rate(
        spark,
        spark.read.parquet(f"{root}/matched_daily/{previous_day(run_date)}"),
        spark.table(ACTIONS),
        spark.table(VISITS),
        spark.table(LINKS),
        spark.read.parquet(f"{root}/user_profile"),
        url=url,
        run_date=run_date,
    )
    replace_partitions(rates, STATISTICS, "Date", "url")


def export_users(spark: SparkSession, root: str, run_date: str, *, table: str = USER_TABLE) -> None:
    """A catalog table's user columns as a compressed ``|`` file with header, for transfer elsewhere."""
    users = spark.table(table).select(*USER_COLUMNS)
    path = f"{root}/exports/users/dt={previous_day(run_date)}"
    write_report(users, path, sep="|", compression="gzip", mode="overwrite")


def report_auctions(spark: SparkSession, root: str, run_date: str) -> None:
    """Number of auctions, bids per item, expensive auctions."""
    base = f"{root}/reports/auctions/dt={previous_day(run_date)}"
    with persisted(read_delimited(spark, f"{root}/auctions", auctions.AUCTIONS, sep=",")) as bids:
        write_report(auctions.auction_total(bids), f"{base}/total", mode="overwrite")
        write_report(auctions.bids_per_item(bids), f"{base}/items", sort_by=["item"], mode="overwrite")
        expensive = auctions.expensive_auctions(bids)
        write_report(expensive, f"{base}/expensive", sort_by=["price", "Auction Id", "item"], mode="overwrite")


def check_events(spark: SparkSession, root: str, run_date: str, *, column: str = "ip", limit: int = 50) -> None:
    """Rows of the event file with an over-long value, and the file's row and distinct-row counts."""
    day = previous_day(run_date)
    events = spark.read.parquet(f"{root}/events/dt={day}")
    write_lines(quality.over_long(events, column, limit), f"{root}/quality/over_long/dt={day}", mode="overwrite")
    write_report(duplicate_profile(events), f"{root}/quality/duplicates/dt={day}", mode="overwrite")


def prepare_flights(spark: SparkSession, root: str, run_date: str) -> None:
    """Balanced training and test rows from flight lines; rows that lack a feature go to ``rejects``."""
    flights = spark.read.schema(features.FLIGHT).csv(f"{root}/flights")
    # the row id: a hash of the whole line, the same in every run
    identified = flights.withColumn("row_id", F.xxhash64(*flights.columns))
    base = f"{root}/flight_features/dt={previous_day(run_date)}"
    with scratch(spark, "flight-features") as staging:
        rows = stage(features.feature_rows(identified, ["row_id"]), staging)
        balanced = stratified_downsample(rows, "label", "row_id", {0.0: ON_TIME_KEPT})
        # from the staged rows, which are read once for each side
        for name, part in zip(("train", "test"), train_test_split(balanced, "row_id")):
            write_snapshot(features.labelled_points(part), f"{base}/{name}")
        write_snapshot(features.incomplete_rows(balanced), f"{base}/rejects")


def count_words(spark: SparkSession, root: str, run_date: str, *, available_now: bool = False) -> None:
    """Word counts of every micro-batch of text files arriving below ``<root>/lines``."""
    lines = file_lines(spark, f"{root}/lines", "value string", "value", format="text")
    query = start_word_count(
        lines, f"{root}/word_counts", f"{root}/word_counts_checkpoint", available_now=available_now
    )
    query.awaitTermination()


JOBS: dict[str, Callable] = {
    "shred-audit-log": shred_audit_log,
    "report-keywords": report_keywords,
    "summarize-keywords": summarize_keywords,
    "report-unassigned-ad-groups": report_unassigned_ad_groups,
    "snapshot-matches": snapshot_matches,
    "record-match-rate": record_match_rate,
    "export-users": export_users,
    "report-auctions": report_auctions,
    "check-events": check_events,
    "prepare-flights": prepare_flights,
    "count-words": count_words,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--root", required=True)
    parser.add_argument("--run-date", required=True)
    parser.add_argument("--url", help="record-match-rate: text the action's name must hold")
    parser.add_argument("--allow-missing", action="store_true", help="audit log and keywords: accept a day without a source")
    parser.add_argument("--min-rows", type=int, help="audit log and keywords: fewest rows worth a table")
    chosen = parser.parse_args(arguments)
    options = {}
    if chosen.url is not None:
        options["url"] = chosen.url
    if chosen.min_rows is not None:
        options["min_rows"] = chosen.min_rows
    if chosen.allow_missing:
        options["allow_missing"] = True
    spark = build_session(f"driftwell {chosen.job}")
    JOBS[chosen.job](spark, chosen.root, chosen.run_date, **options)


if __name__ == "__main__":
    main()
