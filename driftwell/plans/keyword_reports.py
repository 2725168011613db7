"""Reports on keyword changes found in the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.operators.joins import join_aggregate, star_join
from driftwell.operators.products import product_by_key
from driftwell.plans.audit_log import KEYWORD_SOURCE, parse_log
from driftwell.schemas import WRITE_REPORT_COLUMNS

# Record filters and field names.
WRITE, CREATE, KEYWORD_ENTITY = "Write", "Create", "KEYWORD"
CREATE_FIELDS = ("id", "name", "createdDateTime", "lastModifiedDateTime", "adGroupId", "stateId")
# Report columns.
SUMMARY_COLUMNS = (
    "USER ID",
    "ADGROUP ID",
    "COMPANY",
    "ADGROUP NAME",
    "CAMPAIGN NAME",
    "STATUS",
    "TOTAL KW EDITS",
    "MODIFIED VALUE",
)
CREATE_COLUMNS = (
    "AUDIT ID",
    "USER ID",
    "LOG DATE TIME",
    "KEYWORD ID",
    "NAME",
    "CREATED",
    "LAST MODIFIED",
    "ADGROUP ID",
    "STATE ID",
)


# Parts of a created keyword: its record, that is who and when, and what is given for each field.
RECORD, GIVEN = "record", "new "


def keyword_records(log: DataFrame) -> DataFrame:
    """The keyword records of a change log, parsed.

    Filtered before parsing, so the JSON of other records is never looked at.  The reports read
    the result several times; hand them a stored copy (``sources.writers.stage``) so that the log
    is read and parsed once.
    """
    return parse_log(log.where(F.col("Source") == KEYWORD_SOURCE))


def write_report(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """Every field change of a keyword with the keyword's name, state and ad group.

    ``records`` are parsed keyword records, ``keywords`` the keyword master.

    Changes meet their record's user and time by audit id, and the audit id's keywords by audit id
    alone: if several records share an id, each of its keywords is shown with each of its changes.
    The changes stay one array per record until the last step, so the joins move one row per
    record and not one per field.
    """
    writes = records.where(F.col("Summary") == WRITE)
    users = writes.select("Id", "UserName", "LogDateTime")
    changes = writes.where((F.col("details.entityType") == KEYWORD_ENTITY) & (F.size("details.fields") > 0)).select(
        "Id", F.col("details.entityId").try_cast("bigint").alias("entityId"), "details.fields"
    )
    edits = changes.join(users, "Id")
    edited = changes.select("Id", "entityId").where("Id is not null").distinct()
    master = keywords.select(
        F.col("Id").alias("entityId"), F.col("Name"), F.col("StateId"), F.col("AdGroupId")
    )
    named = edited.join(master, "entityId", "left").drop("entityId")
    return (
        named.join(edits.drop("entityId"), "Id")
        .withColumn("f", F.explode("fields"))
        .select(
            "Id", "AdGroupId", "UserName", "LogDateTime", "Name", "f.fieldName", "f.newValue", "f.oldValue", "StateId"
        )
        .toDF(*WRITE_REPORT_COLUMNS)
    )


def write_summary(report: DataFrame, ad_groups: DataFrame, campaigns: DataFrame, advertisers: DataFrame) -> DataFrame:
    """Edits per ad group, with company and campaign, from the write report.

    ``ad_groups`` has ``ADGROUP ID, ADGROUP NAME, CAMPAIGN ID``, ``campaigns`` has ``CAMPAIGN ID,
    ADV ID, CAMPAIGN NAME`` and ``advertisers`` has ``ADV ID, ADV NAME``.  Changes without an ad
    group drop.  The report holds the ad group id as text; it is matched as a number.

    Equal edits are counted together map-side before anything else, so that a busy ad group goes
    through the joins as its distinct edits and the totals are sums over those.
    """
    known = report.where(F.col("ADGROUP ID").isNotNull())
    edits = known.groupBy("ADGROUP ID", "USER ID", "STATE ID", "KEYWORD").agg(F.count("*").alias("_n"))
    totals = edits.groupBy("ADGROUP ID").agg(F.sum("_n").alias("TOTAL KW EDITS"))
    keyed = join_aggregate(edits, totals, ["ADGROUP ID"]).withColumn("_group", F.col("ADGROUP ID").try_cast("bigint"))
    groups = ad_groups.select(F.col("ADGROUP ID").cast("bigint").alias("_group"), "ADGROUP NAME", "CAMPAIGN ID")
    joined = star_join(keyed, (groups, "_group"), (campaigns, "CAMPAIGN ID"), (advertisers, "ADV ID"))
    return (
        joined.select(
            "USER ID",
            "ADGROUP ID",
            "ADV NAME",
            "ADGROUP NAME",
            "CAMPAIGN NAME",
            "STATE ID",
            "TOTAL KW EDITS",
            "KEYWORD",
        )
        .toDF(*SUMMARY_COLUMNS)
        .distinct()
    )


def create_report(records: DataFrame) -> DataFrame:
    """Created keywords: one row per audit id that gives all six fields, each possibly null.

    The fields of an audit id may come from several of its records.  A missing field gives no row,
    one given several times a row for each, and several records of an id are each shown with all of
    its fields, as joining seven frames by audit id would; see ``product_by_key`` for how an id with
    very many of them is spread over tasks.
    """
    creates = records.where((F.col("Summary") == CREATE) & F.col("Id").isNotNull())

    def entry(part: Column, *value: Column) -> Column:
        return F.struct(part.alias("part"), F.array(*value).alias("value"))

    record = F.array(entry(F.lit(RECORD), F.col("UserName"), F.col("LogDateTime")))
    wanted = F.filter("details.fields", lambda f: f["fieldName"].isin(*CREATE_FIELDS))
    given = F.transform(wanted, lambda f: entry(F.concat(F.lit(GIVEN), f["fieldName"]), f["newValue"]))
    entries = F.concat(record, F.coalesce(given, F.array().cast("array<struct<part:string,value:array<string>>>")))
    values = creates.select("Id", F.explode(entries).alias("e")).select("Id", "e.part", "e.value")
    named = [GIVEN + name for name in CREATE_FIELDS]
    rows = product_by_key(values, "Id", "part", "value", (RECORD, *named))
    fields = [F.col(f"`{name}`")[0] for name in named]
    return rows.select("Id", F.col(RECORD)[0], F.col(RECORD)[1], *fields).toDF(*CREATE_COLUMNS)
