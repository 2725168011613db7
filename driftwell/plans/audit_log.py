"""Shredding of the change log into typed tables.

A log record carries a JSON document that says which entity changed and lists its changed fields;
the old and the new value of a field may be a scalar, an array, an object or null.  The document is
parsed once, with a fixed schema, and every output is a projection of that parse: no inference, no
per-day schema, no shuffle.

Old values are dispatched row by row.  An array gives one row for each element, in the typed
columns, with ``OldValue`` null; anything else gives one row whose ``OldValue`` is its raw text
(null for null).  New values are always exploded; one that is not an array is a reject, as is a
record whose details are not JSON.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dataclass_field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.functions.text import is_json_array
from driftwell.schemas import DETAILS
from driftwell.sources.readers import json_rows
from driftwell.sources.publish import publish_day
from driftwell.sources.writers import stage


@dataclass(frozen=True)
class Entity:
    """A kind of log record and the columns of its entity table."""

    source: str
    output: str
    has_type: bool = True
    has_parent: bool = True
    fields_output: str | None = None


@dataclass(frozen=True)
class ElementField:
    """A field whose value is an array, and the typed columns of an element.

    ``columns`` maps a path inside the element to an output column (without its New/Old prefix)
    and a type; an empty map means the elements are scalars.
    """

    name: str
    output: str
    columns: dict[str, tuple[str, str]] = dataclass_field(default_factory=dict)
    scalar_column: str | None = None


# Record kinds, output names, and which kinds have a type and a parent.
LOG_MASTER, REJECTS = "logmaster", "rejects"
AD_GROUP = Entity("MV_AdGroup", "logadgroup")
AUDIENCE = Entity("Audience", "audience")
SITE = Entity("MV_Site", "site", has_parent=False)
ENTITIES = (
    AD_GROUP,
    SITE,
    Entity("MV_Creative", "creative"),
    Entity("MV_Advertiser", "advertiser", has_parent=False, fields_output="advertiser_fields"),
    Entity("MV_Action", "action", has_parent=False, fields_output="action_fields"),
    Entity("MV_Campaign", "campaign", fields_output="campaign_fields"),
    Entity("MV_GlobalDomain", "global_domain", has_type=False, fields_output="global_domain_fields"),
    Entity("MV_GlobalDomainList", "global_domain_list", fields_output="global_domain_list_fields"),
    Entity("MV_AdvertiserDomain", "advertiser_domain", has_type=False, fields_output="advertiser_domain_fields"),
    Entity("MV_AdvertiserDomainList", "advertiser_domain_list", fields_output="advertiser_domain_list_fields"),
)
KEYWORD_SOURCE = "MV_Keyword"

# The ad group's array fields, their element columns and output names.
ELEMENT_FIELDS = (
    ElementField(
        "dayPartings",
        "adgroup/dayparting",
        {
            "bidAdjustment": ("BidAdjustment", "double"),
            "dayOfWeek": ("DayOfWeek", "string"),
            "dayPartingId": ("DayPartingId", "bigint"),
            "endHour": ("EndHour", "bigint"),
            "startHour": ("StartHour", "bigint"),
        },
    ),
    ElementField(
        "adGroupRecencies",
        "adgroup/agRecencies",
        {
            "adjustment": ("Adjustment", "double"),
            "frequencyId": ("FrequencyId", "bigint"),
            "recencyId": ("RecencyId", "bigint"),
            "recencyWindow": ("RecencyWindow", "bigint"),
        },
    ),
    ElementField(
        "adGroupToTDDeviceTypes",
        "adgroup/tddevicetypes",
        {
            "bidAdjustment": ("BidAdjustment", "double"),
            "tradeDeskDeviceTypeId": ("TDDeviceTypeId", "bigint"),
        },
    ),
    ElementField(
        "geoFences",
        "adgroup/geofences",
        {
            "coordinates.x": ("CoordinatesX", "double"),
            "coordinates.y": ("CoordinatesY", "double"),
            "geoFenceTypeId": ("GeoFenceTypeId", "bigint"),
        },
    ),
    ElementField("postalCodes", "adgroup/postal_codes", scalar_column="PostCodes"),
)
AUDIENCE_FIELD, AUDIENCE_OUTPUT = "audienceId", "adgroup/audienceid"
URLS_FIELD, URLS_OUTPUT = "urls", "siteurls"


def parse_log(log: DataFrame) -> DataFrame:
    """The log with ``details``, a struct, in place of the text ``Details``."""
    return json_rows(log, "Details", DETAILS, "details")


def _id(name: str) -> Column:
    """An id of the details; read as text, so one given as a JSON string is found as well."""
    return F.col(f"details.{name}").try_cast("bigint").alias(name)


def rejects(parsed: DataFrame) -> DataFrame:
    """Records whose details are not a JSON document, with the text as it came."""
    return parsed.where("details._corrupt is not null").select("Id", "Source", F.col("details._corrupt").alias("Details"))


def rejected_values(fields: DataFrame, spec: ElementField) -> DataFrame:
    """New values of an array field that are not such an array: ``eid, fieldName, newValue``."""
    given = fields.where((F.col("fieldName") == spec.name) & F.col("newValue").isNotNull())
    return given.where(_array_of("newValue", spec).isNull()).select("eid", "fieldName", "newValue")


def all_rejects(parsed: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """What no other table holds: ``Id, Source, fieldName, text``; a whole record has no field name.

    ``fields`` are the ad groups' field rows, where they are at hand.
    """
    group = AD_GROUP.source
    rows = field_rows(parsed, group) if fields is None else fields
    arrays = [_array_of("newValue", spec).isNull() & (F.col("fieldName") == spec.name) for spec in ELEMENT_FIELDS]
    values = rows.where(F.col("newValue").isNotNull() & reduce(lambda a, b: a | b, arrays))
    records = rejects(parsed).select("Id", "Source", F.lit(None).cast("string").alias("fieldName"), F.col("Details").alias("text"))
    return records.unionAll(values.select("eid", F.lit(group), "fieldName", "newValue"))


def log_master(log: DataFrame) -> DataFrame:
    return log.select("Id", "UserName", "AuditTypeId", "Source", "Summary", "LogDateTime", "WhoId")


def of_kind(parsed: DataFrame, source: str) -> DataFrame:
    return parsed.where(F.col("Source") == source)


def entity_rows(parsed: DataFrame, entity: Entity) -> DataFrame:
    """One row per record: ids, and the changed fields as three parallel arrays."""
    columns = [F.col("Id"), _id("entityId")]
    if entity.has_type:
        columns.append(F.col("details.entityType"))
    if entity.has_parent:
        columns.append(_id("parentId"))
    return of_kind(parsed, entity.source).select(
        *columns, "details.fields.fieldName", "details.fields.newValue", "details.fields.oldValue"
    )


def whole_records(parsed: DataFrame, entity: Entity) -> DataFrame:
    details = F.struct(_id("entityId"), F.col("details.entityType"), _id("parentId"), F.col("details.fields"))
    return of_kind(parsed, entity.source).select("Id", details.alias("Details"))


def field_rows(parsed: DataFrame, source: str | None = None) -> DataFrame:
    """One row per changed field, of one record kind or of all; records without fields give none."""
    return (
        (parsed if source is None else of_kind(parsed, source))
        .select(F.col("Id").alias("eid"), exploded_fields("details.fields").alias("f"))
        .where("f is not null")
        .select("eid", "f.fieldName", "f.newValue", "f.oldValue")
    )


def exploded_fields(column: str) -> Column:
    """The fields one by one, and one null for a record without any, which the caller filters out.

    For a plain ``explode`` the optimizer adds a filter on the array's size below it, and on a
    column that is still to be parsed that filter parses every document a second time.
    """
    return F.explode_outer(column)


def new_elements(fields: DataFrame, spec: ElementField) -> DataFrame:
    """Elements of the new value of one array field."""
    return (
        fields.where(F.col("fieldName") == spec.name)
        .select("eid", F.explode(_array_of("newValue", spec)).alias("e"))
        .select("eid", *_element_columns(spec, "New"))
    )


def old_elements(fields: DataFrame, spec: ElementField) -> DataFrame:
    """Elements of the old value where it is an array, its raw text where it is not."""
    chosen = fields.where(F.col("fieldName") == spec.name).withColumn("elements", _array_of("oldValue", spec))
    # An array explodes to its elements (none if empty); any other value, and text that only looks
    # like an array, keeps its row.
    none = F.array(F.lit(None).cast(_element_type(spec)))
    rows = chosen.select(
        "eid",
        F.when(F.col("elements").isNull(), F.col("oldValue")).alias("OldValue"),
        F.explode(F.coalesce("elements", none)).alias("e"),
    )
    if spec.scalar_column is not None:
        return rows.select("eid", F.coalesce("e", "OldValue").alias(f"Old{spec.scalar_column}"))
    return rows.select("eid", *_element_columns(spec, "Old"), "OldValue")


def scalar_change(fields: DataFrame, name: str, key: str, old: str, new: str) -> DataFrame:
    """Old and new raw value of one field, without exploding either."""
    return fields.where(F.col("fieldName") == name).select(
        F.col("eid").alias(key), F.col("oldValue").alias(old), F.col("newValue").alias(new)
    )


def audience_changes(fields: DataFrame) -> DataFrame:
    return scalar_change(fields, AUDIENCE_FIELD, "eid", "OldAudienceId", "NewAudienceId")


def site_urls(fields: DataFrame) -> DataFrame:
    return scalar_change(fields, URLS_FIELD, "Id", "OldUrl", "NewUrl").select("Id", "NewUrl", "OldUrl")


def _element_type(spec: ElementField) -> str:
    if not spec.columns:
        return "string"
    # Leaves are read as text and cast afterwards: a number written as a string is still read.
    members: dict[str, list[str]] = {}
    for path in spec.columns:
        head, _, rest = path.partition(".")
        members.setdefault(head, []).append(rest)
    parts = []
    for head, inner in members.items():
        nested = ", ".join(f"{name}:string" for name in inner)
        parts.append(f"{head}:struct<{nested}>" if inner != [""] else f"{head}:string")
    return f"struct<{', '.join(parts)}>"


def _array_of(column: str, spec: ElementField) -> Column:
    text = F.col(column)
    return F.when(is_json_array(text), F.from_json(text, f"array<{_element_type(spec)}>"))


def _element_columns(spec: ElementField, side: str) -> list[Column]:
    if spec.scalar_column is not None:
        return [F.col("e").alias(f"{side}{spec.scalar_column}")]
    return [
        F.col(f"e.{path}").try_cast(kind).alias(f"{side}{name}") for path, (name, kind) in spec.columns.items()
    ]


@dataclass(frozen=True)
class Output:
    """An output table: its record kind and field (None for all), and how it is made."""

    source: str | None
    field_name: str | None
    build: Callable[[DataFrame], DataFrame]
    # The same from field rows of the ad groups, for the tables of one field.
    of_fields: Callable[[DataFrame], DataFrame] | None = None


def _output_tables() -> dict[str, Output]:
    tables = {LOG_MASTER: Output(None, None, log_master)}
    for entity in ENTITIES:
        tables[entity.output] = Output(entity.source, None, lambda p, e=entity: entity_rows(p, e))
        if entity.fields_output:
            tables[entity.fields_output] = Output(entity.source, None, lambda p, e=entity: field_rows(p, e.source))
    tables[AUDIENCE.output] = Output(AUDIENCE.source, None, lambda p: whole_records(p, AUDIENCE))
    tables[URLS_OUTPUT] = Output(SITE.source, None, lambda p: site_urls(field_rows(p, SITE.source)))
    group = AD_GROUP.source
    for spec in ELEMENT_FIELDS:
        for side, elements in (("new", new_elements), ("old", old_elements)):
            of_fields = lambda f, s=spec, e=elements: e(f, s)
            tables[f"{spec.output}/{side}"] = Output(
                group, spec.name, lambda p, of=of_fields: of(field_rows(p, group)), of_fields
            )
    tables[AUDIENCE_OUTPUT] = Output(
        group, AUDIENCE_FIELD, lambda p: audience_changes(field_rows(p, group)), audience_changes
    )
    tables[REJECTS] = Output(None, None, all_rejects)
    return tables


OUTPUTS = _output_tables()
# The staging directory of all records without an entity table.
OTHER_KIND = "other"


def shred_day(
    log: DataFrame,
    target: str,
    day: str,
    staging: str,
    *,
    min_rows: int = 1,
    mode: str = "overwrite",
) -> list[str]:
    """Write all tables of one day below ``target`` and return the names of those written.

    The parsed records are written below ``staging`` once, one directory per known record kind and
    one for all others, in files sized by their bytes; the ad groups' special fields are exploded
    once, one directory per field.  Each table then reads only its own directory, and a lost
    executor costs a re-read of parquet rather than a new parse.  A table is written if its record
    kind, and its field where it has one, has at least ``min_rows`` rows.  Tables of one schema are
    written by one job, and all tables are published together (``sources.publish``): each goes to
    ``dt=<day>``, where an existing day is replaced, and where there is nothing to write it is
    deleted, so a rerun leaves nothing of an earlier run; a run that fails leaves the old day whole.
    ``mode="errorifexists"`` refuses instead.
    The caller deletes ``staging``.
    """
    spark = log.sparkSession
    known = [e.source for e in ENTITIES] + [AUDIENCE.source]
    kind = F.when(F.col("Source").isin(*known), F.col("Source")).otherwise(OTHER_KIND)
    parsed = stage(parse_log(log).withColumn("kind", kind).hint("rebalance", "kind"), f"{staging}/records", "kind")
    special = [spec.name for spec in ELEMENT_FIELDS] + [AUDIENCE_FIELD]
    of_group = parsed.where(F.col("kind") == AD_GROUP.source)
    exploded = field_rows(of_group, AD_GROUP.source).where(F.col("fieldName").isin(*special))
    fields = stage(exploded.hint("rebalance", "fieldName"), f"{staging}/fields", "fieldName")
    # All gates: one row per record kind and one per special field.
    kinds = parsed.groupBy("kind").agg(F.count("*").alias("n")).select("kind", F.lit(None).cast("string"), "n")
    per_field = fields.groupBy("fieldName").agg(F.count("*").alias("n")).select(F.lit(AD_GROUP.source), "fieldName", "n")
    sizes = {(r[0], r[1]): r[2] for r in kinds.union(per_field).collect()}

    def wanted(output: Output) -> bool:
        gates = [] if output.source is None else [(output.source, None)]
        if output.field_name is not None:
            gates.append((output.source, output.field_name))
        return all(sizes.get(gate, 0) >= min_rows for gate in gates)

    def table(name: str) -> DataFrame:
        output = OUTPUTS[name]
        if name == REJECTS:
            return all_rejects(parsed, fields)
        if output.of_fields is not None:
            return output.of_fields(fields.where(F.col("fieldName") == output.field_name))
        return output.build(parsed if output.source is None else parsed.where(F.col("kind") == output.source))

    written = [name for name, output in OUTPUTS.items() if wanted(output)]
    tables = {name: table(name) for name in written}
    publish_day(spark, target, day, tables, set(OUTPUTS) - set(written), overwrite=mode == "overwrite")
    return written
