"""The change-log shredder: every output table, checked against values computed from the orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.plans import audit_log as plan, schema_drift
from driftwell.queries.audit_data import (
    AUDIENCE_NEW_SQL,
    AUDIENCE_OLD_SQL,
    DETAILS_SQL,
    ENTITY_TYPE_SQL,
    GROUP_FIELD_SQL,
    GROUP_NEW_SQL,
    GROUP_OLD_SQL,
    KIND_SQL,
    KINDS,
    NEW_ELEMENTS,
    OLD_ELEMENTS,
    SHAPE_SQL,
    SLOT_FIELDS,
    SLOT_SQL,
    audit_log,
    leaf_sql,
    postal_sql,
)
from driftwell.queries.catalog import Tables, query

# Names of the outputs that stand for an operator; the others are called after their table.
_KEYS = {
    "logadgroup": "audit_entity",
    "campaign_fields": "audit_fields",
    "adgroup/dayparting/new": "audit_array_elements",
    "adgroup/dayparting/old": "audit_old_fallback",
    "adgroup/audienceid": "audit_scalar_change",
}
_MASTER_SQL = f"""
SELECT o_orderkey AS "Id", 'user' || (o_custkey % 50) AS "UserName", CAST(o_custkey % 4 AS INTEGER) AS "AuditTypeId",
       {KIND_SQL} AS "Source", CASE o_orderstatus WHEN 'P' THEN 'Create' ELSE 'Write' END AS "Summary",
       strftime(o_orderdate, '%Y-%m-%d') AS "LogDateTime", 'who' || (o_custkey % 20) AS "WhoId"
FROM orders
"""
# The odd records among pending orders, by kind: see the data module.
_NO_FIELDS = f"(o_orderstatus = 'P' AND {KIND_SQL} IN ('MV_Creative', 'MV_Action', 'MV_Campaign'))"
_NO_IDS = f"(o_orderstatus = 'P' AND {KIND_SQL} IN ('MV_Action', 'MV_Campaign'))"
_URL = "'http://site' || o_custkey || '/'"
_URL_OLD = "CASE o_orderstatus WHEN 'F' THEN '[1,2]' END"


def _field_lists(kind: str) -> list[tuple[str, str, str]]:
    """(name, new, old) SQL of the fields of a kind's records."""
    plain = [("'name'", "o_orderpriority", "NULL"), ("'status'", "CAST(o_custkey AS VARCHAR)", "o_orderstatus")]
    if kind == "MV_AdGroup":
        return [(GROUP_FIELD_SQL, GROUP_NEW_SQL, GROUP_OLD_SQL), plain[0]]
    if kind == "MV_Site":
        return [("'urls'", _URL, _URL_OLD), *plain]
    return plain


def _joined(kind: str, part: int) -> str:
    texts = [f"coalesce({entry[part]}, 'null')" for entry in _field_lists(kind)]
    joined = " || '|' || ".join(texts)
    return f"CASE WHEN {_NO_FIELDS} THEN NULL ELSE {joined} END"


def _ids_sql(entity: plan.Entity) -> str:
    columns = ['o_orderkey AS "Id"', f'CASE WHEN NOT {_NO_IDS} THEN o_custkey * 2 END AS "entityId"']
    if entity.has_type:
        columns.append(f'CASE WHEN NOT {_NO_IDS} THEN {ENTITY_TYPE_SQL} END AS "entityType"')
    if entity.has_parent:
        columns.append(f'CASE WHEN NOT {_NO_IDS} THEN o_custkey END AS "parentId"')
    return ", ".join(columns)


def _entity_sql(entity: plan.Entity) -> str:
    kind = entity.source
    return f"""SELECT {_ids_sql(entity)}, {_joined(kind, 0)} AS "fieldName", {_joined(kind, 1)} AS "newValue",
       {_joined(kind, 2)} AS "oldValue" FROM orders WHERE {KIND_SQL} = '{kind}'"""


def _entries(kind: str) -> list[tuple[str, str, str, str]]:
    """(name, new, old, condition) SQL of the fields of a kind's records."""
    plain = [(*entry, "true") for entry in _field_lists(kind)]
    if kind != plan.KEYWORD_SOURCE:
        return plain
    # pending orders are creations: medium ones lack the ad group, urgent ones give the state twice
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    given = [
        ("id", "CAST(o_orderkey AS VARCHAR)", "true"),
        ("name", "nullif(o_orderpriority, '5-LOW')", "true"),
        ("createdDateTime", day, "true"),
        ("lastModifiedDateTime", day, "true"),
        ("stateId", "'1'", "true"),
        ("adGroupId", "CAST(o_custkey AS VARCHAR)", "o_orderpriority <> '3-MEDIUM'"),
        ("stateId", "'2'", "o_orderpriority = '1-URGENT'"),
    ]
    created = [(f"'{name}'", new, "NULL", f"o_orderstatus = 'P' AND {condition}") for name, new, condition in given]
    return [(*entry[:3], "o_orderstatus <> 'P'") for entry in plain] + created


def _fields_sql(kind: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT o_orderkey AS eid, {name} AS "fieldName", {new} AS "newValue", {old} AS "oldValue"
        FROM orders WHERE {KIND_SQL} = '{kind}' AND NOT {_NO_FIELDS} AND {condition}"""
        for name, new, old, condition in _entries(kind)
    )


def _lists_sql(kind: str) -> str:
    """Names and new values of all fields of a record, joined; null for a record without any."""

    def joined(part: int) -> str:
        texts = [f"CASE WHEN {e[3]} THEN coalesce({e[part]}, 'null') END" for e in _entries(kind)]
        return f"CASE WHEN NOT {_NO_FIELDS} THEN concat_ws('|', {', '.join(texts)}) END"

    return f"""SELECT o_orderkey AS "Id", {joined(0)} AS names, {joined(1)} AS new_values FROM orders WHERE {KIND_SQL} = '{kind}'"""


def _elements_sql(spec: plan.ElementField, side: str) -> str:
    def columns(element: str | None) -> str:
        """Values of an element, or nulls of the same types."""
        types = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT"}
        return ", ".join(
            f'CAST({leaf_sql(i, kind, element) if element else "NULL"} AS {types[kind]}) AS "{side}{name}"'
            for i, (name, kind) in enumerate(spec.columns.values())
        )

    numbers = ", ".join(f"({i})" for i in (NEW_ELEMENTS if side == "New" else OLD_ELEMENTS))
    chosen = f"{KIND_SQL} = 'MV_AdGroup' AND {SLOT_SQL} = {SLOT_FIELDS.index(spec.name)}"
    arrays = f"FROM orders, (VALUES {numbers}) e(i) WHERE {chosen} AND {SHAPE_SQL}"
    raw = f"CASE WHEN {SHAPE_SQL} = 2 THEN CAST(o_custkey AS VARCHAR) END"
    if spec.scalar_column is not None:
        name = f'"{side}{spec.scalar_column}"'
        if side == "New":
            return f"SELECT o_orderkey AS eid, {postal_sql('i')} AS {name} {arrays} <> 3"
        return f"""SELECT o_orderkey AS eid, {postal_sql('i')} AS {name} {arrays} IN (0, 3)
        UNION ALL SELECT o_orderkey, {raw} FROM orders WHERE {chosen} AND {SHAPE_SQL} IN (1, 2)"""
    if side == "New":
        return f"SELECT o_orderkey AS eid, {columns('i')} {arrays} <> 3"
    return f"""SELECT o_orderkey AS eid, {columns('i')}, CAST(NULL AS VARCHAR) AS "OldValue" {arrays} IN (0, 3)
    UNION ALL SELECT o_orderkey, {columns(None)}, {raw} FROM orders WHERE {chosen} AND {SHAPE_SQL} IN (1, 2)"""


def output_sql() -> dict[str, str]:
    """SQL of every output table by name."""
    texts = {plan.LOG_MASTER: _MASTER_SQL}
    for entity in plan.ENTITIES:
        texts[entity.output] = _entity_sql(entity)
        if entity.fields_output:
            texts[entity.fields_output] = _fields_sql(entity.source)
    texts[plan.AUDIENCE.output] = _entity_sql(plan.AUDIENCE)
    texts[plan.URLS_OUTPUT] = f"""SELECT o_orderkey AS "Id", {_URL} AS "NewUrl", {_URL_OLD} AS "OldUrl"
    FROM orders WHERE {KIND_SQL} = 'MV_Site'"""
    for spec in plan.ELEMENT_FIELDS:
        for side in ("New", "Old"):
            texts[f"{spec.output}/{side.lower()}"] = _elements_sql(spec, side)
    texts[plan.AUDIENCE_OUTPUT] = f"""SELECT o_orderkey AS eid, {AUDIENCE_OLD_SQL} AS "OldAudienceId",
    {AUDIENCE_NEW_SQL} AS "NewAudienceId" FROM orders
    WHERE {KIND_SQL} = 'MV_AdGroup' AND {SLOT_SQL} = {SLOT_FIELDS.index(plan.AUDIENCE_FIELD)}"""
    return texts


def _text(column: Column) -> Column:
    return F.array_join(column, "|", "null")


def _flat(frame: DataFrame) -> DataFrame:
    """Arrays and structs as text, so that rows can be compared."""
    if "Details" in frame.columns:
        frame = frame.select(
            "Id",
            "Details.entityId",
            "Details.entityType",
            "Details.parentId",
            "Details.fields.fieldName",
            "Details.fields.newValue",
            "Details.fields.oldValue",
        )
    return frame.select(
        *[_text(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in frame.schema]
    )


def _register_outputs() -> None:
    for name, sql in output_sql().items():

        def build(t: Tables, name: str = name) -> DataFrame:
            return _flat(plan.OUTPUTS[name].build(plan.parse_log(audit_log(t))))

        query(sql, _KEYS.get(name, "audit_" + name.replace("adgroup/", "").replace("/", "_").lower()))(build)


_register_outputs()


@query(f'SELECT {KIND_SQL} AS "Source", count(*) AS n FROM orders GROUP BY 1')
def audit_route_counts(t: Tables) -> DataFrame:
    return audit_log(t).groupBy("Source").agg(F.count("*").alias("n"))


@query(f"""
SELECT o_orderkey AS "Id", {KIND_SQL} AS "Source", 'not json {{' || o_orderkey AS "Details" FROM orders
WHERE o_orderstatus = 'P' AND {KIND_SQL} = 'MV_Action'
""")
def audit_rejects(t: Tables) -> DataFrame:
    return plan.rejects(plan.parse_log(audit_log(t)))


@query(" UNION ALL ".join(_fields_sql(kind) for kind in KINDS))
def explode_fields(t: Tables) -> DataFrame:
    return plan.field_rows(plan.parse_log(audit_log(t)))


@query(" UNION ALL ".join(_lists_sql(kind) for kind in KINDS))
def array_struct_project(t: Tables) -> DataFrame:
    return plan.parse_log(audit_log(t)).select(
        "Id", _text(F.col("details.fields.fieldName")).alias("names"), _text(F.col("details.fields.newValue")).alias("new_values")
    )


@query(f"""
SELECT o_orderkey AS eid, 'audienceId' AS "fieldName", CAST(o_custkey AS VARCHAR) AS "newValue"
FROM orders WHERE {KIND_SQL} = 'MV_AdGroup' AND {SLOT_SQL} = {SLOT_FIELDS.index(plan.AUDIENCE_FIELD)}
""")
def audit_rejected_values(t: Tables) -> DataFrame:
    """Single values where an array is asked for."""
    fields = plan.field_rows(plan.parse_log(audit_log(t)), plan.AD_GROUP.source)
    return plan.rejected_values(fields, plan.ElementField(plan.AUDIENCE_FIELD, "", scalar_column="AudienceId"))


_REJECTS_SQL = f"SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND {KIND_SQL} = 'MV_Action'"


@query(" UNION ALL ".join(f"SELECT '{name}' AS output, count(*) AS n FROM ({sql})" for name, sql in (output_sql() | {plan.REJECTS: _REJECTS_SQL}).items()))
def audit_shred_day(t: Tables) -> DataFrame:
    """The whole job: all tables written for one day, then counted from the files."""
    target = t.scratch("shredded")
    written = plan.shred_day(audit_log(t), target, "2024-01-10", f"{target}-staging")
    # only rows are counted, so no column is read
    tables = [
        t.spark.read.schema("unread string").parquet(f"{target}/{name}/dt=2024-01-10").select(F.lit(name).alias("output"))
        for name in written
    ]
    return reduce(DataFrame.union, tables).groupBy("output").agg(F.count("*").alias("n"))


# The same tree walked by the other engine; a field's values are counted under its name.
_PATHS_SQL = rf"""
WITH log AS (SELECT {KIND_SQL} AS kind, {DETAILS_SQL} AS details FROM orders),
     good AS (SELECT kind, CAST(details AS JSON) AS doc FROM log WHERE coalesce(json_valid(details), false)),
     parts AS (
       SELECT kind, CAST(NULL AS VARCHAR) AS field, doc, '$' AS top FROM good
       UNION ALL
       SELECT kind, json_extract_string(e, '$.fieldName'), e, '$.fields[]' FROM (SELECT kind, unnest(json_extract(doc, '$.fields[*]')) AS e FROM good)),
     walked AS (
       SELECT kind, field, top || substr(regexp_replace(t.fullkey, '\[[0-9]+\]', '[]', 'g'), 2) AS path,
              CASE t.type WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'NULL' THEN 'VOID' WHEN 'VARCHAR' THEN 'STRING' ELSE t.type END AS type,
              top
       FROM parts, json_tree(parts.doc) t),
     paths AS (
       SELECT kind AS "Source", field AS "fieldName", path, type, count(*) AS n FROM walked
       WHERE NOT (top = '$' AND starts_with(path, '$.fields[]')) GROUP BY ALL
       UNION ALL
       SELECT kind, NULL, '$', CASE WHEN details IS NULL THEN 'MISSING' ELSE 'MALFORMED' END, count(*) FROM log
       WHERE NOT coalesce(json_valid(details), false) GROUP BY ALL)
"""


@query(f"{_PATHS_SQL} SELECT * FROM paths")
def audit_schema_paths(t: Tables) -> DataFrame:
    return schema_drift.log_paths(audit_log(t))


# Drift of the made-up log: old values of array fields that are single values, and unread documents.
@query(f"""{_PATHS_SQL}
SELECT * FROM paths WHERE type IN ('MISSING', 'MALFORMED')
  OR ("Source" = 'MV_AdGroup' AND "fieldName" IN ({", ".join(f"'{s.name}'" for s in plan.ELEMENT_FIELDS)})
      AND path = '$.fields[].oldValue' AND type NOT IN ('ARRAY', 'VOID'))
""")
def audit_schema_drift(t: Tables) -> DataFrame:
    return schema_drift.schema_drift(audit_log(t))
