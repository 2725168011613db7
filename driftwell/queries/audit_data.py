"""A change log made of the orders: one record per order, its details built from the order's columns.

The expressions up to the field lists are SQL that reads the same in Spark and in the SQL the
results are checked with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.plans.audit_log import AUDIENCE, AUDIENCE_FIELD, ELEMENT_FIELDS, ENTITIES, KEYWORD_SOURCE, ElementField
from driftwell.queries.catalog import Tables

KINDS = ("MV_AdGroup", "Audience") + tuple(e.source for e in ENTITIES[1:]) + (KEYWORD_SOURCE,)
assert AUDIENCE.source == KINDS[1]

KIND_SQL = (
    f"(CASE o_orderkey % {len(KINDS)} " + " ".join(f"WHEN {i} THEN '{kind}'" for i, kind in enumerate(KINDS)) + " END)"
)
# An ad group record changes one of six fields, in one of five shapes (old to new): array to array,
# null to array, scalar to array, array to null, empty array to array.
SLOT_SQL = f"(CAST(floor(o_orderkey / {len(KINDS)}) AS BIGINT) % 6)"
SHAPE_SQL = f"(CAST(floor(o_orderkey / {len(KINDS) * 6}) AS BIGINT) % 5)"
SLOT_FIELDS = tuple(spec.name for spec in ELEMENT_FIELDS) + (AUDIENCE_FIELD,)
NEW_ELEMENTS, OLD_ELEMENTS = (1, 2), (3,)


def leaf_sql(column: int, kind: str, element: int | str) -> str:
    """Value of a leaf: its column number and element number are part of it."""
    number = f"((o_custkey % 1000) * 100 + {10 * column} + {element})"
    return {"double": f"({number} + 0.5)", "string": f"('d' || {number})"}.get(kind, number)


def postal_sql(element: int | str) -> str:
    return f"('P' || {leaf_sql(0, 'bigint', element)})"


def _json_leaf(column: int, kind: str, element: int) -> str:
    value = leaf_sql(column, kind, element)
    return f"""'"' || {value} || '"'""" if kind == "string" else value


def elements_sql(spec: ElementField, elements: tuple[int, ...]) -> str:
    """JSON text of an array value."""
    items = []
    for element in elements:
        if spec.scalar_column is not None:
            items.append(f"""'"' || {postal_sql(element)} || '"'""")
            continue
        members: dict[str, list[tuple[str, str]]] = {}
        for column, (path, (_, kind)) in enumerate(spec.columns.items()):
            head, _, rest = path.partition(".")
            members.setdefault(head, []).append((rest, _json_leaf(column, kind, element)))
        texts = []
        for head, inner in members.items():
            if inner[0][0]:
                nested = " || ',' || ".join(f"""'"{name}":' || {value}""" for name, value in inner)
                texts.append(f"""'"{head}":{{' || {nested} || '}}'""")
            else:
                texts.append(f"""'"{head}":' || {inner[0][1]}""")
        items.append("'{' || " + " || ',' || ".join(texts) + " || '}'")
    return "'[' || " + " || ',' || ".join(items) + " || ']'"


def _per_slot(texts: list[str]) -> str:
    return f"(CASE {SLOT_SQL} " + " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(texts)) + " END)"


# JSON text of the ad group field's values; 'null' is JSON's.
_NEW_ARRAYS = _per_slot([elements_sql(s, NEW_ELEMENTS) for s in ELEMENT_FIELDS])
_OLD_ARRAYS = _per_slot([elements_sql(s, OLD_ELEMENTS) for s in ELEMENT_FIELDS])
AUDIENCE_NEW_SQL = "('' || o_custkey)"
AUDIENCE_OLD_SQL = f"(CASE WHEN {SHAPE_SQL} = 1 THEN NULL ELSE '' || (o_custkey + 1) END)"
GROUP_NEW_SQL = f"""(CASE WHEN {SLOT_SQL} = 5 THEN {AUDIENCE_NEW_SQL} WHEN {SHAPE_SQL} = 3 THEN NULL ELSE {_NEW_ARRAYS} END)"""
GROUP_OLD_SQL = f"""(CASE WHEN {SLOT_SQL} = 5 THEN {AUDIENCE_OLD_SQL} WHEN {SHAPE_SQL} = 1 THEN NULL
  WHEN {SHAPE_SQL} = 2 THEN '' || o_custkey WHEN {SHAPE_SQL} = 4 THEN '[]' ELSE {_OLD_ARRAYS} END)"""
GROUP_FIELD_SQL = f"(CASE {SLOT_SQL} " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(SLOT_FIELDS)) + " END)"


def _entry(name: str, new: str, old: str) -> str:
    return f"""'{{"fieldName":"' || {name} || '","newValue":' || {new} || ',"oldValue":' || {old} || '}}'"""


def _string(value: str) -> str:
    return f"""coalesce('"' || {value} || '"', 'null')"""


_DAY = "substring(CAST(o_orderdate AS STRING), 1, 10)"
_URL = "('http://site' || o_custkey || '/')"
_PLAIN_FIELDS = (
    _entry("'name'", _string("o_orderpriority"), "'null'")
    + " || ',' || "
    + _entry("'status'", "o_custkey", _string("o_orderstatus"))
)
_SITE_FIELDS = _entry("'urls'", _string(_URL), "(CASE o_orderstatus WHEN 'F' THEN '[1,2]' ELSE 'null' END)") + " || ',' || " + _PLAIN_FIELDS
_GROUP_FIELDS = (
    _entry(GROUP_FIELD_SQL, f"coalesce({GROUP_NEW_SQL}, 'null')", f"coalesce({GROUP_OLD_SQL}, 'null')")
    + " || ',' || "
    + _entry("'name'", _string("o_orderpriority"), "'null'")
)


def _create_fields(day: str) -> str:
    def given(name: str, value: str) -> str:
        return _entry(f"'{name}'", value, "'null'")

    always = [
        given("id", "o_orderkey"),
        given("name", _string("nullif(o_orderpriority, '5-LOW')")),
        given("createdDateTime", _string(day)),
        given("lastModifiedDateTime", _string(day)),
        given("stateId", "1"),
    ]
    # medium orders lack the ad group, urgent ones give the state twice
    ad_group = f"(CASE o_orderpriority WHEN '3-MEDIUM' THEN '' ELSE ',' || {given('adGroupId', 'o_custkey')} END)"
    state = f"(CASE o_orderpriority WHEN '1-URGENT' THEN ',' || {given('stateId', '2')} ELSE '' END)"
    return " || ',' || ".join(always) + f" || {ad_group} || {state}"


ENTITY_TYPE_SQL = f"(CASE {KIND_SQL} WHEN '{KEYWORD_SOURCE}' THEN 'KEYWORD' ELSE {KIND_SQL} END)"
_IDS = f"""'{{"entityId":' || (o_custkey * 2) || ',"entityType":"' || {ENTITY_TYPE_SQL} || '","parentId":' || o_custkey"""
_FIELDS = f"""(CASE WHEN {KIND_SQL} = 'MV_AdGroup' THEN {_GROUP_FIELDS}
  WHEN {KIND_SQL} = 'MV_Site' THEN {_SITE_FIELDS}
  WHEN {KIND_SQL} = '{KEYWORD_SOURCE}' AND o_orderstatus = 'P' THEN {_create_fields(_DAY)}
  ELSE {_PLAIN_FIELDS} END)"""
# Pending orders stand for the odd records: creative ones have no fields, action ones are not
# JSON, campaign ones have no details.
DETAILS_SQL = f"""(CASE WHEN o_orderstatus = 'P' AND {KIND_SQL} = 'MV_Creative' THEN {_IDS} || '}}'
  WHEN o_orderstatus = 'P' AND {KIND_SQL} = 'MV_Action' THEN 'not json {{' || o_orderkey
  WHEN o_orderstatus = 'P' AND {KIND_SQL} = 'MV_Campaign' THEN NULL
  ELSE {_IDS} || ',"fields":[' || {_FIELDS} || ']}}' END)"""


def audit_log(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("Id"),
        F.expr("'user' || (o_custkey % 50)").alias("UserName"),
        F.expr("CAST(o_custkey % 4 AS INT)").alias("AuditTypeId"),
        F.expr(KIND_SQL).alias("Source"),
        F.expr("CASE o_orderstatus WHEN 'P' THEN 'Create' ELSE 'Write' END").alias("Summary"),
        F.expr(DETAILS_SQL).alias("Details"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("LogDateTime"),
        F.expr("'who' || (o_custkey % 20)").alias("WhoId"),
    )
