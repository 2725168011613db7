"""What the change log holds beyond the schema it is parsed with.

The log's details are read with a fixed schema, so that tables never change from day to day.  This
report shows what that schema does not foresee: new keys, values of another type, documents that are
no JSON.  It parses each document once and shuffles counts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.operators.joins import anti_nullsafe
from driftwell.operators.json_paths import ROOT, path_counts
from driftwell.plans.audit_log import AD_GROUP, ELEMENT_FIELDS, ElementField

FIELDS = f"{ROOT}.fields"
ELEMENT = f"{FIELDS}[]"
SIDES = ("newValue", "oldValue")
# Levels looked into: as many as the fixed schema has below a field, and one more.
LEVELS = 6
# Types of documents that have no paths.
MALFORMED, MISSING = "MALFORMED", "MISSING"
# JSON types that each type of the fixed schema reads; null is foreseen everywhere.
_READS = {"bigint": ("BIGINT",), "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "string": ("STRING",)}


def _foreseen_of(name: str | None, path: str, *types: str) -> list[tuple[str | None, str, str]]:
    return [(name, path, kind) for kind in (*types, "VOID")]


def _foreseen_elements(spec: ElementField) -> list[tuple[str | None, str, str]]:
    found = []
    for side in SIDES:
        value = f"{ELEMENT}.{side}"
        found += _foreseen_of(spec.name, value, "ARRAY")
        found += _foreseen_of(spec.name, f"{value}[]", *(("OBJECT",) if spec.columns else ("STRING",)))
        inner = {path.rpartition(".")[0] for path in spec.columns} - {""}
        for path in sorted(inner):
            found += _foreseen_of(spec.name, f"{value}[].{path}", "OBJECT")
        for path, (_, kind) in spec.columns.items():
            found += _foreseen_of(spec.name, f"{value}[].{path}", *_READS[kind])
    return found


def foreseen() -> list[tuple[str | None, str, str]]:
    """``fieldName, path, type`` of the fixed schema; no field name for what holds of every record."""
    found = [(None, ROOT, "OBJECT")]
    for name in ("entityId", "parentId"):
        found += _foreseen_of(None, f"{ROOT}.{name}", "BIGINT")
    found += _foreseen_of(None, f"{ROOT}.entityType", "STRING")
    found += _foreseen_of(None, FIELDS, "ARRAY")
    for spec in ELEMENT_FIELDS:
        found += _foreseen_elements(spec)
    return found


def log_paths(log: DataFrame) -> DataFrame:
    """``Source, fieldName, path, type, n``: all paths of the details, by record kind and field.

    What lies in a changed field is counted under the field's name, everything else without one.
    A document that is not JSON counts as ``$`` of type ``MALFORMED``, an absent one as ``MISSING``.
    """
    parsed = log.select("Source", "Details", F.try_parse_json("Details").alias("_v"))
    # The record itself, then each of its fields, from the same parse.
    fields = F.try_variant_get("_v", FIELDS, "array<variant>")
    none = F.lit(None).cast("string")

    def part(name: Column, path: str, value: Column) -> Column:
        return F.struct(name.alias("name"), F.lit(path).alias("path"), value.alias("value"))

    record = F.array(part(none, ROOT, F.col("_v")))
    named = F.transform(fields, lambda e: part(F.try_variant_get(e, "$.fieldName", "string"), ELEMENT, e))
    parts = parsed.where("_v IS NOT NULL").select("Source", F.explode(F.concat(record, F.coalesce(named, F.array()))).alias("_p"))
    values = parts.select("Source", F.col("_p.name").alias("fieldName"), F.col("_p.path").alias("_root"), F.col("_p.value").alias("_v"))
    # The elements of a fields array are parts of their own; where it is no array it is looked into as it is.
    counts = path_counts(values, "_v", ["Source", "fieldName"], root=F.col("_root"), depth=LEVELS, skip=[FIELDS])
    unread = parsed.where("_v IS NULL").select("Source", F.when(F.col("Details").isNull(), MISSING).otherwise(MALFORMED).alias("type"))
    others = unread.groupBy("Source", "type").agg(F.count("*").alias("n"))
    return counts.unionByName(others.select("Source", none.alias("fieldName"), F.lit(ROOT).alias("path"), "type", "n"))


def schema_drift(log: DataFrame) -> DataFrame:
    """The paths and types of ``log_paths`` that the fixed schema does not foresee.

    Values of fields without a schema of their own may be anything and are no drift; names and
    types around them are.  Only the ad groups' records have fields with a schema of their own.
    """
    counts = log_paths(log)
    special = F.coalesce((F.col("Source") == AD_GROUP.source) & F.col("fieldName").isin(*[s.name for s in ELEMENT_FIELDS]), F.lit(False))
    free = [F.col("path").startswith(f"{ELEMENT}.{side}") for side in SIDES]
    around = (F.col("path") == ELEMENT) & (F.col("type") == "OBJECT")
    named = (F.col("path") == f"{ELEMENT}.fieldName") & (F.col("type") == "STRING")
    open_ = around | named | (~special & (free[0] | free[1]))
    known = counts.sparkSession.createDataFrame(foreseen(), "fieldName string, path string, type string")
    closed = counts.where(~open_).withColumn("_name", F.when(special, F.col("fieldName")))
    return anti_nullsafe(
        closed, known.select(F.col("fieldName").alias("_name"), "path", "type"), ["_name", "path", "type"]
    ).drop("_name")
