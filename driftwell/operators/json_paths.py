"""What is inside JSON documents of mixed shape: paths, types and how often each occurs.

Documents are parsed once into variants, and every value in them is one row of a chain of
generators: no level is a job of its own, nothing is inferred on the driver, and only counts per
(keys, path, type) are shuffled, combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Values below this many levels are not taken apart: their whole schema stands for their type.
DEPTH = 8
ROOT = "$"


def _step(key: Column) -> Column:
    """``.key``, quoted unless it is plain, or ``[]`` for an element of an array."""
    plain = key.rlike("^[A-Za-z0-9_]+$")
    quoted = F.concat(F.lit('."'), key, F.lit('"'))
    return F.when(key.isNull(), "[]").when(plain, F.concat(F.lit("."), key)).otherwise(quoted)


def _kind(schema: Column) -> Column:
    """``OBJECT<a: BIGINT>`` as ``OBJECT``, ``DECIMAL(3,1)`` as ``DECIMAL``."""
    return F.regexp_extract(schema, "^[A-Z_ ]+", 0)


def path_counts(
    frame: DataFrame,
    variant: str,
    keys: Sequence[str] = (),
    *,
    root: str | Column = ROOT,
    depth: int = DEPTH,
    skip: Sequence[str] = (),
) -> DataFrame:
    """``keys..., path, type, n``: how often each path of a variant column holds a value of each type.

    Paths read ``$.a.b[].c``; ``root`` is the path of the variant itself.  Types are those of
    ``schema_of_variant`` without parameters: ``OBJECT``, ``ARRAY``, ``BIGINT``, ``DECIMAL``,
    ``VOID`` for JSON's null and so on.  Elements of arrays at the paths in ``skip`` are not counted,
    and a value ``depth`` levels down is counted with its whole schema as its type.  Rows whose variant
    is null are left out; an object's key may be empty.
    """
    root_path = F.lit(root) if isinstance(root, str) else root
    names = [f"_k{i}" for i in range(len(keys))]
    rows = frame.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], root_path.alias("_path0"), F.col(f"`{variant}`").alias("_v0")
    ).where("_v0 IS NOT NULL")
    rows = rows.select("*", F.lit(0).alias("_pos0"), F.lit(None).cast("string").alias("_key0"))
    explode = frame.sparkSession.tvf.variant_explode_outer
    for i in range(depth):
        open_ = F.col(f"_v{i}")
        if skip:
            closed = F.col(f"_path{i}").isin(*skip) & F.schema_of_variant(f"_v{i}").startswith("ARRAY")
            open_ = F.when(~F.coalesce(closed, F.lit(False)), open_)
        rows = rows.withColumn(f"_open{i}", open_)
        below = explode(F.col(f"_open{i}").outer()).toDF(f"_pos{i + 1}", f"_key{i + 1}", f"_v{i + 1}")
        rows = rows.lateralJoin(below).drop(f"_open{i}")
        path = F.concat(F.col(f"_path{i}"), _step(F.col(f"_key{i + 1}")))
        rows = rows.withColumn(f"_path{i + 1}", F.when(F.col(f"_pos{i + 1}").isNotNull(), path))

    # A value stands in the row of each value below it; it is counted in the first of them.
    found = []
    for i in range(depth + 1):
        first = [F.coalesce(F.col(f"_pos{j}"), F.lit(0)) == 0 for j in range(i + 1, depth + 1)]
        counted = reduce(lambda a, b: a & b, [F.col(f"_pos{i}").isNotNull(), *first])
        if i < depth:
            with_children = F.when(F.col(f"_key{i + 1}").isNull(), "ARRAY").otherwise("OBJECT")
            kind = F.when(F.col(f"_pos{i + 1}").isNotNull(), with_children).otherwise(_kind(F.schema_of_variant(f"_v{i}")))
        else:
            kind = F.schema_of_variant(f"_v{i}")
        found.append(F.when(counted, F.struct(F.col(f"_path{i}").alias("path"), kind.alias("type"))))
    values = rows.select(*names, F.explode(F.array_compact(F.array(*found))).alias("_found"))
    counts = values.groupBy(*names, "_found.path", "_found.type").agg(F.count("*").alias("n"))
    return counts.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "path", "type", "n")


def merged_schemas(frame: DataFrame, variant: str, keys: Sequence[str]) -> DataFrame:
    """``keys..., schema, n``: one schema that all variants of a key fit, ``VARIANT`` where they differ.

    The schemas are merged map-side, so a hot key costs one schema a task.
    """
    return frame.groupBy(*keys).agg(F.schema_of_variant_agg(variant).alias("schema"), F.count(variant).alias("n"))
