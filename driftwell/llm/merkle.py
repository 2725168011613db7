"""Merkle manifest of a dataset: one tree per group, one over the groups' roots.

A leaf is the SHA-256 of the fields of a row; every ``ARITY`` consecutive nodes of a level become
one node of the next, the last run being as short as it is, until one node is left.  Per level,
fixed-offset lag and lead columns, masked by the node's slot and its run's length, bring a node's
siblings into its row; the row of a run's first child then hashes the parent.  Windows hold one run
each, so no group, however large, meets in one task; places in a group come from row numbers counted
in slices of the order.

Siblings go down the tree, not up from the leaves: a node's siblings are joined to its children's as
one row for each run, and a leaf's window and the join with its parent's path share one shuffle.

Defined cases: a null field is ``-``, so null and empty text differ; null ids come first in their
group, rows that share an id follow by leaf, and equal rows are leaves of their own.  A null group
comes before all others.  A row without an id is never altered by ``tampered``.  A lone row is its
group's root, a lone group's root is the root; an empty table gives no rows.  The input's other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from driftwell.llm.common import staged
from driftwell.operators.windows import row_number

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*[encoded(f) for f in fields])


def every_third(doc_id: Column) -> Column:
    """True where 3 divides the crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def _slices(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _placed(nodes: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``nodes`` with ``idx``, the place in the group ``g`` from 0, and ``n``, the group's size."""
    numbered = row_number(nodes, ["g"], order, "idx", slices=_slices(nodes)).withColumn("idx", F.col("idx") - 1)
    # Written first, so that Spark knows how small it is before it plans the join.
    sizes = staged(nodes.groupBy("g").agg(F.count("*").alias("n")), f"{label}-sizes")
    return staged(numbered.join(sizes, "g"), f"{label}-0")


def _with_siblings(level: DataFrame, arity: int) -> DataFrame:
    """``left`` and ``right``: digests of the run's other nodes, concatenated in order."""
    run = Window.partitionBy("g", "run").orderBy("idx")
    slot = F.col("idx") % arity
    length = F.least(F.lit(arity), F.col("n") - F.col("run") * arity)
    before = [F.when(slot >= k, F.lag("digest", k).over(run)).otherwise("") for k in range(arity - 1, 0, -1)]
    behind = [F.when(slot + k < length, F.lead("digest", k).over(run)).otherwise("") for k in range(1, arity)]
    placed = level.withColumn("run", F.expr(f"idx div {arity}"))
    return placed.withColumns({"left": F.concat(*before), "right": F.concat(*behind)})


def _levels(nodes: DataFrame, label: str, arity: int) -> list[DataFrame]:
    """All levels ``g, idx, n, digest``, the leaves first; groups that have come to one node stop."""
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        first_children = _with_siblings(levels[-1], arity).where((F.col("n") > 1) & (F.col("idx") % arity == 0))
        parents = first_children.select(
            "g",
            F.col("run").alias("idx"),
            F.ceil(F.col("n") / arity).cast("long").alias("n"),
            digest(F.col("digest"), F.col("right")).alias("digest"),
        )
        levels.append(staged(parents, f"{label}-{len(levels)}"))
        most = -(-most // arity)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``g, digest`` of the node that is left of each group."""
    found = levels[0].select("g", "n", "digest")
    for level in levels[1:]:
        found = found.unionByName(level.select("g", "n", "digest"))
    return found.where("n = 1").drop("n")


def _with_paths(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The leaves with ``path``, the siblings of each level up to the root, and ``top``.

    ``tops`` has ``g, path, top`` for each group: what lies above the group's own tree.
    """
    above: DataFrame | None = None
    for level in reversed(levels):
        own = level.columns
        ended = level.where("n = 1").join(tops, "g").select(*own, "path", "top")
        if above is None:
            found = ended
        else:
            siblings = F.array(F.struct("left", "right"))
            climbing = (
                _with_siblings(level.where("n > 1"), arity)
                .join(above.select("g", F.col("idx").alias("run"), "path", "top"), ["g", "run"])
                .select(*own, F.concat(siblings, F.col("path")).alias("path"), "top")
            )
            found = ended.unionByName(climbing)
        above = found
    return above


def _folded(start: Column, path: Column) -> Column:
    return F.aggregate(path, start, lambda found, step: digest(step["left"], found, step["right"]))


def merkle_manifest(
    rows: DataFrame,
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    text_col: str = "text",
    fields: Sequence[str] = FIELDS,
    arity: int = ARITY,
    tampered: bool = True,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, path, proof_sha256, folded_root, verified`` of every row.

    ``path`` lists the siblings left and right of the node at each level, from the leaf to the root.
    With ``tampered`` every third row, by a hash of its id, has A-Z in its text lower-cased before
    its leaf is folded up along the path; ``verified`` tells whether the root comes out.
    """
    columns = [F.col(f"`{c}`") for c in fields]
    altered = [lower_ascii(F.col(f"`{c}`")) if c == text_col else F.col(f"`{c}`") for c in fields]
    doc_id, group = F.col(f"`{id_col}`"), F.col(f"`{group_col}`").cast("string")
    changed = every_third(doc_id) if tampered else F.lit(False)
    described = rows.select(
        doc_id.alias("doc_id"),
        # Never null, and in the order asked for: a null group first, then by bytes.
        F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("g"),
        leaf(columns).alias("digest"),
        F.when(changed, leaf(altered)).alias("altered"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = staged(described, "merkle-leaves")
    if leaves.isEmpty():
        return rows.sparkSession.createDataFrame(
            [],
            f"doc_id {leaves.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, "
            "path array<struct<left:string,right:string>>, proof_sha256 string, folded_root string, verified boolean",
        )
    levels = _levels(_placed(leaves, ["doc_id", "digest", "row"], "merkle-leaf"), "merkle-leaf", arity)

    subroots = staged(_tops(levels), "merkle-subroots")
    named = subroots.select(F.lit("").alias("g"), F.col("g").alias("group"), "digest")
    upper = _levels(_placed(named, ["group"], "merkle-root"), "merkle-root", arity)
    root = _tops(upper).first()["digest"]
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    summit = _tops(upper).select("g", nothing.alias("path"), F.col("digest").alias("top"))
    of_groups = _with_paths(upper, summit, arity).select(F.col("group").alias("g"), "path", F.col("digest").alias("top"))
    found = _with_paths(levels, staged(of_groups, "merkle-group-paths"), arity)

    siblings = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        F.lit(root).alias("root"),
        "path",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        _folded(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
