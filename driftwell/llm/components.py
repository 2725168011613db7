"""Connected components of a graph held in a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.llm.common import staged
from driftwell.operators.joins import join_aggregate


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges with ``m``, the least node next to ``u``; a hot node's edges can be split in the join."""
    return join_aggregate(edges, edges.groupBy("u").agg(F.min("v").alias("m")), ["u"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reached) of every node of ``edges`` ``a, b``.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the least
    node it sees, until nothing moves; the number of rounds grows with the logarithm of the longest
    path.  Each round is written to the shared folder, nothing but two numbers reaches the driver.
    Loops are allowed; an empty frame gives an empty one.
    """
    current = staged(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = _state(current)
    while True:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = staged(large.distinct(), "large-star")
        found = _with_least(large)
        small = found.select("u", F.col("m").alias("v")).unionAll(
            found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = staged(small.distinct(), "small-star")
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
