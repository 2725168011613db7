"""Sorting, limits, sampling, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.operators.keyed import sum_by_key
from driftwell.operators.sampling import (
    POISSON_STEPS,
    poisson_thresholds,
    sample_with_replacement,
    split_side,
    stratified_downsample,
)
from driftwell.operators.sets import intersect, subtract_bag, union_all, union_distinct
from driftwell.queries.catalog import Tables, query

_SIDES = """
WITH a AS (SELECT nullif(o_custkey, 7) AS id FROM orders WHERE o_orderstatus = 'F'),
     b AS (SELECT nullif(c_custkey, 9) AS id FROM customer WHERE c_acctbal > 5000)
"""


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customer ids with repeats and a null on both sides."""
    buyers = t.orders.where("o_orderstatus = 'F'").select(F.nullif(F.col("o_custkey"), F.lit(7)).alias("id"))
    rich = t.customer.where("c_acctbal > 5000").select(F.nullif(F.col("c_custkey"), F.lit(9)).alias("id"))
    return buyers, rich


@query(_SIDES + "SELECT id FROM a UNION ALL SELECT id FROM b")
def set_union_all(t: Tables) -> DataFrame:
    return union_all(*_sides(t))


@query(_SIDES + "SELECT id FROM a UNION SELECT id FROM b")
def set_union_distinct(t: Tables) -> DataFrame:
    return union_distinct(*_sides(t))


@query(_SIDES + "SELECT id FROM a INTERSECT SELECT id FROM b")
def set_intersect(t: Tables) -> DataFrame:
    return intersect(*_sides(t))


@query(_SIDES + "SELECT id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id IS NOT DISTINCT FROM a.id)")
def set_subtract_bag(t: Tables) -> DataFrame:
    return subtract_bag(*_sides(t))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_total(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("""
SELECT * FROM (SELECT l_partkey, sum(l_quantity) AS total, 'last' AS side
               FROM lineitem GROUP BY 1 ORDER BY 1 DESC LIMIT 5)
UNION ALL
SELECT * FROM (SELECT l_partkey, sum(l_quantity) AS total, 'first' AS side
               FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 5)
""")
def kv_sort_topk(t: Tables) -> DataFrame:
    totals = sum_by_key(t.lineitem, "l_partkey", "l_quantity")
    first = totals.orderBy("l_partkey").limit(5).withColumn("side", F.lit("first"))
    return first.union(totals.orderBy(F.desc("l_partkey")).limit(5).withColumn("side", F.lit("last")))


def bucket_sql(column: str, salt: int = 0, buckets: int = 100) -> str:
    return f"(((({column} % 2147483647 + {salt}) % 2147483647) * 2654435761) % 4294967296) // 65536 % {buckets}"


_RATE, _SEED = 0.4, 17
_COPIES = " + ".join(
    f"CASE WHEN {bucket_sql('o_orderkey', _SEED, POISSON_STEPS)} >= {limit} THEN 1 ELSE 0 END" for limit in poisson_thresholds(_RATE)
)


@query(f"SELECT o_orderkey FROM (SELECT o_orderkey, unnest(range({_COPIES})) FROM orders)")
def sample_replace(t: Tables) -> DataFrame:
    return sample_with_replacement(t.orders.select("o_orderkey"), "o_orderkey", _RATE, _SEED)


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM orders WHERE o_orderstatus = 'P' OR {bucket_sql('o_orderkey')} < 15
""", name="stratified_downsample")
def stratified_orders(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", 1.0).otherwise(0.0).alias("label"))
    return stratified_downsample(rows, "label", "o_orderkey", {0.0: 15})


@query(f"""
SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey', 1000003)} < 70 THEN 'train' ELSE 'test' END AS side FROM orders
""", name="train_test_split")
def split_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", split_side("o_orderkey").alias("side"))
