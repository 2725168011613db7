"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.operators.joins import anti_nullsafe, count_back, greatest_per_group, join_pairs, star_join
from driftwell.operators.reshape import eav_to_wide
from driftwell.queries.catalog import Tables, query


@query("""
SELECT o_orderkey, o_custkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_inner_using(t: Tables) -> DataFrame:
    items = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return t.orders.select("o_orderkey", "o_custkey").join(items, "o_orderkey")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner_cond(t: Tables) -> DataFrame:
    customer, nation = t.customer, t.nation
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select("c_custkey", "n_name")


@query("""
SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment IS NOT NULL AND c.c_mktsegment <> ''
""")
def join_sql(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("t2")
    t.customer.createOrReplaceTempView("t1")
    return t.spark.sql("""
        SELECT t2.o_orderkey, t1.c_name, t1.c_mktsegment
        FROM t2 JOIN t1 ON t2.o_custkey = t1.c_custkey
        WHERE t1.c_mktsegment IS NOT NULL AND t1.c_mktsegment <> ''
    """)


@query("""
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey
""")
def join_left(t: Tables) -> DataFrame:
    large = t.orders.where("o_totalprice > 400000").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(large, "c_custkey", "left")


@query("""
SELECT o_orderkey, c_name FROM (SELECT * FROM customer WHERE c_acctbal > 0) RIGHT JOIN orders ON c_custkey = o_custkey
""")
def join_right(t: Tables) -> DataFrame:
    solvent = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return solvent.join(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "right").select("o_orderkey", "c_name")


@query("""
SELECT s_nationkey AS k, s_suppkey AS v, n_name AS w FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def join_kv(t: Tables) -> DataFrame:
    return join_pairs(t.supplier.select("s_nationkey", "s_suppkey"), t.nation.select("n_nationkey", "n_name"))


@query("""
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def join_star3(t: Tables) -> DataFrame:
    fact = t.orders.select("o_orderkey", "o_custkey")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return star_join(fact, (customers, "o_custkey"), (nations, "c_nationkey")).select("o_orderkey", "c_name", "n_name")


# A part as (entity, field, value, position): economy parts lack the type, the brand is
# present but null for Brand#1, and the name is given twice.
@query("""
SELECT p_partkey AS id, upper(p_name) AS name, nullif(p_brand, 'Brand#1') AS brand, p_type AS type
FROM part WHERE p_type <> 'ECONOMY'
""", name="eav_to_wide")
def eav_to_wide_parts(t: Tables) -> DataFrame:
    def entry(name: str, value, position: int):
        return F.struct(F.lit(name).alias("field"), value.alias("value"), F.lit(position).alias("position"))

    entries = F.array(
        entry("name", F.col("p_name"), 0),
        entry("brand", F.nullif(F.col("p_brand"), F.lit("Brand#1")), 1),
        entry("type", F.col("p_type"), 2),
        entry("name", F.upper("p_name"), 3),
    )
    long = t.part.select(F.col("p_partkey").alias("id"), F.explode(entries).alias("e")).select("id", "e.*")
    given = long.where((F.col("field") != "type") | (F.col("value") != "ECONOMY"))
    return eav_to_wide(given, "id", "field", "value", "position", ["name", "brand", "type"])


@query("""
SELECT l_suppkey, l_quantity, l_orderkey, l_linenumber
FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS r FROM lineitem) WHERE r = 1
""", name="greatest_per_group")
def greatest_rows(t: Tables) -> DataFrame:
    items = t.lineitem.select("l_suppkey", "l_quantity", "l_orderkey", "l_linenumber")
    return greatest_per_group(items, "l_suppkey", "l_quantity")


@query("""
SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n
FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL
""")
def count_back_join(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))
    return count_back(rows, "o_orderpriority", "n").select("o_orderkey", "o_orderpriority", "n")


@query("""
SELECT v.user_id FROM (SELECT nullif(user_id, 7) AS user_id FROM events) v
WHERE NOT EXISTS (SELECT 1 FROM (SELECT nullif(c_custkey, 9) AS c FROM customer WHERE c_acctbal > 5000) k
                  WHERE k.c IS NOT DISTINCT FROM v.user_id)
""", name="anti_nullsafe")
def anti_nullsafe_visitors(t: Tables) -> DataFrame:
    visitors = t.events.select(F.nullif(F.col("user_id"), F.lit(7)).alias("user_id"))
    known = t.customer.where("c_acctbal > 5000").select(F.nullif(F.col("c_custkey"), F.lit(9)).alias("user_id"))
    return anti_nullsafe(visitors, known, ["user_id"])
