"""Window functions, each in the ordinary form and in the sliced form for hot groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.operators import windows
from driftwell.queries.catalog import Tables, query

_SLICES = 16

_ROW_NUMBER = """
SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rnum FROM customer
"""
_RANK = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
       {function}() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank FROM lineitem
"""
_RUNNING = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS DOUBLE)
         AS running_total
FROM lineitem
"""
_NEIGHBOUR = """
SELECT o_orderkey, o_orderpriority, {function}(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey)
  AS neighbour FROM orders
"""
_EDGE = """
SELECT o_orderkey, o_orderpriority, {function}(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS edge FROM orders
"""


def _customers(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_nationkey")


def _items(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


def _priced(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")


def _running(t: Tables, slices: int | None) -> DataFrame:
    totals = windows.running_sum(_priced(t), ["l_suppkey"], ["l_quantity"], "price", "total", slices=slices)
    return totals.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.col("total").cast("double").alias("running_total")
    )


@query(_ROW_NUMBER)
def win_row_number(t: Tables) -> DataFrame:
    return windows.row_number(_customers(t), ["c_nationkey"], ["c_custkey"], "rnum")


@query(_ROW_NUMBER)
def win_row_number_sliced(t: Tables) -> DataFrame:
    return windows.row_number(_customers(t), ["c_nationkey"], ["c_custkey"], "rnum", slices=_SLICES)


@query(_RANK.format(function="rank"))
def win_rank(t: Tables) -> DataFrame:
    return windows.rank(_items(t), ["l_suppkey"], ["-l_quantity"], "rank")


@query(_RANK.format(function="rank"))
def win_rank_sliced(t: Tables) -> DataFrame:
    return windows.rank(_items(t), ["l_suppkey"], ["-l_quantity"], "rank", slices=_SLICES)


@query(_RANK.format(function="dense_rank"))
def win_dense_rank(t: Tables) -> DataFrame:
    return windows.dense_rank(_items(t), ["l_suppkey"], ["-l_quantity"], "rank")


@query(_RANK.format(function="dense_rank"))
def win_dense_rank_sliced(t: Tables) -> DataFrame:
    return windows.dense_rank(_items(t), ["l_suppkey"], ["-l_quantity"], "rank", slices=_SLICES)


@query(_RUNNING)
def win_running_sum(t: Tables) -> DataFrame:
    return _running(t, None)


@query(_RUNNING)
def win_running_sum_sliced(t: Tables) -> DataFrame:
    return _running(t, _SLICES)


@query(_NEIGHBOUR.format(function="lead"))
def win_lead(t: Tables) -> DataFrame:
    return windows.lead(
        _orders(t), ["o_orderpriority"], ["o_totalprice", "o_orderkey"], "o_totalprice", "neighbour"
    ).drop("o_totalprice")


@query(_NEIGHBOUR.format(function="lead"))
def win_lead_sliced(t: Tables) -> DataFrame:
    return windows.lead(
        _orders(t), ["o_orderpriority"], ["o_totalprice", "o_orderkey"], "o_totalprice", "neighbour", slices=_SLICES
    ).drop("o_totalprice")


@query(_NEIGHBOUR.format(function="lag"))
def win_lag(t: Tables) -> DataFrame:
    return windows.lag(
        _orders(t), ["o_orderpriority"], ["o_totalprice", "o_orderkey"], "o_totalprice", "neighbour"
    ).drop("o_totalprice")


@query(_NEIGHBOUR.format(function="lag"))
def win_lag_sliced(t: Tables) -> DataFrame:
    return windows.lag(
        _orders(t), ["o_orderpriority"], ["o_totalprice", "o_orderkey"], "o_totalprice", "neighbour", slices=_SLICES
    ).drop("o_totalprice")


@query(_EDGE.format(function="first_value"))
def win_first_value(t: Tables) -> DataFrame:
    return windows.first_value(
        _orders(t), ["o_orderpriority"], ["o_totalprice", "o_orderkey"], "o_totalprice", "edge"
    ).drop("o_totalprice")


@query(_EDGE.format(function="last_value"))
def win_last_value(t: Tables) -> DataFrame:
    return windows.last_value(
        _orders(t), ["o_orderpriority"], ["o_totalprice", "o_orderkey"], "o_totalprice", "edge"
    ).drop("o_totalprice")
