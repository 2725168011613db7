"""Aggregation, distinct, keyed reduction, pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftwell.functions.numbers import safe_ratio
from driftwell.functions.text import jvm_split
from driftwell.operators import bitmaps, folds
from driftwell.operators.keyed import aggregate_by_key, count_by_key, sum_by_key, values_by_key, word_counts
from driftwell.operators.reshape import duplicate_profile, pivot_discovered, pivot_first
from driftwell.plans.auctions import expensive_auctions
from driftwell.plans.quality import distinct_ratio
from driftwell.queries.catalog import Tables, exact_mean_sql, query


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_count(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query(f"""
SELECT l_suppkey, min(l_extendedprice) AS min_bid, max(l_extendedprice) AS max_bid, {exact_mean_sql("l_extendedprice")} AS avg_bid
FROM lineitem GROUP BY 1
""")
def agg_min_max_avg(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.min(price).alias("min_bid"),
        F.max(price).alias("max_bid"),
        # as decimals, since the last digits of a mean of doubles depend on the order of addition
        F.avg(price.cast("decimal(18,2)")).cast("double").alias("avg_bid"),
    )


@query("SELECT count(*) AS n FROM lineitem")
def agg_global_count(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count("*").alias("n"))


@query("SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query("SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query("""
SELECT count(DISTINCT l_partkey) AS first_ids, count(DISTINCT l_orderkey) AS second_ids,
       CAST(count(DISTINCT l_partkey) AS DOUBLE) / nullif(CAST(count(DISTINCT l_orderkey) AS DOUBLE), 0) AS ratio
FROM lineitem WHERE l_quantity > 40
""", name="distinct_ratio")
def distinct_ratio_items(t: Tables) -> DataFrame:
    return distinct_ratio(t.lineitem, "l_partkey", "l_orderkey", F.col("l_quantity") > 40)


@query("""
SELECT DISTINCT l_orderkey AS "Auction Id", l_partkey AS item, l_extendedprice AS price FROM lineitem WHERE l_extendedprice > 75000
""")
def filter_gt_distinct(t: Tables) -> DataFrame:
    bids = t.lineitem.select(
        F.col("l_orderkey").alias("Auction Id"), F.col("l_partkey").alias("item"), F.col("l_extendedprice").alias("price")
    )
    return expensive_auctions(bids, 75000.0)


@query("""
SELECT o_custkey, min_by(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS "TF",
       min_by(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS "TO",
       min_by(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS "null"
FROM orders GROUP BY 1
""")
def pivot_agg(t: Tables) -> DataFrame:
    # the third status plays the null pivot value
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    labelled = t.orders.withColumn("p", F.concat(F.lit("T"), status))
    return pivot_first(labelled, ["o_custkey"], "p", "o_totalprice", "o_orderkey", ["TF", "TO", "null"])


_FOUND_SQL = ", ".join(
    f"min_by(value, event_id) FILTER (WHERE event_type = '{kind}') AS \"{kind}\"" for kind in ("click", "error", "purchase", "signup", "view")
)


@query(f"SELECT user_id, {_FOUND_SQL} FROM events GROUP BY 1")
def pivot_found(t: Tables) -> DataFrame:
    """The columns are those of the data: no value of the pivot column is named here."""
    return pivot_discovered(t.events, ["user_id"], "event_type", "value", "event_id")


@query("SELECT l_partkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def kv_sum(t: Tables) -> DataFrame:
    return sum_by_key(t.lineitem, "l_partkey", "l_quantity")


@query("""
SELECT l_partkey, sum(l_quantity) AS total, count(*) AS n, max(l_quantity) AS largest
FROM lineitem GROUP BY 1
""")
def kv_aggregate(t: Tables) -> DataFrame:
    return aggregate_by_key(
        t.lineitem.select("l_partkey", F.col("l_quantity").cast("string").alias("text"), "l_quantity"),
        "l_partkey",
        total=F.sum(F.col("text").cast("double")),
        n=F.count("*"),
        largest=F.max("l_quantity"),
    )


@query("""
SELECT o_custkey, CAST(0 AS BIGINT) AS part, CAST(1 AS BIGINT) AS parts, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS orders
FROM orders GROUP BY 1
""")
def kv_collect(t: Tables) -> DataFrame:
    lists = values_by_key(t.orders, "o_custkey", "o_orderkey", "o_orderkey")
    return lists.select("o_custkey", "part", "parts", F.concat_ws(",", F.col("values").cast("array<string>")).alias("orders"))


@query("SELECT o_custkey, o_orderkey FROM orders")
def kv_collect_parts(t: Tables) -> DataFrame:
    """Lists so short that most keys need several, taken apart again: no value may be missing."""
    lists = values_by_key(t.orders, "o_custkey", "o_orderkey", "o_orderkey", part_size=3)
    return lists.select("o_custkey", F.explode("values").alias("o_orderkey"))


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def kv_count(t: Tables) -> DataFrame:
    return count_by_key(t.lineitem, "l_suppkey")


@query("""
SELECT round(sum(o_totalprice), 2) AS total, count(*) AS n, round(sum(o_totalprice), 2) / count(*) AS mean FROM orders
""")
def agg_sum_count_mean(t: Tables) -> DataFrame:
    # rounded to the digits of the amounts, as those behind depend on the order of addition
    sums = t.orders.agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))
    return sums.withColumn("mean", safe_ratio(F.col("total"), F.col("n")))


@query("""
SELECT w AS word, count(*) AS n
FROM (SELECT unnest(CASE WHEN text = '' THEN [''] ELSE
               list_filter(string_split(regexp_replace(text, ' +$', ''), ' '), lambda x: regexp_replace(text, ' +$', '') <> '')
             END) AS w FROM documents)
GROUP BY 1
""")
def word_totals(t: Tables) -> DataFrame:
    return word_counts(t.documents, jvm_split(F.col("text"), " "))


@query("""
SELECT CAST(count(*) AS BIGINT) AS rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS distinct_rows
FROM lineitem
""")
def dup_profile(t: Tables) -> DataFrame:
    return duplicate_profile(t.lineitem)


# The smallest power of two with which the bins between least and greatest value suffice.
_HISTOGRAM_SQL = """
WITH given AS (SELECT {key} AS k, CAST(round({value} * 100) AS BIGINT) AS v FROM {table}),
     ranges AS (SELECT k, min(v) AS low, max(v) AS high FROM given GROUP BY k),
     fitted AS (SELECT k, min(width) AS width, any_value(low) AS low, any_value(high) AS high
                FROM ranges, (SELECT CAST(power(2, s) AS BIGINT) AS width FROM range(50) t(s))
                WHERE high // width - low // width < {bins} GROUP BY k),
     slots AS (SELECT k, width, low // width * width AS first, unnest(range(low // width, high // width + 1)) AS place FROM fitted),
     filled AS (SELECT s.k, s.width, s.first, s.place, count(g.v) AS n
                FROM slots s LEFT JOIN given g ON g.k = s.k AND g.v // s.width = s.place GROUP BY ALL)
SELECT {named} width, first, string_agg(n, ',' ORDER BY place) AS counts, CAST(sum(n) AS BIGINT) AS n FROM filled GROUP BY k, width, first
"""


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


@query(_HISTOGRAM_SQL.format(key="l_suppkey", value="l_extendedprice", table="lineitem", bins=16, named="k AS l_suppkey,"))
def kv_fold_histogram(t: Tables) -> DataFrame:
    """A state no built-in aggregate has: counts in at most 16 bins that widen as the values spread."""
    prices = t.lineitem.select("l_suppkey", _cents("l_extendedprice").alias("cents"))
    found = folds.fold_by_key(prices, ["l_suppkey"], ["cents"], folds.bounded_histogram(16))
    return found.withColumn("counts", F.concat_ws(",", F.col("counts").cast("array<string>")))


@query(_HISTOGRAM_SQL.format(key="0", value="o_totalprice", table="orders", bins=40, named=""))
def fold_histogram(t: Tables) -> DataFrame:
    """The same over all rows, without a key."""
    prices = t.orders.select(_cents("o_totalprice").alias("cents"))
    found = folds.fold_by_key(prices, [], ["cents"], folds.bounded_histogram(40))
    return found.withColumn("counts", F.concat_ws(",", F.col("counts").cast("array<string>")))


@query("SELECT l_partkey, CAST(sum(l_orderkey % 100) AS BIGINT) AS total, count(*) AS n FROM lineitem GROUP BY 1")
def kv_fold_each(t: Tables) -> DataFrame:
    """A zero, a function of state and value, and one that merges states; the values are text."""
    given = t.lineitem.select("l_partkey", (F.col("l_orderkey") % 100).cast("string").alias("text"))
    fold = folds.Fold(
        zero=lambda: (0, 0),
        seq=folds.each(lambda state, text: (state[0] + int(text), state[1] + 1)),
        comb=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda state: state,
        schema="total long, n long",
    )
    return folds.fold_by_key(given, ["l_partkey"], ["text"], fold)


@query("""
SELECT CAST(count(DISTINCT user_id) FILTER (event_type = 'purchase') AS BIGINT) AS first_ids, count(DISTINCT user_id) AS second_ids,
       CAST(count(DISTINCT user_id) FILTER (event_type = 'purchase') AS DOUBLE) / nullif(CAST(count(DISTINCT user_id) AS DOUBLE), 0) AS ratio
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'
""")
def distinct_over_days(t: Tables) -> DataFrame:
    """Buyers among the visitors of a week, from the bitmaps that each day has left."""
    path = t.scratch("day-bitmaps")
    events = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    buyer = F.when(F.col("event_type") == "purchase", F.col("user_id"))
    bitmaps.write_days(events, path, {"buyers": buyer, "visitors": F.col("user_id")}, "day")
    return bitmaps.distinct_ratio_between(bitmaps.stored_bitmaps(t.spark, path), "buyers", "visitors", "2024-01-03", "2024-01-09")


@query("SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS measure, count(DISTINCT user_id) AS n FROM events GROUP BY 1, 2")
def distinct_by_day(t: Tables) -> DataFrame:
    """Distinct visitors of each day and kind of event, counted in one pass as bitmaps."""
    events = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    kinds = ("click", "error", "purchase", "signup", "view")
    measures = {kind: F.when(F.col("event_type") == kind, F.col("user_id")) for kind in kinds}
    found = bitmaps.id_bitmaps(events, measures, "day")
    return found.groupBy("dt", "measure").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
