"""Projection, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.functions.numbers import percent, safe_ratio
from driftwell.functions.text import jvm_split
from driftwell.functions.time import days_before, epoch_ms_to_day
from driftwell.operators.partitions import first_per_partition, first_rows, id_range, laid_out, tag_partition, tag_rows
from driftwell.operators.reshape import fill_null
from driftwell.plans.match_rate import actions_for_url
from driftwell.plans.quality import over_long
from driftwell.queries.catalog import Tables, query
from driftwell.sources.readers import day_slice, json_rows


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def project(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "SELECT s_suppkey AS supplier_id, s_name AS supplier, s_nationkey AS nation_id, s_acctbal AS balance FROM supplier"
)
def rename(t: Tables) -> DataFrame:
    return t.supplier.toDF("supplier_id", "supplier", "nation_id", "balance")


@query("SELECT l_orderkey, l_linenumber, l_quantity AS x, l_tax AS y, l_linenumber AS kind FROM lineitem")
def json_nested_path(t: Tables) -> DataFrame:
    fence = F.struct(
        F.struct(F.col("l_quantity").alias("x"), F.col("l_tax").alias("y")).alias("coordinates"),
        F.col("l_linenumber").alias("geoFenceTypeId"),
    )
    texts = t.lineitem.select("l_orderkey", "l_linenumber", F.to_json(fence).alias("fence"))
    parsed = json_rows(texts, "fence", "coordinates struct<x:double, y:double>, geoFenceTypeId int")
    return parsed.select(
        "l_orderkey",
        "l_linenumber",
        F.col("record.coordinates.x").alias("x"),
        F.col("record").getField("coordinates").getField("y").alias("y"),
        F.col("record.geoFenceTypeId").alias("kind"),
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_envelope(t: Tables) -> DataFrame:
    return json_rows(t.events, "props", "k int").select("event_id", F.col("record.k").alias("k"))


@query("""
SELECT event_id,
       '{"Id":' || event_id || ',"Details":{"kind":"' || event_type || '","user":' || user_id || '}}' AS envelope
FROM events
""")
def to_json_envelope(t: Tables) -> DataFrame:
    details = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user"))
    envelope = F.to_json(F.struct(F.col("event_id").alias("Id"), details.alias("Details")))
    return t.events.select("event_id", envelope.alias("envelope"))


@query("SELECT event_id, 'T' || nullif(event_type, 'view') AS p FROM events")
def concat_lit(t: Tables) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    return t.events.withColumn("p", F.concat(F.lit("T"), kind)).select("event_id", "p")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'X' WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'Z' END AS code
FROM orders
""")
def case_when(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select("o_orderkey", F.when(status == "F", "X").when(status == "O", "Y").otherwise("Z").alias("code"))


@query("SELECT event_id, coalesce(nullif(event_type, 'view'), 'N/A') AS kind, nullif(event_type, 'click') AS other FROM events")
def na_fill(t: Tables) -> DataFrame:
    frame = t.events.select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("view")).alias("kind"),
        F.nullif(F.col("event_type"), F.lit("click")).alias("other"),
    )
    return fill_null(frame, "N/A", ["kind", "not_in_this_frame"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_eq(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_totalprice")


@query("SELECT event_id FROM events WHERE nullif(event_type, 'view') <> 'click'")
def filter_ne(t: Tables) -> DataFrame:
    return t.events.where(F.nullif(F.col("event_type"), F.lit("view")) != "click").select("event_id")


@query("SELECT event_id, user_id FROM events WHERE nullif(event_type, 'view') IS NOT NULL")
def filter_notnull(t: Tables) -> DataFrame:
    return t.events.where(F.nullif(F.col("event_type"), F.lit("view")).isNotNull()).select("event_id", "user_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def filter_and(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") == "F").where(F.col("o_totalprice") > 100000).select("o_orderkey")


@query("SELECT page_id, url, CAST(length(url) AS BIGINT) AS n FROM pages WHERE length(url) > 40")
def filter_strlen(t: Tables) -> DataFrame:
    return over_long(t.pages, "url", 40).select("page_id", "url", F.length("url").cast("bigint").alias("n"))


@query("SELECT page_id AS idaction FROM pages WHERE instr(url, 'example.com') > 0")
def filter_instr(t: Tables) -> DataFrame:
    actions = t.pages.select(F.col("page_id").alias("idaction"), F.col("url").alias("name"))
    return actions_for_url(t.spark, actions, "example.com")


@query("SELECT doc_id, lang FROM documents WHERE contains(text, 'tion') AND NOT contains(text, 'http')")
def filter_contains(t: Tables) -> DataFrame:
    text = F.col("text")
    return t.documents.where(text.contains("tion") & ~text.contains("http")).select("doc_id", "lang")


@query("""
SELECT conv_id, turn FROM conversations
WHERE list_contains(CASE WHEN text = '' THEN [''] ELSE
        list_filter(string_split(regexp_replace(text, ' +$', ''), ' '), lambda x: regexp_replace(text, ' +$', '') <> '')
      END, 'the')
""")
def filter_array_contains(t: Tables) -> DataFrame:
    # element equality, not a substring
    return t.conversations.where(F.array_contains(jvm_split(F.col("text"), " "), "the")).select("conv_id", "turn")


@query("""
SELECT conv_id, turn, CAST(len(w) AS BIGINT) AS pieces, w[1] AS first_piece, w[len(w)] AS last_piece
FROM (SELECT conv_id, turn,
             CASE WHEN text = '' THEN [''] ELSE
               list_filter(string_split(regexp_replace(text, ' +$', ''), ' '), lambda x: regexp_replace(text, ' +$', '') <> '')
             END AS w
      FROM conversations)
""")
def str_split(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", jvm_split(F.col("text"), " ").alias("w")).select(
        "conv_id",
        "turn",
        F.size("w").cast("bigint").alias("pieces"),
        F.get("w", F.lit(0)).alias("first_piece"),
        F.try_element_at("w", F.lit(-1)).alias("last_piece"),
    )


@query("""
SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS whole,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number
FROM orders
""")
def cast_try(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("bigint").alias("whole"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_tax / nullif(l_discount, 0) AS ratio, (l_tax / nullif(l_discount, 0)) * 100.0::DOUBLE AS pct,
       l_linenumber - 1 AS zero_based
FROM lineitem
""")
def ratio_pct(t: Tables) -> DataFrame:
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        safe_ratio(tax, discount).alias("ratio"),
        percent(tax, discount).alias("pct"),
        (F.col("l_linenumber") - 1).alias("zero_based"),
    )


@query("""
SELECT c_custkey, c_custkey || ',' || c_custkey || ',' || c_custkey AS thrice, c_custkey * c_custkey AS squared
FROM customer
""")
def map_expr(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.concat_ws(",", F.array_repeat(key.cast("string"), 3)).alias("thrice"), (key * key).alias("squared")
    )


@query("SELECT c_custkey FROM customer, (VALUES (1), (2), (3)) r(i)")
def flatmap_explode(t: Tables) -> DataFrame:
    return t.customer.select(F.explode(F.array_repeat(F.col("c_custkey"), 3)).alias("c_custkey"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
""")
def epoch_to_day(t: Tables) -> DataFrame:
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return t.events.select("event_id", epoch_ms_to_day(millis).alias("day"))


@query("""
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
       strftime(o_orderdate - INTERVAL 2 DAY, '%Y-%m-%d') AS two_before
FROM orders
""")
def date_shift(t: Tables) -> DataFrame:
    run_date = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        "o_orderkey",
        F.date_format(days_before(run_date), "yyyy-MM-dd").alias("day_before"),
        F.date_format(days_before(run_date, 2), "yyyy-MM-dd").alias("two_before"),
    )


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-04' - INTERVAL 1 DAY
""")
def prev_day_slice(t: Tables) -> DataFrame:
    days = t.orders.withColumn("dt", F.to_date("o_orderdate"))
    return day_slice(days, "1998-10-04").select("o_orderkey", "o_totalprice")


_PARTITIONS = 4


def _ids(t: Tables) -> DataFrame:
    """All ids up to the largest order key; the one value fetched is that key."""
    largest = t.orders.agg(F.max("o_orderkey")).first()[0]
    return id_range(t.spark, 0, (-1 if largest is None else largest) + 1, partitions=_PARTITIONS)


# A partition begins where its share of the ids does.
_STARTS = f"""
WITH size AS (SELECT coalesce(max(o_orderkey), -1) + 1 AS n FROM orders),
     starts AS (SELECT CAST(i AS INTEGER) AS partition, i * n // {_PARTITIONS} AS first, (i + 1) * n // {_PARTITIONS} AS past
                FROM size, range({_PARTITIONS}) r(i))
"""


@query(_STARTS + "SELECT unnest(range(first, past)) AS id FROM starts")
def src_range(t: Tables) -> DataFrame:
    return _ids(t)


@query(_STARTS + "SELECT partition, first FROM starts WHERE first < past")
def per_partition_first(t: Tables) -> DataFrame:
    return first_per_partition(_ids(t), "id")


@query(_STARTS + "SELECT partition || '|' || unnest(range(first, past)) AS tagged FROM starts")
def partition_tag(t: Tables) -> DataFrame:
    return tag_partition(_ids(t), "id")


@query(f"""
SELECT CAST(o_orderkey % {_PARTITIONS} AS INTEGER) AS partition, min_by(o_orderkey, o_totalprice * 1000000000 + o_orderkey) AS o_orderkey,
       min_by(o_custkey, o_totalprice * 1000000000 + o_orderkey) AS o_custkey
FROM orders GROUP BY 1
""")
def partition_first_row(t: Tables) -> DataFrame:
    """The first row of each partition by its iterator, over given rows in a fixed layout."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    placed = laid_out(rows, F.col("o_orderkey") % _PARTITIONS, _PARTITIONS, ["o_totalprice", "o_orderkey"])
    return first_rows(placed).select("partition", "o_orderkey", "o_custkey")


@query(f"SELECT (o_orderkey % {_PARTITIONS}) || '|' || o_custkey AS tagged FROM orders")
def partition_index_rows(t: Tables) -> DataFrame:
    """Every row with its partition's number, as it passes through the iterator."""
    rows = t.orders.select("o_orderkey", "o_custkey")
    return tag_rows(laid_out(rows, F.col("o_orderkey") % _PARTITIONS, _PARTITIONS, ["o_orderkey"]), "o_custkey")
