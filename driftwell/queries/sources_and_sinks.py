"""Sources and sinks: the tables are written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftwell.functions.text import jvm_split
from driftwell.queries.catalog import Tables, query
from driftwell.sources.readers import csv_text_rows, long_cells, read_delimited, read_ordinal, wide_cells
from driftwell.sources.writers import append_table, write_days, write_lines, write_report, write_snapshot
from driftwell.streaming.word_count import (
    file_lines,
    file_lines_with_origin,
    read_batches,
    read_manifest,
    read_timed_batches,
    start_timed_word_count,
    start_word_count,
)

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(_ORDERS_SQL)
def src_csv_schema(t: Tables) -> DataFrame:
    path = t.scratch("csv-schema")
    write_report(_orders(t), path, sep="|", header=False, few_files=False)
    return read_delimited(t.spark, path, _ORDERS)


@query("""
SELECT p_partkey AS "Id", p_name AS "Name", nullif(p_type, 'ECONOMY') AS "Kind" FROM part
""")
def src_csv_nulltoken(t: Tables) -> DataFrame:
    path = t.scratch("csv-null")
    kind = F.coalesce(F.nullif(F.col("p_type"), F.lit("ECONOMY")), F.lit("null"))
    write_report(t.part.select("p_partkey", "p_name", kind.alias("kind")), path, sep="|", header=False, few_files=False)
    return read_delimited(t.spark, path, "Id bigint, Name string, Kind string", null_token="null")


@query("""
SELECT CAST(c_custkey AS INTEGER) AS id, c_mktsegment AS segment, c_acctbal AS balance FROM customer
""")
def src_csv_ordinal(t: Tables) -> DataFrame:
    path = t.scratch("csv-ordinal")
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    write_report(customers, path, sep="|", header=False, few_files=False)
    picked = read_ordinal(t.spark, path, {0: "id", 4: "segment", 3: "balance"})
    # inference picks the narrowest integer type the values need
    return picked.withColumn("id", F.col("id").cast("int"))


@query(_ORDERS_SQL)
def src_csv_header(t: Tables) -> DataFrame:
    path = t.scratch("csv-header")
    write_report(_orders(t), path, compression="gzip", few_files=False)
    return read_delimited(t.spark, path, _ORDERS, sep=",", header=True)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def src_csv_header_strings(t: Tables) -> DataFrame:
    path = t.scratch("csv-strings")
    write_report(_orders(t).drop("o_totalprice"), path, few_files=False)
    return read_delimited(t.spark, path, sep=",", header=True)


@query(_ORDERS_SQL)
def src_csv_header_inferred(t: Tables) -> DataFrame:
    path = t.scratch("csv-inferred")
    write_report(_orders(t), path, few_files=False)
    inferred = read_delimited(t.spark, path, sep=",", header=True, infer=True)
    # inference picks the narrowest integer type the values need
    return inferred.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query("SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity >= 49")
def src_parquet(t: Tables) -> DataFrame:
    return t.lineitem.where("l_quantity >= 49").select("l_orderkey", "l_extendedprice")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def src_table_sql(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("user_table")
    return t.spark.sql("SELECT c_custkey, c_name, c_acctbal FROM user_table WHERE c_acctbal < 0")


@query("SELECT l_orderkey, l_returnflag AS flag, l_quantity AS quantity, 4::BIGINT AS pieces FROM lineitem")
def src_text_split(t: Tables) -> DataFrame:
    path = t.scratch("text-split")
    write_lines(t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity"), path, sep=",")
    parts = t.spark.read.text(path).select(jvm_split(F.col("value"), ",").alias("p"))
    return parts.select(
        F.get("p", F.lit(0)).cast("bigint").alias("l_orderkey"),
        F.get("p", F.lit(2)).alias("flag"),
        F.get("p", F.lit(3)).cast("double").alias("quantity"),
        F.size("p").cast("bigint").alias("pieces"),
    )


@query("""
SELECT o_orderkey, meaning FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) s(code, meaning) ON o_orderstatus = code
""")
def src_inline(t: Tables) -> DataFrame:
    meanings = t.spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "pending")], "o_orderstatus string, meaning string")
    return t.orders.join(meanings, "o_orderstatus").select("o_orderkey", "meaning")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS mvid, nullif(c_mktsegment, 'BUILDING') AS tdid, CAST(NULL AS VARCHAR) AS bmid FROM customer
""")
def src_wide_cells(t: Tables) -> DataFrame:
    wide = t.customer.select(
        F.col("c_custkey").alias("inf/mv/userid"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("inf/200/userid"),
        F.col("c_acctbal").alias("inf/other"),
    )
    return wide_cells(wide, {"inf/mv/userid": "mvid", "inf/200/userid": "tdid", "inf/300/userid": "bmid"})


@query("""
SELECT c_custkey, c_name AS mvid, nullif(c_mktsegment, 'BUILDING') AS tdid FROM customer
""")
def src_long_cells(t: Tables) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    cells = t.customer.withColumn("segment", segment).unpivot("c_custkey", ["c_name", "segment"], "qualifier", "value")
    return long_cells(cells, "c_custkey", "qualifier", "value", {"c_name": "mvid", "segment": "tdid"})


@query("""
SELECT o_orderkey AS id, 'status' AS field, o_orderstatus AS value FROM orders
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders
""", name="csv_text_rows")
def csv_texts(t: Tables) -> DataFrame:
    text = F.concat_ws(
        "\n",
        F.lit("id,field,value"),
        F.concat_ws(",", "o_orderkey", F.lit("status"), "o_orderstatus"),
        F.concat_ws(",", "o_orderkey", F.lit("priority"), "o_orderpriority"),
        F.lit(""),
    )
    return csv_text_rows(t.orders.select(text.alias("report")), "report", "id bigint, field string, value string")


@query("SELECT o_orderkey, o_totalprice, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS day FROM orders")
def snk_parquet_dt(t: Tables) -> DataFrame:
    path = t.scratch("days")
    days = t.orders.select("o_orderkey", "o_totalprice", F.to_date(F.date_trunc("month", "o_orderdate")).alias("dt"))
    write_days(days, path)
    # the second run replaces every day it holds
    write_days(days, path, mode="overwrite")
    stored = t.spark.read.parquet(path)
    return stored.select("o_orderkey", "o_totalprice", F.date_format("dt", "yyyy-MM-dd").alias("day"))


@query("SELECT p_partkey, p_brand FROM part")
def snk_overwrite(t: Tables) -> DataFrame:
    path = t.scratch("snapshot")
    parts = t.part.select("p_partkey", "p_brand")
    write_snapshot(parts.where("p_brand = 'Brand#1'"), path)
    write_snapshot(parts, path)
    return t.spark.read.parquet(path)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def snk_append_table(t: Tables) -> DataFrame:
    path = t.scratch("table")
    table = "suppliers_" + path.rpartition("-")[2]
    suppliers = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    append_table(suppliers.where("s_acctbal < 5000"), table, path=path)
    append_table(suppliers.where("s_acctbal >= 5000"), table, path=path)
    return t.spark.table(table)


@query("SELECT c_custkey, c_name, c_mktsegment, replace(c_name, '#', '|\"') AS odd FROM customer")
def snk_csv_header(t: Tables) -> DataFrame:
    path = t.scratch("report")
    customers = t.customer.select(
        "c_custkey", "c_name", "c_mktsegment", F.replace("c_name", F.lit("#"), F.lit('|"')).alias("odd")
    )
    write_report(customers, path, sep="|", quote_all=True)
    return read_delimited(
        t.spark, path, "c_custkey bigint, c_name string, c_mktsegment string, odd string", header=True
    )


@query("SELECT o_orderkey, o_totalprice FROM orders")
def snk_csv_sorted(t: Tables) -> DataFrame:
    path = t.scratch("sorted")
    write_report(
        t.orders.select("o_orderkey", "o_totalprice"), path, sep="|", header=False, sort_by=["o_totalprice", "o_orderkey"]
    )
    return read_delimited(t.spark, path, "o_orderkey bigint, o_totalprice double")


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","s_suppkey":' || s_suppkey || '}' AS value
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def snk_text(t: Tables) -> DataFrame:
    path = t.scratch("text")
    nations = t.nation.select("n_nationkey", "n_name")
    rows = t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    write_lines(rows.select("n_nationkey", "n_name", "s_suppkey"), path)
    return t.spark.read.text(path)


@query("""
SELECT word, count(*) AS n FROM (
  SELECT unnest(CASE WHEN line = '' THEN [''] ELSE
           list_filter(string_split(regexp_replace(line, ' +$', ''), ' '), lambda x: regexp_replace(line, ' +$', '') <> '')
         END) AS word
  FROM (SELECT unnest(CASE WHEN text = '' THEN [''] ELSE
                 list_filter(string_split(regexp_replace(text, '\\n+$', ''), chr(10)), lambda x: regexp_replace(text, '\\n+$', '') <> '')
               END) AS line FROM conversations))
GROUP BY 1
""")
def stream_wordcount(t: Tables) -> DataFrame:
    # Counts per batch are written by the stream; how files fall into batches is up to the
    # source, so the batches are added up here.
    base = t.scratch("stream")
    # a glob, as a stream reads directories or patterns
    lines = file_lines(t.spark, f"{t.directory}/conversations*.parquet", "text string", "text")
    running = start_word_count(lines, f"{base}/counts", f"{base}/checkpoint", available_now=True)
    running.awaitTermination()
    return read_batches(t.spark, f"{base}/counts").groupBy("word").agg(F.sum("n").alias("n"))


_STREAM_PARTS = 4


# Which batch a file falls into is up to the source; the file's part says whose words they are.
@query(f"""
SELECT part, CAST(1 AS BIGINT) AS files, CAST(1 AS BIGINT) AS attempts, word, count(*) AS n FROM (
  SELECT part, unnest(CASE WHEN line = '' THEN [''] ELSE
           list_filter(string_split(regexp_replace(line, ' +$', ''), ' '), lambda x: regexp_replace(line, ' +$', '') <> '')
         END) AS word
  FROM (SELECT CAST(conv_id % {_STREAM_PARTS} AS INTEGER) AS part, unnest(CASE WHEN text = '' THEN [''] ELSE
                 list_filter(string_split(regexp_replace(text, '\\n+$', ''), chr(10)), lambda x: regexp_replace(text, '\\n+$', '') <> '')
               END) AS line FROM conversations))
GROUP BY part, word
""")
def stream_batches(t: Tables) -> DataFrame:
    """Words of each batch on their own, over several files, one to a batch; batches are known by their files."""
    base = t.scratch("stream-batches")
    given = t.conversations.select("text", (F.col("conv_id") % _STREAM_PARTS).cast("int").alias("part"))
    given.repartition(_STREAM_PARTS, "part").write.partitionBy("part").parquet(f"{base}/in")
    words = file_lines_with_origin(t.spark, f"{base}/in/part=*", "text string", "text", files_per_batch=1)
    running = start_timed_word_count(words, f"{base}/counts", f"{base}/manifest", f"{base}/checkpoint", available_now=True)
    running.awaitTermination()
    part = F.regexp_extract(F.col("files")[0], "part=([0-9]+)", 1).cast("int").alias("part")
    batches = read_manifest(t.spark, f"{base}/manifest").select("batch", "attempts", F.size("files").cast("bigint").alias("files"), part)
    counts = read_timed_batches(t.spark, f"{base}/counts", f"{base}/manifest")
    return counts.join(batches, "batch").select("part", "files", "attempts", "word", "n")
