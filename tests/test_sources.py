"""Readers, writers and connector options."""

import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from driftwell import session
from driftwell.sources import readers, writers


@pytest.fixture
def path(spark):
    return session.scratch_path(spark, "test")


def write_text(path, *lines):
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as out:
        out.write("\n".join(lines) + "\n")


def test_ordinals_with_inferred_types(spark, path):
    write_text(path, "7|x|1.5|null", "8|y|2.5|33")
    frame = readers.read_ordinal(spark, path, {0: "id", 3: "audience", 2: "rate"})
    # one null text makes the column text
    assert frame.dtypes == [("id", "int"), ("audience", "string"), ("rate", "double")]
    assert rows(frame) == [(7, "null", 1.5), (8, "33", 2.5)]
    fixed = readers.read_ordinal(spark, path, {1: "n"}, schema="a bigint, b string, c double, d string")
    assert rows(fixed) == [("x",), ("y",)]


def test_null_token_and_header(spark, path):
    write_text(path, "id,name", "1,null", "2,a")
    frame = readers.read_delimited(spark, path, "id int, name string", sep=",", header=True, null_token="null")
    assert rows(frame) == [(1, None), (2, "a")]
    assert readers.read_delimited(spark, path, sep=",", header=True).dtypes == [("id", "string"), ("name", "string")]


def test_absent_input_gives_an_empty_frame(spark, path):
    frame = readers.read_or_empty(spark, lambda: readers.read_delimited(spark, path, "a int"), "a int")
    assert frame.dtypes == [("a", "int")] and frame.count() == 0
    with pytest.raises(AnalysisException):
        readers.read_or_empty(spark, lambda: spark.sql("select no_such_column"), "a int")


def test_json_rows(spark):
    frame = spark.createDataFrame([(1, '{"a": 1}'), (2, "{bad"), (3, None)], "id int, t string")
    parsed = readers.json_rows(frame, "t", "a int")
    assert rows(parsed, "id", "record.a", "record._corrupt") == [(1, 1, None), (2, None, "{bad"), (3, None, None)]


def test_csv_text(spark):
    frame = spark.createDataFrame([("h1,h2\n1,a\n2,b\n\n",), ("h1,h2",), (None,)], "t string")
    assert rows(readers.csv_text_rows(frame, "t", "x int, y string")) == [(1, "a"), (2, "b")]


def test_cells(spark):
    wide = spark.createDataFrame([("r1", "m", None)], "`inf/mv` string, `inf/200` string, other string")
    assert rows(readers.wide_cells(wide, {"inf/mv": "mvid", "inf/300": "bmid"})) == [("r1", None)]
    long = spark.createDataFrame([("k", "a", "1"), ("k", "z", "2"), ("j", "b", "3")], "k string, q string, v string")
    assert rows(readers.long_cells(long, "k", "q", "v", {"a": "x", "b": "y"})) == [("j", None, "3"), ("k", "1", None)]


def test_day_slice_reads_one_directory(spark, path):
    days = spark.range(10).withColumn("dt", F.expr("date_add(date'2024-01-01', cast(id % 5 as int))"))
    writers.write_days(days, path)
    sliced = readers.day_slice(spark.read.parquet(path), "2024-01-03")
    assert rows(sliced, "id") == [(1,), (6,)]
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert {os.path.basename(os.path.dirname(f)) for f in sliced.inputFiles()} <= {f"dt=2024-01-0{i}" for i in range(1, 6)}


def test_rerun_replaces_only_its_days(spark, path):
    def day(text, n):
        return spark.range(n).withColumn("dt", F.lit(text).cast("date"))

    writers.write_days(day("2024-01-01", 3).union(day("2024-01-02", 4)), path)
    writers.write_days(day("2024-01-02", 9), path, mode="overwrite")
    assert rows(spark.read.parquet(path).groupBy("dt").count(), "count") == [(3,), (9,)]
    with pytest.raises(AnalysisException):
        writers.write_days(day("2024-01-03", 1), path)


def test_small_reports_are_one_file_and_sorted(spark, path):
    frame = spark.range(2000).selectExpr("id % 7 AS k", "id").repartition(6)
    writers.write_report(frame, path, sep="|", header=False, sort_by=["k", "id"])
    files = sorted(glob.glob(f"{path}/part-*"))
    lines = [line.split("|") for f in files for line in open(f).read().splitlines()]
    assert len(files) == 1 and len(lines) == 2000
    assert [[int(a), int(b)] for a, b in lines] == sorted([i % 7, i] for i in range(2000))


def test_report_in_gzip_with_header(spark, path):
    writers.write_report(spark.range(3), path, compression="gzip")
    assert glob.glob(f"{path}/*.csv.gz")
    assert rows(readers.read_delimited(spark, path, "id int", sep=",", header=True)) == [(0,), (1,), (2,)]


def test_lines(spark, path):
    frame = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    writers.write_lines(frame, path, sep="\t")
    assert rows(spark.read.text(path)) == [("1\tnull",), ("2\tb",)]
    writers.write_lines(frame, path + "j")
    assert rows(spark.read.text(path + "j")) == [('{"a":1}',), ('{"a":2,"b":"b"}',)]


def test_append_makes_the_table_and_adds_to_it(spark, path):
    table = "appended_" + path.rpartition("-")[2]
    writers.append_table(spark.range(2), table, path=path)
    writers.append_table(spark.range(3), table, path=path)
    assert spark.table(table).count() == 5


def test_stage_keeps_schema_and_partitions(spark, path):
    frame = spark.createDataFrame([(1, "a", ["x"]), (2, "b", None)], "i int, s string, l array<string>")
    stored = writers.stage(frame, path, "s")
    assert stored.dtypes == frame.dtypes and stored.count() == 2 and os.path.isdir(f"{path}/s=a")


def test_connector_options():
    plain = readers.jdbc_options("jdbc:x", "select 1", user="u", password="p")
    assert plain["query"] == "select 1" and plain["password"] == "p"
    ranged = readers.jdbc_options("jdbc:x", "select 1", partition_column="id", bounds=(0, 9), partitions=3)
    assert ranged["dbtable"] == "(select 1) q" and ranged["numPartitions"] == "3" and "query" not in ranged
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "select 1", partition_column="id")
    assert readers.kafka_options("a:1", "t", max_offsets=5)["maxOffsetsPerTrigger"] == "5"


def test_scratch_is_the_clusters_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.scratch_path(Session(), "x")
