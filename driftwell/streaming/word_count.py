"""Word counts of each micro-batch of a stream of text lines."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwell.functions.text import jvm_split, lines
from driftwell.operators.keyed import word_counts

# Fixed value: length of a micro-batch.
BATCH_INTERVAL = "10 seconds"


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a text socket; for trying things out, as a socket can not be replayed."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def file_lines(
    spark: SparkSession, path: str, schema: str, column: str, *, format: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Lines of a text column of files as they arrive; ``path`` may be a glob."""
    reader = spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.explode(lines(F.col(column))).alias("value"))


def count_words(batch: DataFrame) -> DataFrame:
    return word_counts(batch, jvm_split(F.col("value"), " "))


def start_word_count(
    stream: DataFrame, target: str, checkpoint: str, *, available_now: bool = False, interval: str = BATCH_INTERVAL
) -> StreamingQuery:
    """Count the words of every batch on their own and write them as JSON lines to
    ``target/batch=<n>``.

    Counts do not add up from batch to batch.  A batch that is run again after a failure replaces
    its own directory, so its words are not counted twice.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        count_words(batch).write.mode("overwrite").json(f"{target}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """``word, n, batch`` of all batches written."""
    return spark.read.schema("word string, n bigint, batch int").json(target)


# What the manifest says of a batch: an attempt begins, an attempt has written everything.
STARTED, WRITTEN = "started", "written"
MANIFEST = "batch bigint, time_ms bigint, attempt string, state string, file string"


def file_lines_with_origin(
    spark: SparkSession, path: str, schema: str, column: str, *, format: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Like ``file_lines``, each line with the path of the ``file`` it comes from."""
    reader = spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.explode(lines(F.col(column))).alias("value"), F.col("_metadata.file_path").alias("file"))


def batch_time(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """When a batch was planned, in milliseconds, as its offsets in the checkpoint say.

    A batch that is run again after a failure keeps its offsets and so its time.
    """
    for line in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect():
        if line["value"].startswith("{") and "batchTimestampMs" in line["value"]:
            return int(json.loads(line["value"])["batchTimestampMs"])
    raise ValueError(f"no time for batch {batch_id} in {checkpoint}")


def start_timed_word_count(
    stream: DataFrame, target: str, manifest: str, checkpoint: str, *, available_now: bool = False, interval: str = BATCH_INTERVAL
) -> StreamingQuery:
    """Count the words of every batch on their own, in ``target/time_ms=<the batch's time>``.

    ``stream`` has ``value`` and ``file``.  ``manifest`` gets a row when an attempt at a batch
    begins, and one for each of the batch's files once its counts are written.  A batch that is run
    again replaces its own counts, as its time is the same, and is seen to be a repeat by its second
    attempt; counts without a written attempt are not read.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        time_ms, attempt = batch_time(spark, checkpoint, batch_id), uuid.uuid4().hex

        def note(rows: DataFrame) -> None:
            rows.write.mode("append").json(manifest)

        def row(state: str) -> list:
            return [F.lit(batch_id).alias("batch"), F.lit(time_ms).alias("time_ms"), F.lit(attempt).alias("attempt"), F.lit(state).alias("state")]

        note(spark.range(1).select(*row(STARTED)))
        count_words(batch).write.mode("overwrite").json(f"{target}/time_ms={time_ms}")
        note(batch.select("file").distinct().select(*row(WRITTEN), "file"))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """``batch, time_ms, attempts, files`` of every batch that has been written."""
    notes = spark.read.schema(MANIFEST).json(manifest)
    found = notes.groupBy("batch", "time_ms").agg(
        F.count_distinct("attempt").alias("attempts"),
        F.count_if(F.col("state") == WRITTEN).alias("_written"),
        F.sort_array(F.collect_set("file")).alias("files"),
    )
    return found.where("_written > 0").drop("_written")


def read_timed_batches(spark: SparkSession, target: str, manifest: str) -> DataFrame:
    """``batch, time_ms, word, n`` of the batches that the manifest calls written."""
    counts = spark.read.schema("word string, n bigint, time_ms bigint").json(target)
    return counts.join(read_manifest(spark, manifest).select("batch", "time_ms"), "time_ms").select("batch", "time_ms", "word", "n")
