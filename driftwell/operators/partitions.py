"""Work that looks at the physical partitions of a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

Batches = Iterator[pa.RecordBatch]


def id_range(spark: SparkSession, start: int, stop: int, *, step: int = 1, partitions: int) -> DataFrame:
    """Ids from ``start`` up to ``stop`` in a given number of even, contiguous partitions."""
    return spark.range(start, stop, step, partitions)


def first_per_partition(frame: DataFrame, column: str) -> DataFrame:
    """The smallest value of each non-empty partition; stable where the layout is."""
    return frame.groupBy(F.spark_partition_id().alias("partition")).agg(F.min(column).alias("first"))


def tag_partition(frame: DataFrame, column: str) -> DataFrame:
    """``partition|value`` for every row."""
    return frame.select(F.concat_ws("|", F.spark_partition_id(), F.col(column)).alias("tagged"))


def laid_out(frame: DataFrame, part: Column, parts: int, order: Sequence[str | Column]) -> DataFrame:
    """Each row in the partition whose number ``part`` gives, from 0 to ``parts - 1``, in ``order`` there.

    The layout follows from the rows alone, so it is the same however they were partitioned before,
    and after a lost task; the number of partitions is kept by the adaptive planner.
    """
    numbered = frame.select(F.struct("*").alias("_row"), part.cast("int").alias("_part"))
    return numbered.repartitionById(parts, F.col("_part")).select("_row.*").sortWithinPartitions(*order)


def map_partitions(frame: DataFrame, function: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """``function`` over the Arrow batches of each partition; it need not read all of them."""
    return frame.mapInArrow(function, schema)


def map_partitions_with_index(frame: DataFrame, function: Callable[[int, Batches], Batches], schema: str | StructType) -> DataFrame:
    """The same for a function that is also given the partition's number."""

    def numbered(batches: Batches) -> Batches:
        yield from function(TaskContext.get().partitionId(), batches)

    return frame.mapInArrow(numbered, schema)


def first_rows(frame: DataFrame, n: int = 1, number: str = "partition") -> DataFrame:
    """The first ``n`` rows of each partition with its number; what follows them is not read.

    A partition with fewer rows gives those it has, an empty one none.
    """
    columns = frame.columns

    def first(index: int, batches: Batches) -> Batches:
        wanted = n
        for batch in batches if wanted > 0 else ():
            part = batch.slice(0, wanted)
            if part.num_rows:
                place = pa.array([index] * part.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([place, *part.columns], [number, *columns])
            wanted -= part.num_rows
            if wanted <= 0:
                return

    return map_partitions_with_index(frame, first, StructType([StructField(number, _parse_datatype_string("int")), *frame.schema.fields]))


def tag_rows(frame: DataFrame, column: str, name: str = "tagged") -> DataFrame:
    """``partition|value`` of every row as it passes through its partition's iterator; null stays null."""
    texts = frame.select(F.col(column).cast("string").alias(name))

    def tagged(index: int, batches: Batches) -> Batches:
        for batch in batches:
            values = batch.column(0)
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(pa.scalar(str(index), values.type), values, pa.scalar("|", values.type))], [name])

    return map_partitions_with_index(texts, tagged, f"{name} string")
