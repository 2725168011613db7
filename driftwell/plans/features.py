"""Feature rows for a delay classifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from driftwell.operators.joins import join_aggregate
from driftwell.session import scratch_path
from driftwell.sources.writers import stage

# The fields of a flight line, by position.
FLIGHT = (
    "dofM string, dofW string, carrier string, tailnum string, flnum int, org_id string, origin string, "
    "dest_id string, dest string, crsdeptime double, deptime double, depdelaymins double, crsarrtime double, "
    "arrtime double, arrdelay double, crselapsedtime double, dist int"
)
# The categories indexed, the order of the features, and the delay that makes a row positive.
CATEGORIES = ("carrier", "origin", "dest")
FEATURES = ("monthday", "weekday", "crsdeptime", "crsarrtime", "carrier", "crselapsedtime", "origin", "dest")
DELAYED_AFTER = 40.0


def _texts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.select(*[F.col(c).cast("string").alias(c) for c in columns])


def _entries(columns: Sequence[str]) -> Column:
    """``column, value`` for each of the columns."""
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))


def category_indexes(frame: DataFrame, columns: Sequence[str], *, slices: int | None = None) -> DataFrame:
    """``column, value, index``: each column's distinct values numbered from zero, in order, null first.

    The number is the value's place in sorted order, so it does not change between runs.  The frame
    is read once for all columns.  Its distinct values are dealt out by ranges of (column, value)
    over ``slices`` tasks, as many as there are shuffle partitions if not given, and written in
    order with their place in the range.  What reaches the driver is a count for each column and
    range, whose running sums say where a range begins; a value's number is that plus its place.
    """
    spark = frame.sparkSession
    ranges = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = _texts(frame, columns).select(_entries(columns).alias("e")).select("e.*").distinct()
    dealt = values.repartitionByRange(ranges, "column", "value").sortWithinPartitions("column", "value")
    # The number of the range in the upper bits, the place in it in the lower 33.
    placed = dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33))
    stored = stage(placed, scratch_path(spark, "categories"))
    held = stored.groupBy("column", "_range").agg(F.count("*").alias("n"), F.min("_at").alias("first")).collect()
    begins, before = [], {c: 0 for c in columns}
    for part in sorted(held, key=lambda r: r["_range"]):
        begins.append((part["column"], part["_range"], before[part["column"]] - part["first"]))
        before[part["column"]] += part["n"]
    begun = spark.createDataFrame(begins, "column string, _range bigint, _begin bigint")
    return stored.join(begun, ["column", "_range"]).select("column", "value", (F.col("_begin") + F.col("_at")).alias("index"))


def category_index(frame: DataFrame, column: str, *, slices: int | None = None) -> DataFrame:
    """The same for one column: ``column, index``."""
    return category_indexes(frame, [column], slices=slices).select(F.col("value").alias(column), "index")


def with_category_indexes(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column replaced by its value's index, as a double.

    The rows are joined once, however many columns there are: the distinct combinations of values
    are looked up in the dictionary, by one join for all columns on (column, value), and the rows
    meet their combination.
    """
    combined = stage(_texts(frame, columns).distinct(), scratch_path(frame.sparkSession, "combinations"))
    indexes = category_indexes(combined, columns).withColumnRenamed("column", "_column")
    key = F.struct(*columns)
    looked_up = combined.select(key.alias("_combined"), _entries(columns).alias("_e")).select("_combined", "_e.*")
    found = looked_up.join(
        indexes.withColumnRenamed("value", "_value"), (F.col("column") == F.col("_column")) & F.col("value").eqNullSafe(F.col("_value"))
    )
    numbers = [F.max(F.when(F.col("column") == c, F.col("index"))).cast("double").alias(f"_i{i}") for i, c in enumerate(columns)]
    wide = found.groupBy("_combined").agg(*numbers)
    keyed = frame.withColumn("_combined", F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))
    joined = join_aggregate(keyed, wide, ["_combined"])
    return joined.withColumns({c: F.col(f"_i{i}") for i, c in enumerate(columns)}).select(*frame.columns)


def feature_rows(flights: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Label and eight numeric features for each flight; ``passthrough`` columns are kept."""
    # The indexes are looked up on the needed columns only.
    needed = flights.select(
        *passthrough,
        "dofM",
        "dofW",
        "crsdeptime",
        "crsarrtime",
        "carrier",
        "crselapsedtime",
        "origin",
        "dest",
        "depdelaymins",
    )
    indexed = with_category_indexes(needed, CATEGORIES)
    return indexed.select(
        *passthrough,
        F.when(F.col("depdelaymins") > DELAYED_AFTER, 1.0).otherwise(0.0).alias("label"),
        (F.col("dofM").cast("int") - 1).cast("double").alias("monthday"),
        (F.col("dofW").cast("int") - 1).cast("double").alias("weekday"),
        F.col("crsdeptime").cast("int").cast("double").alias("crsdeptime"),
        F.col("crsarrtime").cast("int").cast("double").alias("crsarrtime"),
        "carrier",
        "crselapsedtime",
        "origin",
        "dest",
    )


def labelled_points(rows: DataFrame) -> DataFrame:
    """``label, features`` with the features as one vector; rows that lack a feature are left out."""
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip").transform(rows)
    return assembled.select("label", "features")


def incomplete_rows(rows: DataFrame) -> DataFrame:
    """The rows that ``labelled_points`` leaves out: a feature is null or not a number."""
    lacking = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in FEATURES]
    return rows.where(reduce(lambda a, b: a | b, lacking))
