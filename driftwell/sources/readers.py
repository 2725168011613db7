"""Sources.  File readers take any Hadoop path; a fixed schema saves the inference pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from driftwell.functions.text import lines
from driftwell.functions.time import days_before


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    sep: str = "|",
    header: bool = False,
    null_token: str | None = None,
    multi_line: bool = False,
    infer: bool = False,
) -> DataFrame:
    """Delimited text.

    ``schema`` None means all strings, or with ``infer`` types found in one more pass over the file.  Quotes inside quoted fields are doubled.  ``multi_line``
    lets a quoted field hold a newline; such a file can not be split among tasks, so leave it off
    where fields are known to be one line.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    if multi_line:
        reader = reader.option("multiLine", True)
    return reader.csv(path)


def read_ordinal(
    spark: SparkSession,
    path: str,
    names: Mapping[int, str],
    *,
    sep: str = "|",
    schema: StructType | str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Columns of a header-less file picked by position and named.

    Types are inferred unless ``schema`` names all columns.  Inference reads the file once more;
    ``sampling_ratio`` below one makes that pass parse only a share of the lines.
    """
    reader = spark.read.option("sep", sep).option("escape", '"')
    if schema is not None:
        frame = reader.schema(schema).csv(path)
    else:
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        frame = reader.option("inferSchema", True).csv(path)
    return frame.select(*[F.col(f"`{frame.columns[i]}`").alias(name) for i, name in names.items()])


def read_or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: StructType | str) -> DataFrame:
    """``read()``, or an empty frame of ``schema`` where the input path is absent."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def day_slice(frame: DataFrame, run_date: str, days_back: int = 1, day_column: str = "dt") -> DataFrame:
    """The rows of the day ``days_back`` before ``run_date``.

    The right-hand side is a constant, so on a frame partitioned by the day only that directory
    is listed and read.
    """
    return frame.where(F.col(day_column) == days_before(run_date, days_back))


def json_rows(frame: DataFrame, text: str, schema: str, name: str = "record") -> DataFrame:
    """Replace a column of JSON text by ``name``, a struct of a fixed schema.

    The struct's last field, ``_corrupt``, has the text of a value that is not valid JSON.  The
    column is one ``from_json`` and nothing around it, so that it is parsed once however many of
    its fields are used, and only the used fields are built.
    """
    parsed = F.from_json(
        F.col(text), f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    kept = [F.col(f"`{c}`") for c in frame.columns if c != text]
    return frame.select(*kept, parsed.alias(name))


def csv_text_rows(
    frame: DataFrame, text: str, schema: str, *, header: bool = True, sep: str = ","
) -> DataFrame:
    """Rows of a CSV document held in one string column; one input row is one document."""
    numbered = frame.select(F.posexplode(lines(F.col(text))).alias("line_no", "line"))
    body = numbered.where("line_no > 0") if header else numbered
    return body.select(F.from_csv("line", schema, {"sep": sep}).alias("r")).select("r.*")


def wide_cells(frame: DataFrame, cells: Mapping[str, str]) -> DataFrame:
    """Pick cells of a wide, sparse table as optional strings: ``{stored name: output name}``.

    A cell the table does not hold at all comes out as null, like one missing in a single row.
    """

    def cell(stored: str, name: str) -> Column:
        found = F.col(f"`{stored}`") if stored in frame.columns else F.lit(None)
        return found.cast("string").alias(name)

    return frame.select(*[cell(stored, name) for stored, name in cells.items()])


def long_cells(
    frame: DataFrame, row_key: str, qualifier: str, value: str, cells: Mapping[str, str]
) -> DataFrame:
    """The same from the long form: one row for each (row key, qualifier, value)."""
    picked = [
        F.max(F.when(F.col(qualifier) == stored, F.col(value).cast("string"))).alias(name)
        for stored, name in cells.items()
    ]
    return frame.where(F.col(qualifier).isin(*cells)).groupBy(row_key).agg(*picked)


def jdbc_options(
    url: str,
    query: str,
    *,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``; credentials come from the caller's configuration.

    With ``partition_column`` the query is read in ``partitions`` ranges instead of one task.
    """
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column is None:
        options["query"] = query
    else:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a partition number")
        options |= {
            "dbtable": f"({query}) q",
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def kafka_options(servers: str, topic: str, *, starting: str = "latest", max_offsets: int | None = None) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``; the connector is the cluster's to provide."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options
