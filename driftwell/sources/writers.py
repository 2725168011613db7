"""Sinks.

No writer forces its rows through one task.  A "one file" report is written behind a shuffle whose
partitions the adaptive planner sizes from the real bytes: a small report ends up in one file, a
large one in several, which for a sorted report follow one another in name order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def write_days(frame: DataFrame, path: str, *, day_column: str = "dt", mode: str = "errorifexists") -> None:
    """Parquet below ``path`` with one directory per day.

    ``mode="overwrite"`` replaces only the days present in the frame, so a rerun of a day is safe.
    The rebalance keeps the number of files down and splits a day that is larger than the others.
    """
    (
        frame.hint("rebalance", day_column)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_column)
        .parquet(path)
    )


def write_snapshot(frame: DataFrame, path: str) -> None:
    """Parquet that replaces whatever the path held."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def stage(frame: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write an intermediate frame as parquet and return what was written.

    Cuts the lineage: whatever reads the result starts from files on the shared file system, also
    after executors are lost.
    """
    frame.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    stored = frame.sparkSession.read.schema(frame.schema).parquet(path)
    return stored.select(*[F.col(f"`{c}`") for c in frame.columns])


def append_table(frame: DataFrame, table: str, *, path: str | None = None) -> None:
    """Append to a catalog table, made on first use; ``path`` makes it an external one."""
    writer = frame.write.mode("append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def replace_partitions(frame: DataFrame, table: str, *partition_by: str) -> None:
    """Write to a catalog table, made on first use, replacing the partitions the frame has rows of.

    Running the same day again leaves the table as it was.
    """
    spark = frame.sparkSession
    if not spark.catalog.tableExists(table):
        frame.write.partitionBy(*partition_by).saveAsTable(table)
        return
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise ValueError("set spark.sql.sources.partitionOverwriteMode to dynamic, or other partitions are lost")
    frame.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)


def write_report(
    frame: DataFrame,
    path: str,
    *,
    sep: str = ",",
    header: bool = True,
    sort_by: list[str | Column] | None = None,
    compression: str = "none",
    quote_all: bool = False,
    few_files: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Delimited report, in as few files as its size allows; see the module text.

    For a whole table turn ``few_files`` off: its rows are then written by the tasks that have
    them, without a shuffle.

    End ``sort_by`` with enough columns to tell rows apart: the sort is cut into ranges, and rows
    that compare equal can not be put into different ranges.
    """
    if sort_by:
        arranged = frame.orderBy(*sort_by)
    else:
        arranged = frame.hint("rebalance") if few_files else frame
    (
        arranged.write.mode(mode)
        .option("sep", sep)
        .option("header", header)
        .option("escape", '"')
        .option("quoteAll", quote_all)
        .option("compression", compression)
        .csv(path)
    )


def write_lines(frame: DataFrame, path: str, *, sep: str | None = None, mode: str = "errorifexists") -> None:
    """One text line for each row: values joined by ``sep``, or a JSON object where it is None."""
    if sep is None:
        line = F.to_json(F.struct("*"))
    else:
        line = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in frame.columns])
    frame.select(line.alias("value")).write.mode(mode).text(path)
