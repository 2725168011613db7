"""Registration of queries and access to the tables they run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from driftwell.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def exact_mean_sql(column: str) -> str:
    """Mean of amounts of two digits, half up at the sixth: what the mean of ``decimal(18,2)`` is, in whole numbers."""
    cents = f"CAST(sum(CAST({column} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    return f"CAST(({cents} * 20000 + count({column})) // (2 * count({column})) AS DOUBLE) / 1000000"


class Tables:
    """Parquet tables of one directory, as attributes."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.directory}/{table}.parquet")

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def query(sql: str | None, name: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of ``Tables`` under its name, with its SQL twin or None."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = lambda spark, directory: build(Tables(spark, directory))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register
