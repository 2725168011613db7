"""What the operators of this package share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftwell.session import scratch_path
from driftwell.sources.writers import stage


ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of a session import this package, unless their path has it.

    Spark's own file distribution hands the sources out; jobs submitted with ``--py-files`` or with
    the package on ``PYTHONPATH`` need nothing.
    """
    application = spark.sparkContext.applicationId
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if application in _shipped or str(ROOT) in on_path or "driftwell" in spark.conf.get("spark.submit.pyFiles", ""):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="driftwell-code-"), "driftwell.zip")
    package = __name__.partition(".")[0]
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted((ROOT / package).rglob("*.py")):
            archive.write(source, source.relative_to(ROOT))
    spark.sparkContext.addPyFile(target)
    _shipped.add(application)


def staged(frame: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``frame`` written to the shared scratch folder and read back; cuts the lineage."""
    return stage(frame, scratch_path(frame.sparkSession, label), *partition_by)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` only, so that no other column of the input can clash with ours."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def learnable(doc_id: Column, folds: int = 5) -> Column:
    """True where a row may be learned from; false for a null id, whose fold is unknown."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds != 0, F.lit(False))
