"""Many tables of one day, published together.

All tables are first written below ``target/_incoming``; what is there before stays as it is while
they are.  Then a plan of the renames is written, the renames are made, and a mark says that the day
is whole.  A job that fails before the plan leaves the old day whole.  One that fails behind it
leaves a plan, which the next job for the day, or ``finish_day``, carries out: every rename can be
made again.  Tables of one schema are written by one job, so a day takes a job for each schema and
not one for each table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftwell.session import delete_path

# Jobs that write at the same time.
WRITERS = 4


def _hadoop(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def _exists(spark: SparkSession, path: str) -> bool:
    system, found = _hadoop(spark, path)
    return system.exists(found)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    system, found = _hadoop(spark, old)
    _, to = _hadoop(spark, new)
    system.mkdirs(to.getParent())
    if not system.rename(found, to):
        raise OSError(f"{old} could not be renamed to {new}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place and renamed there, so that a half-written one is never read."""
    beside = f"{path}.{uuid.uuid4().hex}"
    system, found = _hadoop(spark, beside)
    out = system.create(found, True)
    out.write(text.encode())
    out.close()
    delete_path(spark, path)
    _rename(spark, beside, path)


def _plan_path(target: str, day: str) -> str:
    return f"{target}/_publishing/{day}"


def _mark_path(target: str, day: str) -> str:
    return f"{target}/_whole/{day}"


def day_is_whole(spark: SparkSession, target: str, day: str) -> bool:
    """True once a day is published and no later run has begun to replace it."""
    return _exists(spark, _mark_path(target, day)) and not _exists(spark, _plan_path(target, day))


def finish_day(spark: SparkSession, target: str, day: str) -> bool:
    """Carry out the plan that a job has left, if there is one; true if there was."""
    if not _exists(spark, _plan_path(target, day)):
        return False
    text = "\n".join(r["value"] for r in spark.read.text(_plan_path(target, day)).collect())
    plan = json.loads(text)
    for name in plan["gone"]:
        delete_path(spark, f"{target}/{name}/dt={day}")
    for name, incoming in plan["moved"].items():
        # One that is no longer there has been renamed already.
        if _exists(spark, incoming):
            delete_path(spark, f"{target}/{name}/dt={day}")
            _rename(spark, incoming, f"{target}/{name}/dt={day}")
    _write_text(spark, _mark_path(target, day), json.dumps(sorted(plan["moved"])))
    delete_path(spark, _plan_path(target, day))
    delete_path(spark, f"{target}/_incoming/{day}")
    return True


def _by_schema(tables: Mapping[str, DataFrame]) -> list[list[str]]:
    groups: dict[tuple, list[str]] = {}
    for name, frame in tables.items():
        groups.setdefault(tuple((f.name, f.dataType.simpleString()) for f in frame.schema), []).append(name)
    return list(groups.values())


def publish_day(
    spark: SparkSession,
    target: str,
    day: str,
    tables: Mapping[str, DataFrame],
    gone: Collection[str] = (),
    *,
    overwrite: bool = True,
    before_renames: Callable[[], None] = lambda: None,
) -> None:
    """Each of ``tables`` at ``target/<name>/dt=<day>``, and none of ``gone`` there.

    A table without rows has an empty file with its columns.  Without ``overwrite`` a day that is
    there in any of the tables is an error.  ``before_renames`` runs when everything is written.
    """
    finish_day(spark, target, day)
    if not overwrite:
        for name in tables:
            if _exists(spark, f"{target}/{name}/dt={day}"):
                raise FileExistsError(f"{target}/{name}/dt={day}")
    # What a job that failed before its plan has left.
    delete_path(spark, f"{target}/_incoming/{day}")
    incoming = f"{target}/_incoming/{day}/{uuid.uuid4().hex}"
    places: dict[str, str] = {}

    def write(group: int, names: list[str]) -> None:
        base = f"{incoming}/{group}"
        if len(names) == 1:
            tables[names[0]].write.parquet(f"{base}/_table=0")
        else:
            numbered = [tables[n].withColumn("_table", F.lit(i)) for i, n in enumerate(names)]
            reduce(DataFrame.unionByName, numbered).write.partitionBy("_table").parquet(base)
        for i, name in enumerate(names):
            places[name] = f"{base}/_table={i}"
            if not _exists(spark, places[name]):
                spark.createDataFrame([], tables[name].schema).write.parquet(places[name])

    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        list(pool.map(lambda group: write(*group), enumerate(_by_schema(tables))))
    before_renames()
    # A name that is part of another one's path is moved first, so that it does not replace that one.
    moved = {name: places[name] for name in sorted(places)}
    _write_text(spark, _plan_path(target, day), json.dumps({"moved": moved, "gone": sorted(gone)}))
    finish_day(spark, target, day)
