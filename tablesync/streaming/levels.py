"""Micro-batches merged by size: old ones lie in a few large folders, new ones in small ones.

A run is a folder with the rows of successive micro-batches. Once ``FAN`` runs
of one level lie beside each other they are merged into one of the next level,
so N micro-batches lie in about ``FAN`` * log N runs, and a row is written once per level. A
version names the runs that count; former ones are removed by the next merge but one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.session import remove_folder
from tablesync.sources.zones import folder_exists

BATCH = "stream_batch"
FAN = 4
RUN = "struct<folder: string, level: int, first: bigint, last: bigint>"
VERSION = f"version bigint, runs array<{RUN}>"


@dataclass(frozen=True)
class Run:
    """The rows of the micro-batches from ``first`` to ``last``; level 0 is one as it was written."""

    folder: str
    level: int
    first: int
    last: int


def _numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def listed_batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the micro-batches written so far and not merged away."""
    if not folder_exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [re.fullmatch(rf"{BATCH}=(\d+)", f.getPath().getName()) for f in system.listStatus(place)]
    return sorted(int(name[1]) for name in names if name)


def current_runs(spark: SparkSession, path: str) -> tuple[int, list[Run]]:
    """The newest version and its runs."""
    if not folder_exists(spark, f"{path}-levels/current"):
        return 0, []
    reader = spark.read.schema(VERSION).option("recursiveFileLookup", "true")
    row = reader.parquet(f"{path}-levels/current").orderBy(F.desc("version")).first()
    return (row["version"], [Run(*run) for run in row["runs"]]) if row else (0, [])


def read_runs(spark: SparkSession, path: str, schema: T.StructType, runs: Sequence[Run]) -> DataFrame:
    """The rows of runs with the number of the micro-batch each came in."""
    numbered = _numbered(schema)
    fresh = [run.folder for run in runs if run.level == 0]
    merged = [run.folder for run in runs if run.level]
    parts = []
    if fresh:  # the number is in the folder's name
        parts.append(spark.read.schema(numbered).option("basePath", path).parquet(*fresh))
    if merged:
        parts.append(spark.read.schema(numbered).parquet(*merged))
    if not parts:
        return spark.createDataFrame([], numbered)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def plan_merges(runs: Sequence[Run], fan: int = FAN) -> list[list[Run]]:
    """Which successive runs belong together; groups of one stay as they are.

    Runs are in the order of their batches, their levels fall towards the newest. A group of
    ``fan`` counts as a run of the next level at once, so one write can climb several levels.
    """
    groups: list[tuple[int, list[Run]]] = []
    for run in runs:
        groups.append((run.level, [run]))
        while len(groups) >= fan and len({level for level, _ in groups[-fan:]}) == 1:
            level = groups[-1][0]
            together = [r for _, members in groups[-fan:] for r in members]
            groups[-fan:] = [(level + 1, together)]
    return [members for _, members in groups]


def _level(members: Sequence[Run], fan: int) -> int:
    """The level of a merged group: the lowest that holds its micro-batches."""
    counts, level = sum(fan ** r.level for r in members), 0
    while fan ** (level + 1) <= counts:
        level += 1
    return level


def fold_batches(
    spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame],
    fan: int = FAN,
) -> list[Run]:
    """Take new micro-batches in and merge runs where due; the runs that hold all there is.

    ``merge`` brings rows of successive micro-batches, with their numbers, down
    to those that still count, with the numbers kept. One caller at a time.
    """
    version, runs = current_runs(spark, path)
    newest = max((run.last for run in runs), default=-1)
    fresh = [Run(f"{path}/{BATCH}={n}", 0, n, n) for n in listed_batches(spark, path) if n > newest]
    if not fresh:
        return runs
    kept: list[Run] = []
    for members in plan_merges([*runs, *fresh], fan):
        if len(members) == 1:
            kept += members
            continue
        folder = f"{path}-levels/run-{uuid.uuid4().hex}"
        merge(read_runs(spark, path, schema, members)).write.parquet(folder)
        kept.append(Run(folder, _level(members, fan), members[0].first, members[-1].last))
    row = spark.createDataFrame([(version + 1, [astuple(run) for run in kept])], VERSION)
    row.coalesce(1).write.parquet(f"{path}-levels/current/{version + 1:012d}-{uuid.uuid4().hex}")
    _remove_former(spark, path, version + 1)
    return kept


def _remove_former(spark: SparkSession, path: str, version: int) -> None:
    """Remove runs that neither this version nor the one before it names.

    A reader that opened the version before still finds all of its folders.
    """
    reader = spark.read.schema(VERSION).option("recursiveFileLookup", "true")
    versions = reader.parquet(f"{path}-levels/current")
    named = versions.select("version", F.explode("runs.folder").alias("folder"))
    used = named.filter(F.col("version") >= version - 1).select("folder")
    gone = named.filter(F.col("version") == version - 2).select("folder").distinct().join(
        used, "folder", "left_anti").collect()
    for row in gone:
        remove_folder(spark, row["folder"])
