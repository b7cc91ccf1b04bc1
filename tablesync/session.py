"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def get_session(app_name: str = "tablesync", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are written for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one
    temporary folder per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tablesync-")
    return _LOCAL_ROOTS[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has been written to yet."""
    path = f"{shared_dir(spark)}/tablesync/{label}-{uuid.uuid4().hex}"
    if (scratch := _SCRATCH.get()) is not None:
        scratch.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Every fresh path that is taken inside is removed when the block ends."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            remove_folder(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so later passes see exactly these rows and partitions,
    and a lost executor costs a re-read instead of a recomputation. Parquet
    keeps column pruning for the later passes.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
