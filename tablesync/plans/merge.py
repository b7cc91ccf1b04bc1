"""Replacing rows by key in a stored table, writing only the folders that hold one of the keys."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.model import TableSpec
from tablesync.operators.conform import conform_rows
from tablesync.operators.skew import join_on_key_set, latest_per_key
from tablesync.session import scratch_space, stage
from tablesync.sources.records import read_record
from tablesync.sources.versions import current_folders, new_folder, publish, table_path
from tablesync.sources.zones import folder_zones, folders_of_keys, with_folder

ZONE = "_zone"


@dataclass(frozen=True)
class MergeResult:
    """The table's folders now, those written anew with the folders they replace, and their rows."""

    locations: tuple[str, ...]
    written: tuple[str, ...]
    replaced: tuple[str, ...]
    rows_written: int


def merge_rows(
    batch: DataFrame, spec: TableSpec, root: str, order_cols: list[str] | None = None,
    run_ts: datetime | None = None,
) -> MergeResult:
    """Replace by key into the table below ``root``: the result of ``replace_into`` on the whole table.

    Every folder of a table has its smallest and largest key and a Bloom
    filter stored beside it. Only folders that may hold a key of the batch are
    read and written again, each into a folder of its own, so they keep their ranges; all other
    folders stay as they are. Rows with keys that no folder holds go to one
    further folder. The table points to the new folders once all are written.

    ``order_cols`` say which of several batch rows with one key is the last;
    without them the batch must hold each key once. Rows with a NULL in their key replace nothing.
    A table that is not there yet becomes the batch. Where the table has a record the batch is held
    to it, with ``run_ts`` (now, if not given) where a default is the time of the insert.
    """
    spark, keys = batch.sparkSession, list(spec.keys)
    if not keys:
        raise ValueError("replacing rows needs key columns; load the whole table instead")
    path = table_path(root, spec)
    folders = current_folders(spark, path)
    with scratch_space(spark):
        last = latest_per_key(batch, keys, order_cols) if order_cols else batch
        record = read_record(spark, path)
        if record:
            last = conform_rows(last, record, run_ts or datetime.now())
        if not folders:
            return _first_version(last, path)
        schema = spark.read.parquet(*folders).schema
        last = stage(last.select(*schema.names), "batch")
        zones = folder_zones(spark, path, folders, keys)
        near = stage(folders_of_keys(last.select(*keys), zones, keys), "near")
        touched = [row["folder"] for row in near.select("folder").distinct().collect()]
        where = _numbered(last, near, keys, touched)
        if touched:
            old = with_folder(spark, touched, schema)
            kept = join_on_key_set(old, last.select(*keys), keys, "left_anti", write_out=False)
            where = kept.join(F.broadcast(_numbers(spark, touched)), "_folder").drop("_folder").unionByName(where)
        base = new_folder(path, "merge")
        where.write.partitionBy(ZONE).parquet(base)
    # The empty zones, all of whose rows were replaced by rows placed elsewhere, have no folder.
    rows = spark.read.schema(T.StructType([T.StructField(ZONE, T.IntegerType())])).parquet(base)
    sizes = {row[ZONE]: row["count"] for row in rows.groupBy(ZONE).count().collect()}
    written = tuple(f"{base}/{ZONE}={number}" for number in sorted(sizes))
    locations = (*[f for f in folders if f not in set(touched)], *written)
    publish(spark, path, locations)
    return MergeResult(locations, written, tuple(touched), sum(sizes.values()))


def _numbers(spark, touched: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(touched)), f"{ZONE} int, _folder string")


def _numbered(last: DataFrame, near: DataFrame, keys: list[str], touched: list[str]) -> DataFrame:
    """The batch with the number of the folder each row goes to: one that may hold its key, else a new one."""
    if not touched:
        return last.withColumn(ZONE, F.lit(0))
    numbers = F.broadcast(_numbers(last.sparkSession, touched))
    place = near.join(numbers, near["folder"] == numbers["_folder"]).groupBy(*keys).agg(F.min(ZONE).alias(ZONE))
    placed = last.join(place, keys, "left").select(*last.columns, ZONE)
    return placed.withColumn(ZONE, F.coalesce(ZONE, F.lit(len(touched))))


def _first_version(rows: DataFrame, path: str) -> MergeResult:
    folder = new_folder(path, "merge")
    rows.write.parquet(folder)
    publish(rows.sparkSession, path, (folder,))
    count = rows.sparkSession.read.parquet(folder).count()
    return MergeResult((folder,), (folder,), (), count)

