"""Row counts of stored tables from the footers of their files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sources.zones import folder_uri

_FILE = "table_name string, file string, rows bigint"


def _parquet_files(system: fs.FileSystem, path: str) -> list[str]:
    """The data files at a path: itself, or those below it that readers do not pass over."""
    if system.get_file_info(path).type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(path, recursive=True))
    below = [f.path for f in found if f.type == fs.FileType.File]
    hidden = lambda part: part.startswith(("_", ".")) and "=" not in part
    return [f for f in below if not any(map(hidden, f[len(path):].split("/")))]


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for name, uri in zip(batch.column("table_name").to_pylist(), batch.column("uri").to_pylist()):
            try:
                system, path = _open(uri)
                for file in _parquet_files(system, path):
                    with system.open_input_file(file) as source:
                        out.append((name, file, pq.ParquetFile(source).metadata.num_rows))
            except (OSError, pa.ArrowException):  # the table's count is unknown, others' are not
                out.append((name, None, None))
        columns = list(zip(*out)) or [(), (), ()]
        kinds = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["table_name", "file", "rows"]
        )


def footer_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``total_records`` of each table, by name and Parquet path; NULL for one that cannot be read.

    One job for all tables: their names are dealt out, and a task reads the
    footers of the tables it gets. The plan does not grow with their number and no row is read.
    """
    if not tables:
        raise ValueError("no tables to count")
    rows = [(name, folder_uri(spark, path)) for name, path in tables.items()]
    listed = spark.createDataFrame(rows, "table_name string, uri string").repartition(
        min(len(rows), 4 * spark.sparkContext.defaultParallelism), "table_name"
    )
    unknown = F.count_if(F.col("rows").isNull()) > 0
    counts = listed.mapInArrow(_read_footers, _FILE).groupBy("table_name").agg(
        F.when(~unknown, F.sum("rows")).alias("n"), F.lit(True).alias("seen")
    )
    return listed.select("table_name").join(counts, "table_name", "left").select(
        "table_name", F.when(F.col("seen").isNull(), F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("total_records")
    )
