"""What several operators share: files of the shared folder, batches, words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tablesync.session import fresh_path, stage

__all__ = ["fresh_path", "stage", "file_system", "qualified", "slices", "texts_of", "lower_ascii",
           "plain_words", "table", "WORD_BYTES"]

# Words of letters and digits: every byte above 0x7F belongs to a word.
WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path of the shared folder, and the path on it."""
    if "://" not in uri:
        return fs.LocalFileSystem(), re.sub("^file:", "", uri)
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark takes it, for tasks that open files themselves."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that few texts are held at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text", field: int | None = None) -> list[bytes]:
    """A text column, or a field of a struct column, as UTF-8 bytes, null as empty."""
    values = batch.column(column)
    if field is not None:
        values = pc.struct_field(values, [field])
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return [value or b"" for value in values.cast(kind).to_pylist()]


def lower_ascii(text: bytes) -> bytes:
    """A-Z in lower case, every other byte as it is."""
    return text.lower()


def plain_words(text: bytes) -> list[bytes]:
    """The runs between ASCII white space (space and 0x09-0x0D)."""
    return text.split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
