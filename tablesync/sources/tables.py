"""Tables as Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_table(
    spark: SparkSession, path: str, columns: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table with an explicit column list; the scan reads only those columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def truncate_load(df: DataFrame, path: str) -> DataFrame:
    """Make ``path`` hold exactly the rows of ``df``, none when ``df`` is empty.

    ``df`` must not read from ``path``.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """Add the rows of ``df`` to the table at ``path``."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
