"""Cleaning of cell values and the report of what was cleaned."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.dates import (
    clean_bytes,
    clean_text_date,
    clean_timestamp,
    column_role,
    is_tracked,
)


def cleaned(field: T.StructField, run_ts: datetime, as_text: bool = False) -> Column:
    """The cleaning rule that fits a column's type and name; bytes are text only on demand."""
    value, tracked = F.col(f"`{field.name}`"), is_tracked(field.name)
    if isinstance(field.dataType, T.StringType):
        return clean_text_date(value, tracked, run_ts)
    if isinstance(field.dataType, T.BinaryType) and as_text:
        return clean_bytes(value, tracked, run_ts)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return clean_timestamp(value, field.dataType.simpleString(), run_ts)
    return value


def sanitize_rows(
    df: DataFrame,
    run_ts: datetime,
    columns: list[str] | None = None,
    text_bytes: list[str] | None = None,
) -> DataFrame:
    """Clean every column by its type, or only the named ones.

    Binary columns keep their bytes, but for those in ``text_bytes``, which
    become cleaned text. One projection: no shuffle, and the scan reads the
    same columns as before.
    """
    chosen = set(df.columns if columns is None else columns)
    texts = set(text_bytes or [])
    return df.select(
        *[
            cleaned(f, run_ts, f.name in texts).alias(f.name)
            if f.name in chosen
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def sanitize_copied(df: DataFrame, run_ts: datetime, keys: list[str]) -> DataFrame:
    """Clean every column but the keys.

    A key says which row it is. Cleaning it by the time of the run would give a
    row another key in every run, and a mark that later rows lie below.
    """
    if not keys:
        return sanitize_rows(df, run_ts)
    return sanitize_rows(df, run_ts, [c for c in df.columns if c not in keys])


def odd_key(schema: T.StructType, keys: list[str], run_ts: datetime) -> Column:
    """Whether the cleaning rules would change a row's key."""
    same = [F.col(f"`{k}`").eqNullSafe(cleaned(schema[k], run_ts)) for k in keys]
    return ~reduce(lambda a, b: a & b, same, F.lit(True))


def sanitize_text_dates(df: DataFrame, columns: list[str], run_ts: datetime) -> DataFrame:
    """The text rule on the named columns."""
    return df.withColumns(
        {c: clean_text_date(F.col(c), is_tracked(c), run_ts) for c in columns}
    )


def sanitize_timestamps(df: DataFrame, columns: list[str], run_ts: datetime) -> DataFrame:
    """The timestamp rule on the named columns."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.withColumns({c: clean_timestamp(F.col(c), types[c], run_ts) for c in columns})


def bytes_to_text(df: DataFrame, columns: list[str], run_ts: datetime) -> DataFrame:
    """Binary columns as cleaned text."""
    return df.withColumns({c: clean_bytes(F.col(c), is_tracked(c), run_ts) for c in columns})


def column_roles(columns: DataFrame) -> DataFrame:
    """An inventory of columns with the role each name stands for."""
    return columns.withColumn("role", column_role(F.col("column_name")))


def sanitize_report(
    df: DataFrame, run_ts: datetime, table_key: str, text_bytes: list[str] | None = None
) -> DataFrame:
    """How often each column's value was changed into which.

    All columns are compared in one pass; equal changes are counted per task
    before the shuffle.
    """
    text_fields = [
        f
        for f in df.schema
        if isinstance(
            f.dataType,
            (T.StringType, T.BinaryType, T.TimestampType, T.TimestampNTZType, T.DateType),
        )
    ]
    changes = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f"`{f.name}`").cast("string").alias("before"),
            cleaned(f, run_ts, f.name in (text_bytes or [])).cast("string").alias("after"),
        )
        for f in text_fields
    ]
    return (
        df.select(F.inline(F.array(*changes)))
        .filter(~F.col("before").eqNullSafe(F.col("after")))
        .groupBy("column_name", "before", "after")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(table_key).alias("table_key"), "column_name", "before", "after", "rows")
    )
