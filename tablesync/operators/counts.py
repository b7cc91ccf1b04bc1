"""Counts and high-water marks."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_scan(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame; answered from Parquet footers or by the server."""
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def high_water_mark(df: DataFrame, keys: list[str]) -> DataFrame:
    """The largest key in one row, NULL for an empty table (so key 0 is a key)."""
    if len(keys) == 1:
        return df.agg(F.max(keys[0]).alias(keys[0]))
    largest = df.agg(F.max(F.struct(*keys)).alias("m"))
    return largest.select(*[F.col(f"m.{k}").alias(k) for k in keys])


def mark_value(df: DataFrame, keys: list[str]) -> tuple | None:
    """The high-water mark as a driver value: one row, used as a pushed-down literal."""
    row = high_water_mark(df, keys).first()
    return None if row[0] is None else tuple(row)


def whole_number(value) -> int | None:
    """A key as the ledger stores it: whole numbers of any type, None for other keys."""
    if isinstance(value, bool) or not isinstance(value, (int, Decimal)):
        return None
    return int(value) if value == int(value) and abs(value) < 1 << 63 else None


def count_and_max(df: DataFrame, key: str) -> DataFrame:
    """Row count and largest key, 0 when there is none."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.max(key), F.lit(0)).alias("max_key"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, also for empty ones.

    The tables are stacked as their names only, so no column is read, and all
    of them are counted in one stage however many there are.
    """
    if not tables:
        raise ValueError("no tables to count")
    spark = next(iter(tables.values())).sparkSession
    listed = F.explode(F.array(*[F.lit(name) for name in tables]))
    names = spark.range(1).select(listed.alias("table_name"))
    stacked = reduce(
        DataFrame.union, [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    )
    counts = stacked.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "table_name", "left").select(
        "table_name", F.coalesce("n", F.lit(0)).alias("total_records")
    )


def total_records(counts: DataFrame) -> DataFrame:
    """The sum over all tables, as a number and as a sentence."""
    return counts.agg(F.sum("total_records").alias("total_records")).select(
        "total_records",
        F.concat(F.lit("Total records: "), F.col("total_records").cast("string")).alias("summary"),
    )


def max_key_param(df: DataFrame, key: str) -> int | None:
    """The largest key as a driver value, to bound generated references; None without a key."""
    return df.agg(F.max(key)).first()[0]
