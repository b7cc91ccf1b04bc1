"""Row-count verdicts and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.measures import TOLERANCE_FLOOR, TOLERANCE_RATE, percent, tolerance


def count_check(
    source_counts: DataFrame,
    dest_counts: DataFrame,
    floor: int = TOLERANCE_FLOOR,
    rate: float = TOLERANCE_RATE,
) -> DataFrame:
    """Verdict per table: ``ok`` within the tolerance, else ``short`` or ``over``.

    Both inputs hold ``(table_name, total_records)``. A table missing in the
    destination counts as 0 rows.
    """
    allowed = tolerance(F.col("src_rows"), floor, rate)
    return (
        source_counts.withColumnRenamed("total_records", "src_rows")
        .join(dest_counts.withColumnRenamed("total_records", "dest_rows"), "table_name", "left")
        .withColumn("dest_rows", F.coalesce("dest_rows", F.lit(0)))
        .withColumn("tolerance", allowed)
        .withColumn(
            "verdict",
            F.when(F.col("dest_rows") < F.col("src_rows") - F.col("tolerance"), "short")
            .when(F.col("dest_rows") > F.col("src_rows") + F.col("tolerance"), "over")
            .otherwise("ok"),
        )
        .select("table_name", "src_rows", "dest_rows", "tolerance", "verdict")
    )


def count_in_range(
    counts: DataFrame, floor: int = TOLERANCE_FLOOR, rate: float = TOLERANCE_RATE
) -> DataFrame:
    """Whether ``actual_rows`` lies within the tolerance of ``expected_rows``."""
    expected = F.col("expected_rows")
    allowed = tolerance(expected, floor, rate)
    return counts.withColumn(
        "in_range", F.col("actual_rows").between(expected - allowed, expected + allowed)
    )


def progress_report(source_counts: DataFrame, dest_counts: DataFrame) -> DataFrame:
    """Progress per table; ``Completed`` needs equal counts.

    A table whose source count is NULL or absent could not be read: ``Error``
    with 0 of 0 rows. An unreadable destination counts as 0 rows.
    """
    unreadable = F.col("src").isNull()
    total = F.when(unreadable, F.lit(0)).otherwise(F.col("src"))
    done = F.when(unreadable, F.lit(0)).otherwise(F.coalesce("dest", F.lit(0)))
    return (
        source_counts.withColumnRenamed("total_records", "src")
        .join(dest_counts.withColumnRenamed("total_records", "dest"), "table_name", "full")
        .select(
            "table_name",
            total.cast("bigint").alias("total_rows"),
            done.cast("bigint").alias("processed_rows"),
            percent(done, total).alias("percent"),
            F.when(unreadable, "Error")
            .when(total == done, "Completed")
            .otherwise("In Progress")
            .alias("status"),
        )
    )


def progress_totals(report: DataFrame) -> DataFrame:
    """Tables and rows done over all tables; 0 % when there are none."""
    sums = report.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("status") == "Completed").alias("completed_tables"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("processed_rows"), F.lit(0)).alias("processed_rows"),
    )
    return sums.select(
        "completed_tables",
        "total_tables",
        percent(F.col("completed_tables"), F.col("total_tables")).alias("tables_percent"),
        "processed_rows",
        "total_rows",
        percent(F.col("processed_rows"), F.col("total_rows")).alias("rows_percent"),
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one timestamp to another, free of any time zone."""
    gap = end - start
    whole = (
        F.extract(F.lit("DAY"), gap) * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
    )
    return whole.cast("double") + F.extract(F.lit("SECOND"), gap).cast("double")


def run_duration(events: DataFrame) -> DataFrame:
    """Elapsed seconds of each table in each run, from its first to its last event."""
    return (
        events.filter(F.col("table_key").isNotNull())
        .groupBy("run_id", "table_key")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn("seconds", F.round(seconds_between(F.col("first_ts"), F.col("last_ts")), 3))
    )
