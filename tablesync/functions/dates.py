"""Rules for the invalid dates a MySQL server may hand out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no date", and what replaces them.
INVALID_DATETIME_PREFIXES = ("0000-00-00", "1000-01-01 00:00:00")
INVALID_DATE = "1000-01-01"
FALLBACK_DATETIME = "1970-01-01 00:00:01"
FALLBACK_DATE = "1970-01-01"
FIRST_VALID_TIME = "1000-01-01 00:00:00"

# Parts of column names that mark creation and change times.
CREATED_PARTS = ("created_at", "createdat", "created", "date_created", "creation_date")
UPDATED_PARTS = (
    "updated_at",
    "updatedat",
    "updated",
    "date_updated",
    "modification_date",
    "last_modified",
)


def is_tracked(column_name: str) -> bool:
    """Whether a column holds a creation or change time, judged by its name."""
    name = column_name.lower()
    return any(part in name for part in CREATED_PARTS + UPDATED_PARTS)


def name_has_any(name: Column, parts: tuple[str, ...]) -> Column:
    """Case-folded test for any of ``parts`` inside a name."""
    return F.lower(name).rlike("|".join(parts))


def column_role(name: Column) -> Column:
    """``created``, ``updated`` or ``other`` for a column of column names."""
    return (
        F.when(name_has_any(name, CREATED_PARTS), "created")
        .when(name_has_any(name, UPDATED_PARTS), "updated")
        .otherwise("other")
    )


def bad_datetime_text(value: Column) -> Column:
    test = F.lit(False)
    for prefix in INVALID_DATETIME_PREFIXES:
        test = test | value.startswith(prefix)
    return test


def clean_text_date(value: Column, tracked: bool, run_ts: datetime) -> Column:
    """Replace date texts that mean "no date"; other texts and NULL stay."""
    datetime_text = run_ts.strftime("%Y-%m-%d %H:%M:%S") if tracked else FALLBACK_DATETIME
    date_text = run_ts.strftime("%Y-%m-%d") if tracked else FALLBACK_DATE
    return (
        F.when(bad_datetime_text(value), F.lit(datetime_text))
        .when(value == INVALID_DATE, F.lit(date_text))
        .otherwise(value)
    )


def clean_timestamp(value: Column, data_type: str, run_ts: datetime) -> Column:
    """Timestamps and dates before year 1000 become the run time, whatever the column."""
    first = F.lit(FIRST_VALID_TIME).cast("timestamp_ntz").cast(data_type)
    now = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").cast(data_type)
    return F.when(value < first, now).otherwise(value)


def clean_bytes(value: Column, tracked: bool, run_ts: datetime) -> Column:
    """Byte cells become text with the same bytes and then follow the text rule."""
    return clean_text_date(value.cast("string"), tracked, run_ts)
