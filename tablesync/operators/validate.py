"""Rows that break limits, domains, keys or references."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.skew import join_on_key_set

# Longest text in bytes, largest number.
MAX_TEXT_BYTES = 65535
MAX_NUMBER = 1e15


def validate_rows(
    df: DataFrame,
    keys: list[str],
    max_bytes: int = MAX_TEXT_BYTES,
    max_number: float = MAX_NUMBER,
) -> DataFrame:
    """Every cell over a limit: row key, column, rule and measure. One pass, no shuffle."""
    checks = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            size = F.octet_length(value)
            checks.append(_violation(field.name, "too_long", size.cast("double"), size > max_bytes))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            large = (value > max_number) & ~F.isnan(value)
            checks.append(_violation(field.name, "too_large", value.cast("double"), large))
    if not checks:  # no column has a limit
        nothing = _violation("", "", F.lit(0.0), F.lit(False))
        return df.select(*keys, F.inline(F.array(nothing))).filter(F.lit(False))
    return df.select(*keys, F.inline(F.array(*checks))).filter(F.col("rule").isNotNull())


def _violation(column: str, rule: str, measure: Column, broken: Column) -> Column:
    found = F.struct(
        F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), measure.alias("measure")
    )
    return F.when(broken, found)


def enum_violations(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows with a value outside the list; NULL is allowed."""
    return df.filter(~F.col(column).isin(*allowed))


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of NULLs in each column that must not hold any."""
    sums = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    )
    return sums.select(F.inline(rows)).filter("nulls > 0")


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row; keys with a NULL never collide."""
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
    )


def missing_parents(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """References that lead nowhere, each once.

    Equal references are reduced to one per task before the shuffle, so a
    parent with very many children costs no more than any other.
    """
    referred = child.select(fk).dropna().distinct()
    return referred.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference has no parent; no reference, no orphan."""
    return join_on_key_set(child, missing_parents(child, fk, parent, pk), [fk], "left_semi")


def cascade_delete(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows left when rows go with their parents."""
    return join_on_key_set(child, missing_parents(child, fk, parent, pk), [fk], "left_anti")


def set_null_delete(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """All child rows, with references to missing parents set to NULL."""
    missing = missing_parents(child, fk, parent, pk).withColumn("_missing", F.lit(True))
    return (
        join_on_key_set(child, missing, [fk], "left")
        .withColumn(fk, F.when(F.col("_missing").isNull(), F.col(fk)))
        .select(*child.columns)
    )


def default_from_text(text: str | None, data_type: str, run_ts: datetime) -> Column:
    """The default an inventory states as text: the run time, NULL, or a literal."""
    if text is None or text == "NULL":
        return F.lit(None).cast(data_type)
    if text == "CURRENT_TIMESTAMP":
        text = run_ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast(data_type)


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add the columns the input lacks with their defaults; a present NULL stays NULL."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})
