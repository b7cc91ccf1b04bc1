"""Rows brought into the form that a table's record asks for."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.validate import default_from_text
from tablesync.sources.records import ColumnRule, TableRecord


def conform_rows(df: DataFrame, record: TableRecord, run_ts: datetime) -> DataFrame:
    """The rows with the table's columns in its order, as an insert with named columns gives them.

    A column that the rows lack gets its default, or NULL. A NULL in a column
    that takes none fails the job that writes the rows and names the column;
    this is a projection and costs no pass of its own. Columns that the table
    does not have, and left-out columns without NULL and default, are refused
    at once. A present NULL stays NULL, it does not become the default. Types
    are left as they are.
    """
    names = {c.lower(): c for c in df.columns}
    wanted = {c.name.lower() for c in record.columns}
    unknown = [c for c in df.columns if c.lower() not in wanted]
    if unknown:
        raise ValueError(f"columns the table does not have: {', '.join(unknown)}")
    bare = [c.name for c in record.columns if c.name.lower() not in names and not c.may_be_left_out]
    if bare:
        raise ValueError(f"columns without a default are left out: {', '.join(bare)}")
    return df.select(*[
        _not_null(rule, F.col(f"`{names[rule.name.lower()].replace('`', '``')}`"))
        if rule.name.lower() in names
        else default_from_text(rule.default_text, rule.type, run_ts).alias(rule.name)
        for rule in record.columns
    ])


def _not_null(rule: ColumnRule, value: Column) -> Column:
    if rule.nullable:
        return value.alias(rule.name)
    refused = F.raise_error(F.lit(f"column {rule.name} must not be NULL"))
    return F.when(value.isNull(), refused).otherwise(value).alias(rule.name)
