"""Registration of queries, and inputs shared by Spark and the checking SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.sources.tables import scan_table
from workloads.fixtures import FIXTURES, TABLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_NAME = re.compile(r"\{(\w+)\}")


class Inputs:
    """The given tables and the frames derived from them, by name."""

    # Schemas by path, so that a table's footer is read once and not per query.
    _schemas: dict[str, T.StructType] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._table(name) if name in TABLES else self._derived(name)
        return self._frames[name]

    def _table(self, name: str) -> DataFrame:
        path = self.path(name)
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return scan_table(self.spark, path, schema=self._schemas[path])

    def _derived(self, name: str) -> DataFrame:
        text = FIXTURES[name]
        return self.spark.sql(text, **{used: self[used] for used in set(_NAME.findall(text))})


def oracle(text: str) -> str:
    """SQL with every ``{name}`` resolved: a table as is, a fixture as a CTE."""
    ctes: dict[str, str] = {}

    def resolve(sql: str) -> str:
        for name in dict.fromkeys(_NAME.findall(sql)):
            if name not in TABLES and name not in ctes:
                ctes[name] = resolve(FIXTURES[name])
        return _NAME.sub(r"\1", sql)

    body = resolve(text)
    if not ctes:
        return body
    heads = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes.items())
    return f"WITH {heads}\n{body}"


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` under ``name`` together with its SQL."""

    def register(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            SQL[name] = oracle(sql)
        return fn

    return register
