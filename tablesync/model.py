"""The few descriptions of a table that travel outside DataFrames."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """Names one table and its primary key columns in key order."""

    schema: str
    name: str
    keys: tuple[str, ...] = ()

    @property
    def table_key(self) -> str:
        return f"{self.schema}.{self.name}"
