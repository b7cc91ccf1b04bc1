"""The registered queries: operator calls on the given tables, each with its SQL."""

from workloads import (  # noqa: F401
    access,
    catalog,
    cleaning,
    generated,
    keyed,
    ledger,
    paging,
    reconcile,
    references,
    streams,
)
from workloads.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
