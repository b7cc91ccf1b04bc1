"""What the events of a table add up to, as keyed state of the streaming engine."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tablesync.operators.ledger import RUN_TABLE

_COUNTS = {"starts": ("start",), "completes": ("complete",), "errors": ("error",)}
# The latest event of each kind, and the value that is taken from it.
_LATEST = {
    "last_start": (("start",), None, None),
    "last_complete": (("complete",), "complete_text", "message"),
    "last_error": (("error",), "error_text", "message"),
    "last_move": (("progress", "error"), "moved_id", "last_id"),
    "last_progress": (("progress",), "progress_rows", "processed_rows"),
    "last_counted": (("start", "recount"), "counted_rows", "total_rows"),
}
_TEXTS = {"complete_text", "error_text"}
_VALUES = [value for _, value, _ in _LATEST.values() if value]
FIELDS = ["epoch", *_COUNTS, "first_start", *_LATEST, *_VALUES]
_STATE = ", ".join(f"{name} {'string' if name in _TEXTS else 'bigint'}" for name in FIELDS)
FOLD_SCHEMA = f"run_id string, table_key string, {_STATE}"
# Rows travel to Python and back as one JSON text each: a group costs a data frame per column, and
# whole numbers with a NULL beside them would become floating-point numbers.
_NUMBERS = ["event_id", "total_rows", "last_id", "processed_rows"]


def add_events(folded: dict | None, rows: Iterator[dict]) -> dict:
    """A table's fold with further events; without one a fresh fold, named by its first event."""
    for row in rows:
        op, event = row["op"], int(row["event_id"])
        if folded is None:
            folded = dict.fromkeys(FIELDS) | dict.fromkeys(_COUNTS, 0) | {"epoch": event}
        for name, ops in _COUNTS.items():
            folded[name] += op in ops
        if op == "start" and (folded["first_start"] is None or event < folded["first_start"]):
            folded["first_start"] = event
        for latest, (ops, value, column) in _LATEST.items():
            if op not in ops or (folded[latest] is not None and event <= folded[latest]):
                continue
            folded[latest] = event
            if value:
                given = row[column]
                if column in _NUMBERS:
                    given = None if given is None else int(given)
                # A value that the latest event does not give is unknown, not the one before.
                folded[value] = given
    return folded


def is_done(folded: dict) -> bool:
    """Whether the table is completed after its last start."""
    started, completed = folded["last_start"], folded["last_complete"]
    return started is not None and completed is not None and completed > started


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    folded = dict(zip(FIELDS, state.get)) if state.exists else None
    for frame in frames:
        folded = add_events(folded, iter(json.loads(f"[{','.join(frame['event'])}]")))
    if is_done(folded):
        if state.exists:
            state.remove()
    else:
        state.update(tuple(folded[name] for name in FIELDS))
    row = {"run_id": key[0], "table_key": key[1]} | folded
    yield pd.DataFrame({"fold": [json.dumps(row)]})


def advancing(events: DataFrame) -> DataFrame:
    """A row for every table that a micro-batch changes: its fold since it was last completed.

    ``epoch`` tells the folds of one table apart. State is kept for tables that
    are not completed only. Events without a table are of no table.
    """
    event = F.to_json(F.struct("op", "message", *_NUMBERS), {"ignoreNullFields": "false"})
    plain = events.filter(F.col("table_key").isNotNull()).select(*RUN_TABLE, event.alias("event"))
    folds = plain.groupBy(*RUN_TABLE).applyInPandasWithState(
        _advance, "fold string", _STATE, "update", GroupStateTimeout.NoTimeout
    )
    return folds.select(F.inline(F.array(F.from_json("fold", FOLD_SCHEMA))))
