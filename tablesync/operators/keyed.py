"""Writes by key. A destination version is built anew and never changed in place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.counts import mark_value
from tablesync.operators.paging import keyset_filter
from tablesync.operators.skew import earliest_per_key, join_on_key_set, latest_per_key
from tablesync.session import stage


def replace_into(
    dest: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order_cols: list[str] | None = None,
) -> DataFrame:
    """Destination after replacing by key: rows of the batch win.

    ``order_cols`` say which of several batch rows with one key is the last.
    Leave them out when the batch is unique by key, which saves its shuffle.
    """
    if not keys:
        raise ValueError("replacing rows needs key columns; load the whole table instead")
    if order_cols is None:
        kept = join_on_key_set(dest, batch.select(*keys), keys, "left_anti", write_out=False)
        return kept.unionByName(batch)
    # Written once: its keys are measured and looked up, its rows are added.
    last = stage(latest_per_key(batch, keys, order_cols), "last")
    kept = join_on_key_set(dest, last.select(*keys), keys, "left_anti", write_out=False)
    return kept.unionByName(last)


def last_on_every_key(
    batch: DataFrame, unique_keys: list[list[str]], order_cols: list[str]
) -> DataFrame:
    """The order columns of the rows no later row shares any unique key with.

    Every row gives one narrow row per unique key. The last of each key value
    wins, and a row stays that wins on all of them. A key with a NULL takes
    the row's own order as its value, so nothing collides with it.
    """
    own = F.struct(*order_cols)
    candidates = []
    for number, keys in enumerate(unique_keys):
        values = F.array(*[F.col(k).cast("string") for k in keys])
        alone = F.exists(values, lambda v: v.isNull())
        candidates.append(
            F.struct(
                F.lit(number).alias("key"),
                values.alias("values"),
                F.when(alone, own).alias("alone"),
            )
        )
    narrow = batch.select(*order_cols, F.inline(F.array(*candidates)))
    winners = latest_per_key(narrow, ["key", "values", "alone"], order_cols)
    wins = winners.groupBy(*order_cols).agg(F.count(F.lit(1)).alias("wins"))
    return wins.filter(F.col("wins") == len(unique_keys)).select(*order_cols)


def replace_into_multi_unique(
    dest: DataFrame, batch: DataFrame, unique_keys: list[list[str]], order_cols: list[str]
) -> DataFrame:
    """Destination after replacing row by row under several unique keys.

    A batch row stays when no later batch row shares any of its unique keys;
    a destination row stays when no batch row at all does, also none that was
    itself replaced later. That is what the row-by-row form leaves behind.
    ``order_cols`` must tell all batch rows apart. A key with a NULL never
    collides.
    """
    stay = last_on_every_key(batch, unique_keys, order_cols)
    rows = _by_order(batch, stay, order_cols, "left_semi").select(*dest.columns)
    kept = dest
    for keys in unique_keys:
        used = batch.select(*keys).dropna().distinct()
        kept = join_on_key_set(kept, used, keys, "left_anti")
    return kept.unionByName(rows)


def dropped_by_replace(
    batch: DataFrame, unique_keys: list[list[str]], order_cols: list[str]
) -> DataFrame:
    """Batch rows that a later batch row replaces on some unique key."""
    stay = last_on_every_key(batch, unique_keys, order_cols)
    return _by_order(batch, stay, order_cols, "left_anti").select(*batch.columns)


def _by_order(batch: DataFrame, stay: DataFrame, order_cols: list[str], how: str) -> DataFrame:
    """Join on the order columns, in which a NULL is a value like any other."""
    same = [F.col(f"b.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in order_cols]
    return batch.alias("b").join(stay.alias("s"), reduce(lambda x, y: x & y, same), how)


def insert_ignore(
    batch: DataFrame, keys: list[str], order_cols: list[str], dest: DataFrame | None = None
) -> DataFrame:
    """Rows an ignoring insert would add: the first of each key, none already there."""
    first = earliest_per_key(batch, keys, order_cols)
    if dest is None:
        return first
    there = dest.select(*keys).distinct()
    return first.join(there, keys, "left_anti").select(*batch.columns)


def incremental_rows(source: DataFrame, dest: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows above the destination's mark, all rows when it is empty.

    The mark is one row; as a literal it reaches the scan as a pushed filter.
    """
    return keyset_filter(source, keys, mark_value(dest, keys))


def append_increment(source: DataFrame, dest: DataFrame, keys: list[str]) -> DataFrame:
    """Destination followed by the source rows above its mark."""
    return dest.unionByName(incremental_rows(source, dest, keys).select(*dest.columns))
