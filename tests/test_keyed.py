"""Keyed writes against the row-by-row form."""

import random

import pytest

from tablesync.operators.counts import mark_value
from tablesync.operators.keyed import (
    append_increment,
    dropped_by_replace,
    incremental_rows,
    insert_ignore,
    replace_into,
    replace_into_multi_unique,
)

SCHEMA = "a int, b int, v int, seq int"


def by_row_replace(dest, batch, keys):
    """REPLACE as a server does it: delete every row that collides, then insert."""
    table = list(dest)
    for row in batch:
        table = [
            old for old in table
            if not any(
                all(old[i] is not None and old[i] == row[i] for i in key) for key in keys
            )
        ]
        table.append(row)
    return sorted(table, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_replace_under_two_unique_keys_is_row_by_row(spark, seed):
    rng = random.Random(seed)
    some = lambda: rng.choice([None, *range(6)])
    dest_rows, used_a, used_b = [], set(), set()
    for n in range(8):
        a, b = some(), some()
        if a not in used_a and b not in used_b:
            dest_rows.append((a, b, n, -n - 1))
            used_a |= {a} - {None}
            used_b |= {b} - {None}
    batch_rows = [(some(), some(), 100 + n, n) for n in range(14)]
    dest = spark.createDataFrame(dest_rows, SCHEMA)
    batch = spark.createDataFrame(batch_rows, SCHEMA)
    expected = by_row_replace(dest_rows, batch_rows, [(0,), (1,)])
    found = replace_into_multi_unique(dest, batch, [["a"], ["b"]], ["seq"])
    assert sorted(map(tuple, found.collect()), key=str) == expected
    dropped = dropped_by_replace(batch, [["a"], ["b"]], ["seq"]).count()
    assert dropped == len(batch_rows) - len(by_row_replace([], batch_rows, [(0,), (1,)]))


def test_an_order_column_may_be_null(spark):
    batch = spark.createDataFrame([(1, 1, 100, None), (2, 2, 101, 5), (2, 3, 102, None)], SCHEMA)
    dest = spark.createDataFrame([(9, 9, 0, 0)], SCHEMA)
    found = replace_into_multi_unique(dest, batch, [["a"], ["b"]], ["seq", "v"]).collect()
    assert sorted(r["v"] for r in found) == [0, 100, 101]
    dropped = dropped_by_replace(batch, [["a"], ["b"]], ["seq", "v"]).collect()
    assert [r["v"] for r in dropped] == [102]


def test_replace_composite_key(spark):
    dest_rows = [(1, 1, 10, 0), (1, 2, 11, 0), (2, 1, 12, 0)]
    batch_rows = [(1, 2, 20, 1), (3, 3, 21, 2), (1, 2, 22, 3)]
    dest, batch = (spark.createDataFrame(r, SCHEMA) for r in (dest_rows, batch_rows))
    found = replace_into(dest, batch, ["a", "b"], ["seq"])
    assert sorted(map(tuple, found.collect()), key=str) == by_row_replace(
        dest_rows, batch_rows, [(0, 1)]
    )
    again = replace_into(found, batch, ["a", "b"], ["seq"])
    assert sorted(again.collect()) == sorted(found.collect())


def test_replace_needs_keys(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], SCHEMA)
    with pytest.raises(ValueError):
        replace_into(df, df, [])


def test_insert_ignore_keeps_the_first(spark):
    batch = spark.createDataFrame([(1, 0, 1, 2), (1, 0, 2, 1), (2, 0, 3, 3)], SCHEMA)
    dest = spark.createDataFrame([(2, 9, 9, 9)], SCHEMA)
    assert [r["v"] for r in insert_ignore(batch, ["a"], ["seq"], dest).collect()] == [2]


def test_key_zero_is_a_key(spark):
    source = spark.createDataFrame([(0, 1), (5, 2)], "id bigint, v int")
    only_zero = source.filter("id = 0")
    nothing = source.filter("id < 0")
    assert mark_value(only_zero, ["id"]) == (0,)
    assert mark_value(nothing, ["id"]) is None
    assert [r["id"] for r in incremental_rows(source, only_zero, ["id"]).collect()] == [5]
    assert incremental_rows(source, nothing, ["id"]).count() == 2
    assert append_increment(source, only_zero, ["id"]).count() == 2
