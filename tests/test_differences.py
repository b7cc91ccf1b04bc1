"""Differences of two tables against comparing all rows."""

import random
from collections import defaultdict

import pytest

from tablesync.operators.differences import differing_ranges, row_differences

SCHEMA = "id bigint, k string, v double"


def plain(source, dest, at):
    sides = defaultdict(lambda: ([], []))
    for n, rows in enumerate((source, dest)):
        for row in rows:
            sides[row[at]][n].append(row)
    out = []
    for key, (a, b) in sides.items():
        if sorted(a, key=str) != sorted(b, key=str):
            kind = ("missing" if not b else "extra" if not a else "lost" if len(b) < len(a)
                    else "doubled" if len(b) > len(a) else "changed")
            out.append((key, len(a), len(b), kind))
    return sorted(out, key=str)


@pytest.fixture
def tables():
    rng = random.Random(6)
    source = [(rng.choice([None, n, n * 10**12, -n]), f"k{n % 90}", rng.choice([None, 1.5, float(n)])) for n in range(400)]
    dest = list(source)
    del dest[17], dest[100]
    dest += [source[33], (5, "new", 1.0), (None, "k1", None)]
    dest[200] = (*dest[200][:2], 99.0)
    dest[201] = (dest[201][0], None, dest[201][2])
    rng.shuffle(dest)
    return source, dest


@pytest.mark.parametrize("key,at", [("id", 0), ("k", 1)])
@pytest.mark.parametrize("fan,leaf", [(16, 1), (256, 1), (7, 60)])
def test_rows(spark, tables, key, at, fan, leaf):
    source, dest = (spark.createDataFrame(rows, SCHEMA) for rows in tables)
    got = row_differences(source, dest, [key], fan=fan, leaf_rows=leaf).collect()
    assert sorted(map(tuple, got), key=str) == plain(*tables, at)


def test_each_difference_lies_in_one_range(spark):
    rows = [(n, "x", 1.0) for n in range(0, 10_000, 3)]
    wrong = [r for r in rows if r[0] != 300] + [rows[2000]] + [(7, "y", 1.0)]
    wrong[50] = (wrong[50][0], "changed", 1.0)
    source, dest = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(wrong, SCHEMA)
    got = differing_ranges(source, dest, ["id"], fan=10, leaf_rows=1).collect()
    assert sorted(map(tuple, got)) == [(7, 7, 0, 1), (150, 150, 1, 1), (300, 300, 1, 0), (6000, 6000, 1, 2)]
    coarse = differing_ranges(source, dest, ["id"], fan=10, leaf_rows=10**6).collect()
    assert len(coarse) == 2 and all(r["last"] - r["first"] == 999 for r in coarse)


def test_equal_and_empty_tables(spark, tables):
    source = spark.createDataFrame(tables[0], SCHEMA)
    nothing = spark.createDataFrame([], SCHEMA)
    assert differing_ranges(source, source.repartition(3), ["id"]).collect() == []
    assert row_differences(nothing, nothing, ["id"]).collect() == []
    all_missing = row_differences(source, nothing, ["id"], leaf_rows=1).collect()
    assert {r["kind"] for r in all_missing} == {"missing"}
    assert sum(r["src_rows"] for r in all_missing) == 400
    two = row_differences(source, nothing, ["id", "k"]).collect()
    assert len(two) == len({(r[0], r[1]) for r in tables[0]})
