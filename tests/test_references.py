"""Deletions through chains, cycles and self-references against row-by-row code."""

import random

import pytest

from tablesync.operators.references import SET_NULL, Reference, dead_values, delete_through

NODE = "id bigint, parent bigint, note string"


def plain(tables: dict, references, deleted: dict) -> dict:
    """Rows as dicts; rounds over everything until nothing changes."""
    left = {n: [dict(r) for r in rows if not any(r[c] in v for (t, c), v in deleted.items() if t == n)]
            for n, rows in tables.items()}
    while True:
        changed = False
        for ref in references:
            there = {r[ref.pk] for r in left[ref.parent]}
            kept = []
            for row in left[ref.child]:
                if row[ref.fk] is not None and row[ref.fk] not in there:
                    changed = True
                    if ref.action == SET_NULL:
                        kept.append(row | {ref.fk: None})
                else:
                    kept.append(row)
            left[ref.child] = kept
        if not changed:
            return left


def run(spark, tables, kinds, references, deleted):
    frames = {n: spark.createDataFrame([tuple(r.values()) for r in rows], kinds[n]) for n, rows in tables.items()}
    gone = {t: spark.createDataFrame([(v,) for v in values], "v bigint") for t, values in deleted.items()}
    return {n: sorted((tuple(r) for r in df.collect()), key=str)
            for n, df in delete_through(frames, references, gone).items()}


def wanted(*args):
    return {n: sorted((tuple(r.values()) for r in rows), key=str) for n, rows in plain(*args).items()}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    pick = lambda top: rng.choice([None, *range(top)])
    tables = {
        "a": [{"id": n, "b": pick(30)} for n in range(25)],
        "b": [{"id": n, "a": pick(27), "up": pick(20)} for n in range(20)],
        "c": [{"k": n % 7, "a": pick(30), "b": pick(22)} for n in range(60)],
    }
    kinds = {"a": "id bigint, b bigint", "b": "id bigint, a bigint, up bigint", "c": "k bigint, a bigint, b bigint"}
    references = [
        Reference("a", "b", "b", "id", SET_NULL if seed else "cascade"), Reference("b", "a", "a", "id"),
        Reference("b", "up", "b", "id"), Reference("c", "a", "a", "id"), Reference("c", "b", "b", "id", SET_NULL),
    ]
    deleted = {("a", "id"): [3, 4], ("b", "id"): [1, None]} if seed < 2 else {}
    gone = {t: [v for v in values if v is not None] for t, values in deleted.items()}
    assert run(spark, tables, kinds, references, deleted) == wanted(tables, references, gone)


def test_a_chain_in_one_table_and_a_cycle(spark):
    chain = {"n": [{"id": n, "parent": n - 1 if n else None, "note": "x"} for n in range(12)]}
    up = [Reference("n", "parent", "n", "id")]
    assert run(spark, chain, {"n": NODE}, up, {("n", "id"): [5]}) == {"n": [(n, n - 1 if n else None, "x") for n in range(5)]}
    ring = {"n": [{"id": n, "parent": (n + 1) % 4, "note": "x"} for n in range(4)]}
    assert run(spark, ring, {"n": NODE}, up, {}) == {"n": [(n, (n + 1) % 4, "x") for n in range(4)]}
    assert run(spark, ring, {"n": NODE}, up, {("n", "id"): [2]}) == {"n": []}


def test_empty_tables_and_no_references(spark):
    empty = {"n": spark.createDataFrame([], NODE)}
    up = [Reference("n", "parent", "n", "id")]
    assert delete_through(empty, up)["n"].collect() == []
    assert dead_values(empty, up)[("n", "id")].collect() == []
    assert delete_through(empty, [])["n"] is empty["n"]
