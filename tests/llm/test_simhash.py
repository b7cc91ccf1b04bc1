"""Fingerprints and components against plain code over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tablesync.llm import simhash
from tablesync.llm.common import table
from tablesync.llm.graph import components


def plain_fingerprint(text: str | None) -> int:
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in data.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ")
             .replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict, radius: int = 4) -> dict:
    names = sorted(prints)
    values = np.array([prints[n] for n in names], np.uint64)
    comp = list(range(len(names)))

    def root(i):
        while comp[i] != i:
            comp[i] = comp[comp[i]]
            i = comp[i]
        return i

    for i in range(len(names)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius):
            a, b = sorted((root(i), root(int(j))))
            comp[b] = a
    return {n: names[root(i)] for i, n in enumerate(names)}


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    wanted = plain_components(prints)
    assert {n: r["fingerprint"] for n, r in got.items()} == {n: f"{p:016x}" for n, p in prints.items()}
    assert {n: r["component_id"] for n, r in got.items()} == wanted
    assert len(set(wanted.values())) < len(wanted)


def chains(rng: random.Random, count: int) -> list[int]:
    """Fingerprints in chains and clusters of a few flipped bits."""
    out = []
    while len(out) < count:
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 40])):
            out.append(value)
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                value ^= 1 << bit
    return sorted(set(out))


@pytest.mark.parametrize("blocks,bucket_rows", [(5, 1 << 16), (6, 1 << 16), (6, 8), (8, 5)])
def test_links_tie_all_near_pairs(spark, blocks, bucket_rows):
    values = chains(random.Random(blocks), 1500)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(rows, "fingerprint bigint")
    links = simhash.near_links(distinct, blocks=blocks, bucket_rows=bucket_rows, buffer_rows=300)
    wanted = plain_components({v: v for v in values})
    group: dict = {}
    for r in components(links).collect():
        group.setdefault(r["root"], set()).add(r["node"] % (1 << 64))
    classes: dict = {}
    for v, first in wanted.items():
        classes.setdefault(first, set()).add(v)
    assert sorted(map(sorted, group.values())) == sorted(
        sorted(c) for c in classes.values() if len(c) > 1)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7, 8])
def test_bit_sliced_distances(radius):
    rng = random.Random(radius)
    values = np.array(chains(rng, 400), np.uint64)
    rng.shuffle(values)
    ends = np.full(len(values), len(values))
    a, b = simhash.link_groups(values, ends, radius, words=100)
    wanted = plain_components({int(v): int(v) for v in values}, radius)
    size = len(values) - len(set(wanted.values()))
    assert len(a) == size
    assert all(wanted[int(x)] == wanted[int(y)] for x, y in zip(a, b))


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(300)] + [(1000, 1000), (None, 5)]
    random.Random(1).shuffle(path)
    got = components(spark.createDataFrame(path, "a bigint, b bigint")).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0) for i in range(301)]


def test_odd_rows(spark):
    long = "alpha beta gamma " * 100_000
    rows = [(5, None, "a"), (6, "", "a"), (7, " \n ", "a"), (8, long, "b"), (8, long, "b"),
            (None, long, "c"), (None, "one word here", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string")
    got = sorted(simhash.near_duplicates(docs).collect(), key=str)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert len(got) == 7
    assert by[5] == by[6] == by[7] == {("0" * 16, 5)}
    assert len(by[8]) == 1 and {c for _, c in by[8]} == {8}
    assert {c for _, c in by[None]} == {8, None}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
