"""Removed byte strings against a plain search over all strings."""

import hashlib
import random

import numpy as np
import pytest

from tablesync.llm import queries
from tablesync.llm import suffix_dedup as sd
from tablesync.llm.common import table

SCHEMA = "doc_id bigint, text string, spans string"


def plain(rows, order=None) -> list[tuple]:
    """(id, bytes, removed, spans, digest) for rows in any order."""
    seen, out = {}, []
    for n, (doc, text) in enumerate(sorted(rows, key=order or (lambda r: r[0]))):
        data = (text or "").encode()
        hit = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - 99):
            string = data[i:i + 100]
            if string in seen:
                hit[i] += 1
                hit[i + 100] -= 1
            else:
                seen[string] = n
        covered = np.cumsum(hit)[:-1] > 0
        edges = int((np.diff(np.concatenate([[0], covered.astype(np.int8)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~covered])
        out.append((doc, len(data), int(covered.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, rows, **limits) -> list[tuple]:
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = sd.remove_repeats(docs, limits=sd.Limits(**limits)).collect()
    return sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]),
                   hashlib.sha256(r["kept"]).hexdigest()) for r in got)


def corpus(rng: random.Random, count: int) -> list[tuple[int, str]]:
    """Texts of shared passages of all lengths around the threshold, edits and periods."""
    letters = "abcdé \n"
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([40, 70, 98, 99, 100, 101, 130, 400])))
                for _ in range(12)]
    passages += ["ab" * 90, "x" * 250, "the same words again " * 12]
    rows = []
    for n in range(count):
        parts = []
        for _ in range(rng.randrange(6)):
            part = rng.choice(passages)
            if rng.random() < 0.4:
                a, b = sorted(rng.randrange(len(part) + 1) for _ in range(2))
                part = part[a:b]
            if rng.random() < 0.3 and part:
                at = rng.randrange(len(part))
                part = part[:at] + rng.choice(letters) + part[at + 1:]
            parts += [part, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))]
        rows.append((n, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_against_a_plain_search(spark, seed):
    rows = corpus(random.Random(seed), 150)
    assert run(spark, rows) == sorted(plain(rows))


@pytest.mark.parametrize("limits", [
    {"group_rows": 3}, {"buffer_bytes": 300}, {"name_contents": 2}, {"side_rows": 1, "remembered": 8},
    {"buffer_bytes": 2000, "name_buffers": 1, "name_contents": 2, "side_rows": 2},
    {"buffer_bytes": 700, "name_buffers": 2, "side_rows": 2, "group_rows": 5, "remembered": 20},
], ids=str)
def test_common_names_are_dealt_out(spark, limits):
    rows = corpus(random.Random(11), 120)
    rows += [(n, f"{n} start " + "the very common line of this corpus, as ever " * 2 + f"{n} {n * n} end" * 9)
             for n in range(200, 300)]
    assert run(spark, rows, **limits) == sorted(plain(rows))


def notices(rng, count: int, notice: str) -> list[tuple[int, str]]:
    """Texts that have nothing in common but a notice."""
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    return [(n, letters(150) + notice + letters(150)) for n in range(count)]


@pytest.mark.parametrize("size", [98, 100, 140])
def test_a_name_in_every_buffer_sends_few_rows_to_its_place(size):
    rows = notices(random.Random(size), 2000, "".join(random.Random(5).choice("01234567 ") for _ in range(size)))
    batch = sd.pa.RecordBatch.from_pydict({"oid": [r[0] for r in rows], "key": [r[0] * 7 for r in rows],
                                           "text": [r[1] for r in rows]})
    most = {}
    for texts in (500, 2000):
        places = {}
        for out in sd._mark_documents(iter([batch.slice(0, texts)]), sd.Limits(buffer_bytes=4096)):
            for name in out.column("name").to_pylist():
                places[name] = places.get(name, 0) + 1
        most[texts] = max(places.values())
    assert most[500] < 60 and most[2000] < 60


def test_sides_of_a_common_name_send_few_rows_to_its_place():
    rows = notices(random.Random(3), 1000, "".join(random.Random(6).choice("01234567 ") for _ in range(140)))
    marked = [sd.stretches([text.encode()]) for _, text in rows]
    places = [sd._pack(m["place"], m["far"], m["near"]).tolist() for m in marked]
    batch = sd.pa.RecordBatch.from_pydict({
        "oid": [r[0] for r in rows], "key": [r[0] * 7 for r in rows], "places": places,
        "text": [sd.zstandard.ZstdCompressor().compress(r[1].encode()) for r in rows]})
    counts = {}
    for out in sd._sides(iter([batch]), sd.Limits(side_rows=10)):
        for name, kind in zip(out.column("name").to_pylist(), out.column("kind").to_pylist()):
            if kind != sd.RUN:
                counts[name] = counts.get(name, 0) + 1
    assert max(counts.values()) <= 11


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = [tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
           for r in queries.QUERIES["op6_suffix_dedup"](spark, sf_dir).collect()]
    wanted = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(got) == sorted(wanted)
    assert sum(r[2] for r in wanted) > 1000


def test_sorting_out_does_not_depend_on_batches():
    rng = np.random.default_rng(3)
    rows = sorted({tuple(rng.integers(0, 4, 5).tolist()) for _ in range(300)})
    names = ("name", "content", "oid", "key", "packed")

    def run_with(step):
        batches = [
            sd.pa.RecordBatch.from_pydict({n: [r[k] for r in rows[i:i + step]] for k, n in enumerate(names)}
                                          | {"kind": [sd.OPEN] * len(rows[i:i + step])})
            for i in range(0, len(rows), step)]
        return sorted(tuple(r.values()) for b in sd._sort_out(iter(batches)) for r in b.to_pylist())

    first = {}
    for r in rows:
        first.setdefault(r[:2], r)
    shared = {n for n, _ in first if sum(m == n for m, _ in first) > 1}
    wanted = sorted([(*r[2:], True) for r in rows if r != first[r[:2]]]
                    + [(*r[2:], False) for r in first.values() if r[0] in shared])
    for step in (1, 2, 7, 1000):
        assert run_with(step) == wanted


def test_odd_rows(spark):
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(5, passage), (5, passage), (2, None), (3, ""), (4, "short"), (None, passage + " end"),
            (7, passage * 3)]
    got = run(spark, [r for r in rows if r[0] is not None])
    assert [r[2] for r in got if r[0] == 5] == [0, 0]
    assert [r[1:4] for r in got if r[0] in (2, 3, 4)] == [(0, 0, 0), (0, 0, 0), (5, 0, 0)]
    assert [r[2:4] for r in got if r[0] == 7] == [(900, 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    last = [r for r in sd.remove_repeats(docs).collect() if r["doc_id"] is None]
    assert [bytes(r["kept"]) for r in last] == [b" end"]
    assert sd.remove_repeats(docs.limit(0)).collect() == []
    long = [(1, "z" * 4_000_000), (2, "y" + "z" * 100)]
    assert [r[2] for r in run(spark, long)] == [3_999_999, 100]
