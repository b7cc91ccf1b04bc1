"""Deleted line runs against plain code and SQL."""

import random
import re

import pytest

from tablesync.llm import line_dedup as ld
from tablesync.llm import queries
from tests.compare import differences

SCHEMA = "doc_id bigint, text string, lines string, seq int"


def plain(rows, min_lines, min_words):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        worded = [i for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        gone = set()
        for k in range(len(worded)):
            for size in {1, min_lines}:
                run = tuple(lines[i] for i in worded[k:k + size])
                if len(run) < size:
                    continue
                if run in seen and (size == min_lines or len(run[0].split()) >= min_words):
                    gone.update(range(k, k + size))
                seen.add(run)
        left = [line for i, line in enumerate(lines) if i not in {worded[k] for k in gone}]
        runs = sum(k + 1 not in gone for k in gone)
        out.append((doc, text if not gone else "\n".join(left), len(lines), len(gone), runs))
    return out


def run(docs, **options):
    return sorted((r["row"]["doc_id"], r["kept"], r["n_lines"], r["n_removed"], r["n_runs"])
                  for r in ld.delete_repeated_lines(docs, **options).collect())


@pytest.mark.parametrize("min_lines", [1, 2, 3, 4, 5, 7])
def test_against_plain_code(spark, min_lines):
    rng = random.Random(min_lines)
    pool = ["a", "b b", "c c c", "", "  ", "d d d d", "e\t", "é"]
    rows = [(n, "\n".join(rng.choice(pool) for _ in range(rng.randrange(25)))) for n in range(120)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    assert run(docs, min_lines=min_lines, min_words=4) == sorted(plain(rows, min_lines, 4))


def test_query_equals_sql(spark, sf_dir, duck):
    df = queries.QUERIES["op1_line_dedup"](spark, sf_dir)
    assert differences(df, duck, queries.SQL["op1_line_dedup"]) == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.QUERIES["op1_line_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(spark):
    text = "one line\nanother line\n\nthe end"
    long = "\n".join(f"line {n % 50_000}" for n in range(100_000))
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, "head\n" + text), (4, " \n\n \n"), (9, long),
            (3, "other\none line\nanother line")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = ld.delete_repeated_lines(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["row"]["doc_id"], []).append((r["kept"], r["n_removed"], r["n_runs"]))
    assert by[1] == [(None, 0, 0)] and by[2] == [("", 0, 0)] and by[4] == [(" \n\n \n", 0, 0)]
    assert by[None] == [("head\n", 3, 1)]
    assert by[9][0][1:] == (50_000, 1) and by[9][0][0].count("\n") == 49_999
    # Rows with one id: equal ones get one result; the two texts are in the order of their hashes.
    assert len({r for r in by[3]}) == 2 and sum(n for _, n, _ in set(by[3])) == 2
    assert {r["row"]["lines"] for r in got} == {"x"}
    assert ld.delete_repeated_lines(docs.limit(0)).collect() == []
