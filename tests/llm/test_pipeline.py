"""The pipeline, stage by stage, against plain code on the same rows."""

import re
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline as cp
from tablesync.llm.common import stage, table
from tests.llm import test_decontaminate, test_line_dedup, test_packing, test_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """The rows before and after every stage."""
    docs = table(spark, sf_dir, "documents")
    out = [[r.asDict() for r in docs.collect()]]
    for name, function in cp.STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
        out.append([r.asDict() for r in docs.collect()])
    return out


def test_stages_keep_the_columns(kept):
    for rows in kept[:-1]:
        assert rows and list(rows[0]) == COLUMNS
    for rows in kept[2:-1]:
        assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_quality_rejects_by_score(spark, sf_dir, kept):
    scores = {r["doc_id"]: r["predicted"] for r in
              entry_module.queries()["op4_compression_quality"](spark, sf_dir).collect()}
    assert {r["doc_id"] for r in kept[1]} == {n for n, p in scores.items() if p}
    assert 0.5 * len(kept[0]) < len(kept[1]) < len(kept[0])


def test_lines_near_duplicates_and_benchmark(spark, sf_dir, kept):
    texts = [{r["doc_id"]: r["text"] for r in rows} for rows in kept[:-1]]
    wanted = {r[0]: r[1] for r in test_line_dedup.plain(list(texts[1].items()), 2, 20)}
    changed = {n for n, t in wanted.items() if t != texts[1][n]}
    assert texts[2] == {n: t for n, t in wanted.items() if n not in changed or re.search(r"\w", t)}
    prints = {n: test_simhash.plain_fingerprint(t) for n, t in texts[2].items()}
    assert set(texts[3]) == set(test_simhash.plain_components(prints).values())
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    hits = {n: hit for n, _, hit, _ in test_decontaminate.plain(list(texts[3].items()), items)}
    assert sum(map(bool, hits.values()))
    assert not any(hit for _, _, hit, _ in test_decontaminate.plain(list(texts[4].items()), items))
    assert {n: t for n, t in texts[3].items() if not hits[n]} == {
        n: t for n, t in texts[4].items() if not hits[n]}


def test_packing_holds_every_id(kept):
    wanted = {r["doc_id"]: test_packing.ids_of(r["text"]) + [1] for r in kept[4]}
    parts = defaultdict(dict)
    for r in kept[5]:
        parts[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
    assert {n: sum((p[k] for k in sorted(p)), []) for n, p in parts.items()} == wanted


def test_run_gives_the_last_stage(spark, sf_dir, kept):
    got = entry_module.queries()["pipeline"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in got) == sorted(
        (r["doc_id"], r["start"], r["ids_crc32"]) for r in kept[5])


def test_cut_documents_stay_while_a_word_is_left(spark, sf_dir):
    """Capitals, digits, underscores and letters beyond ASCII are words; marks alone are none."""
    left = {2: "CHAPTER IV: THE ROAD", 3: "* 7 *", 4: "\u00c4", 5: "__", 6: "-- [!] ^ ` ~"}
    stays = {n: text for n, text in left.items() if n != 6}
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    again = "one line that comes again\nand another one below"
    docs = spark.createDataFrame(
        [(1, again, "en", "s", 0), *((n, f"{text}\n{again}", "en", "s", 0) for n, text in left.items())], kind)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cp.lines(spark, docs, sf_dir).collect()}
    assert got == {1: (again, len(again))} | {n: (text, len(text)) for n, text in stays.items()}
    item = max((r["text"] for r in table(spark, sf_dir, "benchmark").collect()), key=lambda t: len(t or ""))
    docs = spark.createDataFrame([(n, f"{text} {item}", "en", "s", 0) for n, text in left.items()], kind)
    got = {r["doc_id"]: r["text"].strip(" .?!") for r in cp.benchmark(spark, docs, sf_dir).collect()}
    assert got == stays


def test_odd_rows(spark, sf_dir):
    rows = [(1, None, "en", None, None, 1), (None, "", None, "s", 0, 1), (2, "a b " * 40, None, None, 5, 1),
            (2, "a b " * 40, None, None, 5, 2), (None, "c d e " * 30, "en", "s", 1, 3)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row int")
    for frame in (docs, docs.limit(0)):
        for name, function in cp.STAGES[1:-1]:
            out = function(spark, frame, sf_dir)
            assert out.columns == docs.columns
            assert len(out.collect()) <= len(rows)
    assert len(cp.near_duplicates(spark, docs, sf_dir).collect()) == 3
    assert cp.quality(spark, docs, sf_dir).columns == docs.columns
