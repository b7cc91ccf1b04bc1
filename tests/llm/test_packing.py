"""Packing: ids as the tokenizer gives them, every id once, little padding."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablesync.llm.common import table
from tablesync.llm.packing import (
    Encoder,
    OpenWindows,
    added_tokens,
    best_fit,
    pack_documents,
    split_at_powers,
)

os.environ["TOKENIZERS_PARALLELISM"] = "false"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
JSON = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(JSON)
ENCODER = Encoder(RANKS, PATTERN, added=added_tokens(JSON))


def ids_of(text: str) -> list[int]:
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(
    st.text(st.sampled_from("ab's re.\n\t  1é　\x85\x1c <|endoftext|>"), max_size=40),
    st.text(max_size=30),
))
def test_ids_equal_the_tokenizers(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids_of(text)


END = "<|endoftext|>"


@pytest.mark.parametrize("text", [
    END, f"x{END}", f" {END} {END}{END}\n", f"<|endoftext|{END}>", "\n" * 1_000_000, " " * 1_000_000 + "x",
    f"a {' ' * 5000}b{' ' * 4096}", " \t" * 500_000 + END + "\n" * 4097 + "c", "\u3000\x85 " * 3000 + "\x1c" * 9000,
    "a" + "\r\n" * 300_000 + "'s", "!" * 200_000 + " " + "9" * 200_000,
])
def test_added_tokens_and_long_runs(text):
    assert added_tokens(JSON) == {END: 50256}
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids_of(text)


def pack(docs, **options):
    return pack_documents(
        docs, ranks_path=RANKS, pattern=PATTERN, tokenizer_path=JSON, **options
    ).collect()


def check(rows, wanted: dict, window: int):
    """Every id lies once in its place; sequences are gapless and fit."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] == len(r["ids"]) // 4 > 0
        assert r["doc_tokens"] == len(wanted[r["doc_id"]])
    for doc, ids in wanted.items():
        at = 0
        for start, piece in sorted(parts[doc]):
            assert start == at and ids[at:at + len(piece)] == piece
            at += len(piece)
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, sum(map(len, wanted.values()))


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wanted = {r["doc_id"]: ids_of(r["text"] or "") + [1] for r in docs.collect()}
    padding, total = check(pack(docs), wanted, 2048)
    assert padding < 0.01 * total
    padding, total = check(pack(docs, block_tokens=20_000), wanted, 2048)
    assert padding < 0.08 * total


def test_odd_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "x" * 300_000 + " y" * 5000, 7), (4, "  a \n b ", 7),
            (5, f"x{END}y", 7), (6, "\n" * 1_000_000 + END, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, offset int")
    wanted = {n: ids_of(text or "") + [1] for n, text, _ in rows}
    check(pack(docs, window=64), wanted, 64)
    assert pack(docs.limit(0)) == []
    twice = pack(spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id bigint, text string"))
    assert {r["doc_id"] for r in twice} == {None} and {r["doc_tokens"] for r in twice} == {3}
    assert sum(r["length"] for r in twice) == 6


def test_the_query_finds_added_tokens(spark, tmp_path):
    """Through the registered query and the last stage of the pipeline."""
    import corpus_pipeline
    from tablesync.llm.queries import QUERIES

    rows = [(1, f"a{END}b", "en", "s", 1), (2, "\n" * 1_000_000 + "x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    wanted = {n: ids_of(text) + [1] for n, text, *_ in rows}
    assert 50256 in wanted[1] and len(wanted[2]) > 1000
    check(corpus_pipeline.pack(spark, docs, "").collect(), wanted, 2048)
    got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"])
           for r in QUERIES["op3_packing"](spark, str(tmp_path)).collect()}
    for (doc, start), (length, crc) in got.items():
        assert crc == zlib.crc32(np.array(wanted[doc][start:start + length], "<u4").tobytes())


def test_best_fit_against_a_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 60))]
        room, windows = [], []
        for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
            fits = [r for r in room if r >= lengths[piece]]
            if fits:
                at = room.index(min(fits))
                room[at] -= lengths[piece]
            else:
                room.append(40 - lengths[piece])
        windows = best_fit(np.array(lengths), 40)
        assert sorted(p for w in windows for p in w) == list(range(len(lengths)))
        assert sorted(40 - sum(lengths[p] for p in w) for w in windows) == sorted(room)


def test_tree_finds_nothing_when_empty():
    tree = OpenWindows(2048)
    assert tree.tightest(1) is None
    tree.put(2047, 3)
    assert tree.tightest(2048) is None
    assert tree.tightest(5) == (2047, 3)
    assert tree.tightest(1) is None


@pytest.mark.parametrize("sizes", [[1], [3], [700, 300, 24], [5, 1, 1], [1024]])
def test_powers(sizes):
    parts = split_at_powers(sizes)
    totals = [sum(count for *_, count in part) for part in parts]
    assert sum(totals) == sum(sizes) and all(t & (t - 1) == 0 for t in totals)
