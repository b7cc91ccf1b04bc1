"""Licence scan against edit distances by brute force."""

import random

from tablesync.llm.common import table
from tablesync.llm.license_scan import NOTICES, PHRASES, pieces, scan_licenses


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(words: str, edits: int, rng: random.Random) -> str:
    text = list(words)
    for _ in range(edits):
        at = rng.randrange(1, len(text) - 1)
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("qxz")
        elif kind == 1:
            text.insert(at, rng.choice("qxz"))
        else:
            del text[at]
    return "".join(text)


def run(spark, rows, schema="doc_id bigint, text string"):
    return {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, schema)).collect()}


def test_pieces_make_up_the_notice():
    for notice in NOTICES:
        for edits in range(4):
            assert "".join(p for _, p in pieces(notice.words, edits)) == notice.words


def test_phrases_against_plain_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    seen = 0
    for row in docs.collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"] or "")
        words = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text).split(" ")
        words = [w for w in words if w]
        at = [(i, label) for phrase, label in PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[row["doc_id"]]
        seen += len(at)
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert (r["first_word"], r["last_word"]) == (
            min((i for i, _ in at), default=None), max((i for i, _ in at), default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert seen


def test_edited_notices_are_found_within_the_bound(spark):
    rng = random.Random(3)
    rows, wanted = [], {}
    for n in range(400):
        notice = rng.choice(NOTICES)
        text = edited(notice.words, rng.randrange(5), rng)
        allowed = len(notice.words) // 10
        words = f"alpha beta {text} gamma".split()
        rows.append((n, " ".join(words)))
        tried = [" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        wanted[n] = any(
            distance(t, notice.words) <= allowed and set(notice.keys) <= set(t.split()) for t in tried
        ), notice.label
    got = run(spark, rows)
    for n, (found, label) in wanted.items():
        if found:
            assert label in got[n]["labels"].split(","), rows[n]
        else:
            assert all(s["errors"] <= 5 for s in got[n]["spans"])
    assert 100 < sum(found for found, _ in wanted.values()) < 400


def test_neighbouring_licences_are_told_apart(spark):
    got = run(spark, [(1, "Apache License, Version 1"), (2, "under the BSD license"),
                      (3, "licensed under CC BY-SA"), (4, "under the MIT licence")])
    assert [got[n]["labels"] for n in (1, 2, 3, 4)] == ["", "", "", "mit"]
    assert got[4]["base_labels"] == "" and 0.9 < got[4]["score"] < 1


def test_odd_rows(spark):
    long = "word " * 200_000 + "under the MIT License " * 2000
    rows = [(1, None, 0), (2, "", 0), (None, "CC BY-NC", 1), (3, long, 2), (3, long, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, labels int")
    got = scan_licenses(docs).collect()
    assert len(got) == 5
    by = {r["doc_id"]: r for r in got}
    for n in (1, 2):
        assert by[n][1:] == (0, 0, None, None, "", "", 0.0, [])
    assert by[None]["labels"] == "cc-by-nc"
    assert (by[3]["n_base"], by[3]["first_word"]) == (2000, 200_000)
    assert by[3]["last_word"] == 200_000 + 4 * 1999
    assert scan_licenses(docs.limit(0)).collect() == []
