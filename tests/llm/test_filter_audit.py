"""The byte transducer and the filter audit against plain code."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesync.llm import filter_audit, transducer

DOCS = "doc_id bigint, text string, source string"
LABELS = "doc_id bigint, quality int, toxic int"


def plain_counts(text: bytes) -> list[int]:
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall(rb"[A-Z]", text)), len(text.decode()),
            len(re.findall(rb"[#$%&*|]", text))]


PIECES = ["a", "b", "A", "é", "漢", "😀", " ", "  ", "\n", "\t", "\x0b", "#", "|", "\x85", "\x00", "longerword",
          "longerwordlongerword1", "longerwordlongerword2"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=80).map("".join),
), max_size=8))
def test_counts(texts):
    data = [t.encode("utf-8", "ignore") for t in texts]
    assert transducer.count_texts(data).tolist() == [plain_counts(t) for t in data]


@pytest.mark.parametrize("text", [
    b"x" * 3_000_000, b"ab " * 700_000 + b"Q" * 1_500_000 + b" z z \n", "é".encode() * 800_000,
    b" " * 2_000_000, (b"w" * 600 + b"1 " + b"w" * 600 + b"2 ") * 2000, b"\xf0\x9f\x98\x80 " * 300_000,
])
def test_long_texts(text):
    assert transducer.count_texts([b"a", text, b"b b"]).tolist() == [
        [1, 1, 0, 1, 0], plain_counts(text), [2, 1, 0, 3, 0]
    ]


def test_broken_characters_count_once():
    # A lead byte counts, a continuation byte only where nothing waits for it.
    assert transducer.count_texts([b"\xc3", b"\xa9\xa9", b"\xe6a", b"\xc3\xa9\xa9"])[:, 3].tolist() == [1, 2, 2, 2]


def test_equal_hashes_do_not_make_equal_words():
    data = b"one two one six onetwolongword onetwolongwerd one"
    buffer = np.frombuffer(data, np.uint8)
    spans = [m.span() for m in re.finditer(rb"\S+", data)]
    starts, ends = (np.array(c) for c in zip(*spans))
    for owners in (np.zeros(7, np.int64), np.array([0, 0, 1, 1, 1, 1, 1])):
        got = transducer.first_spans(buffer, starts, ends, owners, np.zeros(7, np.uint64))
        seen, wanted = set(), []
        for (a, b), owner in zip(spans, owners.tolist()):
            wanted.append((owner, data[a:b]) not in seen)
            seen.add((owner, data[a:b]))
        assert got.tolist() == wanted


def plain_audit(docs: list, labels: list) -> set:
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    judged = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(i is not None and j is not None and j < i and (t or "") == text for j, t, _ in docs)
        judged.append((source or "", i, {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None, "E": smaller,
        }))
    out = []
    for part in {p for p, *_ in judged}:
        rows, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [(i, f) for p, i, f in judged if p == part]
            went = []
            for step, name in enumerate(order, 1):
                gone = [d for d in left if d[1][name]]
                redundant = sum(f[name] for _, f in went)
                left = [d for d in left if not d[1][name]]
                went += gone
                alone = sum(f[name] and sum(f.values()) == 1 for p, _, f in judged if p == part)
                rows.append((name, (part, "".join(order), step, len(left), len(gone), redundant, alone,
                                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
                shapley[name] += len(gone)
        out += [(*row, shapley[name]) for name, row in rows]
    return set(out)


def test_odd_documents(spark):
    rng = random.Random(4)
    pool = ["", None, "a b c", "Word " * 60, " ".join(f"w{k}" for k in range(60)), "x#y", "AB CD " * 40,
            " ".join(f"W{k}|" for k in range(80)), "é " * 70, "\n\n"]
    docs = [(rng.choice([None, 1, 2, 3, 3, *range(4, 40)]), rng.choice(pool), rng.choice([None, "", "s", "t"]))
            for _ in range(150)]
    labels = [(rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    frame = spark.createDataFrame([(*d, 3, "k") for d in docs], f"{DOCS}, good int, part string")
    got = filter_audit.audit_filters(frame, spark.createDataFrame(labels, LABELS))
    assert set(map(tuple, got.collect())) == plain_audit(docs, labels)
    assert got.count() == 3 * 600


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(docs, labels).collect() == []
    one = filter_audit.audit_filters(spark.createDataFrame([(1, None, None)], DOCS), labels).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""}
    assert sum(r["shapley"] for r in one if r["filter_order"] == "ABCDE") == 120
