"""Counts against plain code, and what the robust distances reject."""

import random
import re

import numpy as np
import pytest

from tablesync.llm import robust_rules as rr
from tablesync.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 5)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, doubled, len(covered)


def test_counts_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r["doc_id"]: r for r in rr.judge_texts(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for row in rows:
        r = got[row["doc_id"]]
        if len(row["text"] or "") < 9000:  # the plain count takes the square of the length
            counts = plain(row["text"])
            assert tuple(r[c] for c in rr._STATS) == counts
            failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
            assert r["base_failed"] == failed
            assert not (failed and r["kept"])


@pytest.mark.parametrize("seed", range(30))
def test_repeated_words(seed):
    rng = random.Random(seed)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(60))]
    text = b" ".join(words).decode()
    assert rr.repeated_words(words) == plain(text)[4]


def test_chi_square_is_near_its_tables():
    for share, exact in ((0.5, 6.346), (0.999, 24.322)):
        assert abs(rr.chi_square(share, 7) / exact - 1) < 0.01


def test_clean_rows_stay_and_junk_goes(spark):
    sf_dir = "/root/testdata/sf0.01"
    kept = {r["doc_id"]: r for r in rr.judge_texts(table(spark, sf_dir, "documents")).collect()}
    rows = [(kept[r["doc_id"]], r["quality"]) for r in table(spark, sf_dir, "labels").collect()]
    clean = [r["kept"] for r, quality in rows if quality == 1 and not r["base_failed"]]
    junk = [r["kept"] for r, quality in rows if quality == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.2


def test_covariance_is_robust(spark):
    """A third of far rows must not move the centre of the others."""
    rng = np.random.default_rng(2)
    good = rng.normal(0, 1, (600, len(rr.VECTOR)))
    far = rng.normal(12, 1, (300, len(rr.VECTOR)))
    vectors = np.round(rr._UNIT * np.vstack([good, far])).astype(int).tolist()
    names = ", ".join(f"{n} bigint" for n in rr.VECTOR)
    rows = spark.createDataFrame(
        [(n, "=en", "=a", True, *v) for n, v in enumerate(vectors)],
        f"id bigint, g0 string, g1 string, usable boolean, {names}")
    distance = {r["id"]: r["distance"] for r in rr.robust_distances(rows).collect()}
    limit = rr.chi_square(1 - 1e-6, len(rr.VECTOR))
    assert max(distance[n] for n in range(600)) < limit < min(distance[n] for n in range(600, 900))
    exact = np.linalg.inv(np.cov(good.T) + np.diag(np.array(list(rr.VECTOR.values())) ** 2))
    gaps = good - good.mean(axis=0)
    wanted = np.einsum("ij,jk,ik->i", gaps, exact, gaps)
    assert np.corrcoef(wanted, [distance[n] for n in range(600)])[0, 1] > 0.9


def vectors_of(spark, groups: dict[str, np.ndarray]):
    """Usable rows of one language with the given vectors, by source; ids count up in their order."""
    names = ", ".join(f"{n} bigint" for n in rr.VECTOR)
    rows = [("=en", source, True, *v) for source, rows in groups.items()
            for v in np.round(rr._UNIT * rows).astype(int).tolist()]
    return spark.createDataFrame([(n, *row) for n, row in enumerate(rows)],
                                 f"id bigint, g0 string, g1 string, usable boolean, {names}")


def test_small_groups_are_judged_by_their_own_rows(spark):
    rng = np.random.default_rng(3)
    size = len(rr.VECTOR)
    own, one = rng.normal(0, 1, (40, size)), np.full((1, size), 50.0)
    alone = rr.robust_distances(vectors_of(spark, {"=a": own})).collect()
    groups = {"=a": own, "=b": rng.normal(20, 1, (120, size)), "=c": one}
    among = rr.robust_distances(vectors_of(spark, groups)).collect()
    by = {r["id"]: r["distance"] for r in among}
    assert {r["id"]: r["distance"] for r in alone} == {n: by[n] for n in range(40)}
    assert by[160] == 0


def test_steps_go_on_until_the_half_stays(spark):
    """A further step from the result gives the same result."""
    size, floors = len(rr.VECTOR), np.array(list(rr.VECTOR.values()))
    rng = np.random.default_rng(5)
    vectors = np.round(rr._UNIT * (rng.normal(0, 3, (800, size)) @ rng.normal(0, 1, (size, size)))) / rr._UNIT
    got = {r["id"]: r["distance"] for r in rr.robust_distances(vectors_of(spark, {"=a": vectors})).collect()}
    distance = np.array([got[n] for n in range(len(vectors))])
    half = vectors[np.argsort(distance, kind="stable")[:len(vectors) // 2]]
    precision = np.linalg.inv(np.cov(half.T, bias=True) + np.diag(floors**2))
    gaps = vectors - half.mean(axis=0)
    again = np.einsum("ij,jk,ik->i", gaps, precision, gaps)
    again /= max(1.0, np.median(again) / rr.chi_square(0.5, size))
    assert np.allclose(distance, again, rtol=0.01)


def plain_middle(values: np.ndarray) -> int:
    """The smallest value that at least half of all values do not exceed."""
    ordered = np.sort(values)
    return int(ordered[(len(ordered) + 1) // 2 - 1])


def plain_distances(units: np.ndarray) -> tuple[np.ndarray, int]:
    """One group's squared distances: start, steps until the determinant falls no more, scale."""
    size, floors = len(rr.VECTOR), np.array(list(rr.VECTOR.values()))
    middle = np.array([plain_middle(units[:, k]) for k in range(size)])
    spread = np.array([1.4826 * plain_middle(np.abs(units[:, k] - middle[k])) / 1024 for k in range(size)])
    centre, precision = middle / 1024, np.diag(1 / np.maximum(spread, floors) ** 2)
    volume, steps = np.inf, 0

    def ranks():
        gaps = units / 1024 - centre
        d = np.einsum("ij,jk,ik->i", gaps, precision, gaps)
        return d, np.rint(1000 * np.log(1e-6 + np.maximum(d, 0))).astype(int)

    while True:
        _, rank = ranks()
        half = units[rank <= plain_middle(rank)]
        cov = np.cov(half.T / 1024, bias=True).reshape(size, size) + np.diag(floors**2)
        found, steps = np.linalg.slogdet(cov)[1], steps + 1
        if not found < volume - 1e-12:
            break
        centre, precision, volume = half.mean(axis=0) / 1024, np.linalg.inv(cov), found
    d, rank = ranks()
    scale = (np.exp(plain_middle(rank) / 1000) - 1e-6) / rr.chi_square(0.5, size)
    return d / max(scale, 1.0), steps


def test_verdicts_worked_out_plainly(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in rr.judge_texts(docs).collect()}
    groups, limit, most = {}, rr.chi_square(1 - 1e-9, len(rr.VECTOR)), 0
    for row in docs.collect():
        stats = rr.statistics((row["text"] or "").encode())
        failed = stats[0] < 10 or 100 * stats[4] > 20 * stats[0]
        assert got[row["doc_id"]]["base_failed"] == failed
        if not failed:
            groups.setdefault((row["lang"], row["source"]), []).append((row["doc_id"], stats[5:]))
    assert len(groups) > 50
    for rows in groups.values():
        distances, steps = plain_distances(np.array([vector for _, vector in rows]))
        most = max(most, steps)
        for (doc, _), distance in zip(rows, distances):
            assert np.isclose(got[doc]["distance"], distance, rtol=1e-6, atol=1e-9)
            assert got[doc]["kept"] == (distance <= limit)
    assert most >= 3


def test_odd_rows(spark):
    clean = "some plain words that make up one line of text for all"
    rows = [(n, f"{clean} {n}", "en", "s", 1) for n in range(20)]
    rows += [(20, None, "en", "s", 1), (21, "", None, None, 1), (None, clean, None, "s", 1),
             (3, f"{clean} 3", "en", "s", 1), (22, "word other " * 300_000, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, distance int")
    got = rr.judge_texts(docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[20][1:6] == by[21][1:6] == (0, 0, 0, 0, 0) and by[20]["base_failed"] and not by[21]["kept"]
    assert by[None]["kept"] and by[3]["kept"] and by[22]["n_repeat_words"] == 600_000
    assert rr.judge_texts(docs.limit(0)).collect() == []
    assert not any(r["kept"] for r in rr.judge_texts(docs.where("doc_id >= 20")).collect()
                   if r["base_failed"])
