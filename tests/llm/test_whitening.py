"""Whitening against plain numpy on whole tables and on odd rows."""

import numpy as np
import pytest

from tablesync.llm import eigen, whitening
from tablesync.llm.common import table
from tablesync.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(vectors: dict, components: int = 4):
    """n, exact deviations, whitened coordinates and shares, by a library's eigenvectors."""
    x = {i: tuple(int(np.floor(256 * float(np.float32(c)))) for c in v) for i, v in vectors.items()}
    fit = np.array(sorted(set(x.values())))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - np.array(sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x.items()}
    white = {i: (np.array(v) - np.array(sums) / n) @ directions / np.sqrt(values) for i, v in x.items()}
    return n, deviation, white, values / np.trace(centred.T @ centred / n)


def check(rows, vectors: dict, components: int = 4) -> None:
    n, deviation, white, shares = plain(vectors, components)
    assert len(rows) == len(vectors) * components
    signs = {}
    for r in rows:
        wanted = white[r["vec_id"]][r["component"] - 1]
        if abs(wanted) > 1e-3:
            sign = signs.setdefault(r["component"], np.sign(wanted * r["whitened"]))
            assert r["whitened"] == pytest.approx(sign * wanted, rel=1e-6, abs=1e-8)
        assert r["n"] == n and int(r["deviation"]) == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in rows}) == 1


def test_whole_table(spark, sf_dir):
    rows = {r["vec_id"]: r["embedding"] for r in table(spark, sf_dir, "embeddings").collect()}
    got = QUERIES["op12_whitening"](spark, sf_dir)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), rows)


def test_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(3)
    good = {i: (rng.standard_normal(6) * [9, 5, 3, 2, 1, 1]).tolist() for i in range(60)}
    good |= {100 + i: good[0] for i in range(80)}  # copies count once in the fit
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 6),
           (204, [float("inf")] + [0.0] * 5), (205, [1.0, 2.0])]
    rows = [(i, v, 1, 2.0) for i, v in [*good.items(), *odd]]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, n int, whitened double")
    check(whitening.whiten(docs).collect(), good)
    twice = whitening.whiten(docs.where("vec_id = 3").union(docs).union(docs.where("vec_id = 3")))
    assert twice.where("vec_id = 3").count() == 12 and twice.first()["n"] == 60


def test_fewer_components_and_no_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], SCHEMA)
    got = whitening.whiten(line).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 9
    nulls = spark.createDataFrame([(None, [float(i), -1.0 * i * i]) for i in range(9)], SCHEMA)
    assert [r["vec_id"] for r in whitening.whiten(nulls).collect()] == [None] * 18


def test_exact_beyond_a_long(spark):
    big = spark.createDataFrame([(i, [3e30 * i, 0.0]) for i in (-1, 1)] + [(3, [0.0, 0.0])], SCHEMA)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(big, components=1).collect()}
    assert got == {-1: None, 1: None, 3: 1}  # (3 * 2**63)**2 has 39 digits; the ends differ by one
    some = spark.createDataFrame([(i, [1e9 * i, float(i)]) for i in range(40)], SCHEMA)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(some, components=1).collect()}
    values = {i: (int(256 * float(np.float32(1e9 * i))), 256 * i) for i in range(40)}
    sums = [sum(v[k] for v in values.values()) for k in (0, 1)]
    assert got == {i: sum((40 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in values.items()}
    assert max(got.values()) > 2**63


@pytest.mark.parametrize("kind", ["random", "diagonal", "repeated", "zero", "large"])
def test_eigenpairs(kind):
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 10, 33):
        a = rng.standard_normal((size, size))
        a = a @ a.T
        if kind == "diagonal":
            a = np.diag(rng.integers(1, 4, size).astype(float))
        if kind == "repeated":
            q = np.linalg.qr(a)[0]
            a = q @ np.diag([5.0] * min(3, size) + [1.0] * max(0, size - 3)) @ q.T
            a = (a + a.T) / 2
        a = a * {"zero": 0.0, "large": 1e30}.get(kind, 1.0)
        values, vectors = eigen.leading(a, 4)
        scale = max(np.abs(a).max(), 1e-300)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:4]).max() <= 1e-12 * size * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
        assert np.abs(a @ vectors - vectors * values).max() <= 1e-11 * size * scale


def test_sturm_count():
    diagonal, beside = np.array([2.0, 2.0, 2.0, 0.0]), np.array([1.0, 1.0, 0.0])
    exact = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
    for value in (-1.0, 0.1, 1.0, 1.9, 2.1, 4.0):
        assert eigen.below(diagonal, beside, value) == sum(exact < value - 1e-12)
