"""Nearest neighbours against a search over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import nearest as near
from tablesync.llm.common import table

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows: list, k: int, every: int = 20) -> list[tuple]:
    usable = [
        (i, [float(np.float32(c)) for c in v]) for i, v in rows
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    ]
    out = []
    for at, (query, left) in enumerate(usable):
        if query is None or query % every:
            continue
        scored = []
        for other, (i, right) in enumerate(usable):
            if other != at:
                total = 0.0
                for a, b in zip(left, right):
                    total += a * b
                scored.append((-total, 2**63 if i is None else i))
        out += [
            (query, rank, None if i == 2**63 else i, -value)
            for rank, (value, i) in enumerate(sorted(scored)[:k], 1)
        ]
    return sorted(out, key=str)


def found(df, **options) -> list[tuple]:
    return sorted(map(tuple, near.nearest(df, F.pmod("id", F.lit(20)) == 0, **options).collect()), key=str)


def test_whole_table(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    assert found(df) == plain(rows, 20)


@pytest.mark.parametrize("seed", range(3))
def test_ties_copies_and_small_blocks(spark, seed):
    rng = np.random.default_rng(seed)
    pool = (1.0 * rng.integers(-3, 4, (30, 5)) * rng.choice([1e-3, 1.0, 1e3], (30, 1))).tolist()
    rows = [(int(rng.integers(0, 90)), pool[int(rng.integers(0, 30 if seed else 3))]) for _ in range(240)]
    rows += [(20, pool[0])] * 9 + [(20, pool[1])] * 3 + [(None, pool[0]), (None, pool[0])]
    rows += [(40, None), (60, []), (80, [0.0] * 5), (80, [1.0, None, 1.0, 1.0, 1.0]),
             (0, [float("nan")] * 5), (0, [float("inf")] * 5)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], f"{SCHEMA}, rank int").repartition(5)
    wanted = plain(rows, 4)
    assert found(df, k=4, query_block=7, tile=16) == wanted
    assert found(df, k=4, query_block=1000, tile=1) == wanted


def test_few_and_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(20, [1.0])], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, [1.0]), (2, [1.0])], SCHEMA)) == []
    three = [(20, [1.0, 2.0]), (21, [1.0, 0.0]), (22, [0.0, 1.0]), (23, [1.0])]
    assert found(spark.createDataFrame(three, SCHEMA)) == [(20, 1, 22, 2.0), (20, 2, 21, 1.0)]
    doubles = spark.createDataFrame([(20, [1e-300, 1e200]), (21, [1e300, 1.0])], "vec_id int, embedding array<double>")
    assert found(doubles) == [(20, 1, 21, 1.0 + 1e200)]


def test_bounds_hold():
    rng = np.random.default_rng(5)
    left = rng.standard_normal((40, 70)) * rng.choice([1e-9, 1, 1e9], (40, 1))
    right = np.vstack([rng.standard_normal((30, 70)), np.eye(70)[:10] * 1e5, left[:5] * -1])
    a, b = near.encode(left), near.encode(right)
    about = near.products(a[0].astype(np.float32), b[0].astype(np.float32)) * a[1][:, None] * b[1][None, :]
    error = (a[2] + a[3])[:, None] * b[3] + a[3][:, None] * b[2][None, :]
    exact = left @ right.T
    assert (np.abs(exact - about) <= error + 1e-12 * a[2][:, None] * b[2][None, :]).all()
    assert np.abs(a[0]).max() == 127


def test_products_are_whole_beyond_a_thousand_columns():
    codes = np.full((2, 3000), 127, np.float32)
    assert (near.products(codes, codes) == 127 * 127 * 3000).all()
