"""The classifier: held-out accuracy, and rows that are not plain."""

import zlib

import numpy as np

from tablesync.llm import compression_quality as cq
from tablesync.llm import queries
from tablesync.llm.common import table


def auc(score: np.ndarray, label: np.ndarray) -> float:
    pos, neg = score[label == 1], score[label == 0]
    return float(((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean())


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest table has too few held-out labels
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_compression_quality"](spark, sf_dir).collect()}
    assert len(got) == table(spark, sf_dir, "documents").count()
    for n, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(n).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    rows = [(got[r["doc_id"]]["score"], r["quality"]) for r in table(spark, sf_dir, "labels").collect()
            if got[r["doc_id"]]["held_out"]]
    score, label = map(np.array, zip(*rows))
    assert len(rows) > 50 and auc(score, label) > 0.9
    assert ((score >= 0.7) == label)[label == 1].mean() > 0.9


def test_held_out_labels_do_not_matter(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    flipped = labels.withColumn("quality", queries.F.when(queries.held_out(), 1 - queries.F.col("quality"))
                                .otherwise(queries.F.col("quality")))
    models = [cq.train(docs, t.where(~queries.held_out()), sample_rows=100) for t in (labels, flipped)]
    assert models[0] == models[1]


def test_sample_bytes_bound_the_dictionaries(spark, sf_dir, monkeypatch):
    seen = []
    with monkeypatch.context() as patch:
        patch.setattr(cq.zstandard, "train_dictionary", lambda size, pieces: seen.append(pieces) or 1 / 0)
        for bound in (1000, 2600):
            try:
                cq.build_dictionary([bytes([65 + n]) * 100 for n in range(26)], sample_bytes=bound)
            except ZeroDivisionError:
                pass
    assert [sum(map(len, pieces)) for pieces in seen] == [1000, 2600]
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    models = [cq.train(docs, labels, sample_rows=100, sample_bytes=n) for n in (3000, 12 << 20)]
    assert models[0].good != models[1].good and models[0].bad != models[1].bad


def plain_size(text: bytes, dictionary: bytes) -> int:
    data = cq.zstandard.ZstdCompressionDict(dictionary)
    tool = cq.zstandard.ZstdCompressor(dict_data=data, level=3)
    return sum(len(tool.compress(text[at:at + 256])) for at in range(0, len(text), 256))


def plain_inputs(text: str | None, good: bytes, bad: bytes) -> list[float]:
    data = (text or "").encode()
    a, b = plain_size(data, good), plain_size(data, bad)
    return [(b - a) / (a + b) if a + b else 0.0, 1 / (1 + len(data) / 64), 1.0]


def test_scores_worked_out_plainly(spark):
    """Sample, dictionaries, curve and scores, row by row from what the docstrings say."""
    F, sf_dir = queries.F, "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~queries.held_out())
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)).alias("part")
    chosen = sorted((r["hash"], r["doc_id"], r["quality"], r["part"]) for r in labels.select(
        "doc_id", "quality", F.xxhash64("doc_id").alias("hash"), part).collect())[:200]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces, points = {0: [], 1: []}, []
    for _, doc, quality, number in chosen:
        if doc not in texts:
            continue
        text = texts[doc] or ""
        if number == 0:
            points.append((text, quality))
            continue
        step = max(1024, -(-len(text) // 16))
        pieces[quality] += [text[at:at + 1024].encode() for at in range(0, len(text), step)]
    bad, good = (cq.zstandard.train_dictionary(1 << 16, sorted(pieces[q])).as_bytes() for q in (0, 1))
    model = cq.train(docs, labels, sample_rows=200)
    assert (model.good, model.bad) == (good, bad)
    # The curve: no small change of a weight makes the labels likelier under the prior.
    rows, y = np.array([plain_inputs(t, good, bad) for t, _ in points]), np.array([q for _, q in points])
    weights = np.array(model.weights)
    gradient = rows.T @ (y - 1 / (1 + np.exp(-rows @ weights))) - np.array([1e-3, 1e-1, 1e-2]) * weights
    assert np.abs(gradient).max() < 1e-6
    got = {r["doc_id"]: r for r in cq.score_quality(docs, labels, sample_rows=200).collect()}
    assert set(got) == set(texts)
    for doc, text in texts.items():
        score = 1 / (1 + np.exp(-np.array(plain_inputs(text, good, bad)) @ weights))
        assert abs(got[doc]["score"] - score) < 1e-12 and got[doc]["predicted"] == int(score >= 0.7)


def test_curve_fits_probabilities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=20_000)
    rows = np.stack([x, np.zeros(len(x)), np.ones(len(x))], axis=1)
    y = (rng.random(len(x)) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    a, _, b = cq.fit_curve(rows, y)
    assert abs(a - 2) < 0.1 and abs(b + 1) < 0.1


def test_odd_rows(spark):
    good, bad = "the old house by the river ", "$$$ BUY NOW $$$ "
    rows = [(n, (good if n % 2 else bad) * (n % 7 + 2), 0) for n in range(200)]
    rows += [(200, None, 0), (201, "", 0), (None, good * 9, 0), (1, good * 3, 0), (202, bad * 200_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    marks = [(n, n % 2) for n in range(150)] + [(None, 1), (3, None), (5, 1), (5, 0), (9, 7), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    got = cq.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[200]["score"] == by[201]["score"]
    assert by[151]["score"] > 0.7 > by[152]["score"] and by[None]["predicted"] == 1
    assert by[202]["predicted"] == 0
    assert cq.score_quality(docs.limit(0), labels).collect() == []
    unlabelled = cq.score_quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
