"""Quality scores from compression: which of two dictionaries fits a text better.

One zstandard dictionary is built from good labelled texts and one from bad
ones. A text is compressed in small pieces with each, and the difference of the
two sizes over their sum becomes a probability by a logistic curve that is
fitted on labelled texts the dictionaries have not seen. A second term of the
curve says how little text there was to compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tablesync.llm.common import slices, texts_of

PIECE = 256
LEVEL = 3
SHORT = 64  # bytes; a text of so many is half as short as an empty one
_TRAINING_PIECE = 1024


@dataclass(frozen=True)
class Model:
    """The two dictionaries and the weights of the curve over ``evidence``."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ np.array(self.weights), -700, 700)))


def build_dictionary(pieces: list[bytes], size: int = 1 << 16, *, sample_bytes: int = 12 << 20) -> bytes:
    """A dictionary from pieces of texts, of at most ``sample_bytes`` drawn at random if they are
    more; their plain end if they are too few to train."""
    if sum(map(len, pieces)) > sample_bytes:
        order = np.random.default_rng(0).permutation(len(pieces))
        total = np.cumsum([len(pieces[i]) for i in order])
        pieces = [pieces[i] for i in order[:np.searchsorted(total, sample_bytes, side="right")]]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[-size:]


class Compressor:
    """Sizes of texts under one dictionary."""

    def __init__(self, dictionary: bytes):
        # A trained dictionary carries its own mark; anything else is taken as plain content.
        data = zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None
        if data is not None:
            data.precompute_compress(level=LEVEL)
            self.tool = zstandard.ZstdCompressor(dict_data=data)
        else:
            self.tool = zstandard.ZstdCompressor(level=LEVEL)

    def size(self, text: bytes) -> int:
        compress = self.tool.compress
        return sum(len(compress(text[i:i + PIECE])) for i in range(0, len(text), PIECE))


def evidence(text: bytes, good: Compressor, bad: Compressor) -> tuple[float, float, float]:
    """The curve's inputs: how much better the good dictionary fits (-1 to 1, 0 for an
    empty text), how short the text is (1 for an empty one, towards 0), and 1."""
    a, b = good.size(text), bad.size(text)
    return (b - a) / (a + b) if a + b else 0.0, 1 / (1 + len(text) / SHORT), 1.0


def fit_curve(rows: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic curve by Newton's method, with a weak prior on each."""
    prior = np.diag([1e-3, 1e-1, 1e-2])
    weights = np.zeros(len(prior))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (y - p) - prior @ weights
        curvature = (rows * (p * (1 - p))[:, None]).T @ rows + prior
        step = np.linalg.solve(curvature, gradient)
        weights += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(weights.tolist())


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_rows: int = 12_000, sample_pieces: int = 16,
    sample_bytes: int = 12 << 20,
) -> Model:
    """Dictionaries and curve from at most ``sample_rows`` labelled rows.

    The rows are those whose ids have the smallest hashes; a quarter of them is
    left to the curve. A dictionary sees at most ``sample_pieces`` pieces of a
    text, of 1024 characters and evenly spread over it, and of all pieces of its label at most
    ``sample_bytes`` (12 MiB), drawn at random; what is beyond does not enter it. The curve sees
    whole texts. Labels other than 0 and 1, null ids and labels without a document are not used. An id with several labels counts with its largest.
    Without any usable label the model scores everything 0.5.
    """
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most sample_rows short rows: a bound that does not grow with the table.
    sample = texts.join(F.broadcast(chosen), "id").withColumn(
        "part", F.when(F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(4)) == 0, -1).otherwise(F.col("label"))
    )

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = [piece.encode() for piece in sorted(rows["piece"])]
        return pd.DataFrame({"label": [key[0]], "dictionary": [build_dictionary(own, sample_bytes=sample_bytes)]})

    size = F.char_length("text")
    step = F.greatest(F.lit(_TRAINING_PIECE), F.ceil(size / sample_pieces).cast("int"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / step).cast("int")),
        lambda n: F.substring(F.col("text"), n * step + 1, F.lit(_TRAINING_PIECE)),
    )
    built = (
        sample.where("part >= 0").where(size > 0).select("label", F.explode(pieces).alias("piece"))
        .groupBy("label").applyInPandas(build, "label int, dictionary binary")
    )
    found = {row["label"]: bytes(row["dictionary"]) for row in built.collect()}
    good, bad = found.get(1, b""), found.get(0, b"")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Compressor(good), Compressor(bad)
        for batch in slices(batches):
            rows = [list(evidence(text, *tools)) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column("label")], ["x", "label"]
            )

    pairs = sample.where("part < 0").select("text", "label").mapInArrow(
        compare, "x array<double>, label int"
    )
    points = sorted((r["x"], r["label"]) for r in pairs.collect())
    rows = np.array([x for x, _ in points], float).reshape(-1, 3)
    return Model(good, bad, fit_curve(rows, np.array([y for _, y in points], float)))


def add_scores(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (the whole row as a struct) and ``score`` for every row."""
    source, field = docs.select(F.struct("*").alias("row")), docs.columns.index(text_col)
    schema = StructType([source.schema["row"], StructField("score", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Compressor(model.good), Compressor(model.bad)
        for batch in slices(batches):
            texts = texts_of(batch, "row", field)
            rows = np.array([evidence(text, *tools) for text in texts]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(model.score(rows))], ["row", "score"]
            )

    return source.mapInArrow(score, schema)


def score_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", threshold: float = 0.7, sample_rows: int = 12_000,
    sample_pieces: int = 16, sample_bytes: int = 12 << 20,
) -> DataFrame:
    """id, score (0 to 1, higher: label 1 is likelier) and predicted (1 from ``threshold``).

    The model is trained on ``labels``: on ``sample_rows`` of them, and each dictionary on
    ``sample_pieces`` pieces a text and ``sample_bytes`` in all (see ``train``). Every whole text is
    scored, and nothing but the text enters its score. A null or empty text gets
    the curve's value at no difference and no length. Ids may be null or repeat; equal texts
    get equal scores. Extra columns are not looked at. No rows give no rows.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col,
                  sample_rows=sample_rows, sample_pieces=sample_pieces, sample_bytes=sample_bytes)
    scored = add_scores(docs.select(F.col(id_col), F.col(text_col)), model, text_col=text_col)
    return scored.select(
        F.col(f"row.{id_col}").alias(id_col), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
