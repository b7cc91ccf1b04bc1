"""Whitening of embeddings by their leading principal components.

Entries become whole multiples of 1/256. The sums and the centred covariance of
the distinct vectors are added up by Spark; only the covariance, whose size
depends on the vectors' length alone, reaches the driver. There Householder
reflections, Sturm counts and inverse iteration give the leading components,
and every row is projected on them where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablesync.llm.common import stage
from tablesync.llm.eigen import leading
from tablesync.llm.vectors import finite, matrix, sum_matrices, usual_length

_DIGITS = 10**38  # beyond what a decimal holds
_RESULT = (
    "id {id}, component int, n bigint, deviation decimal(38,0), whitened double, explained double"
)


@dataclass
class Whitening:
    """A fit: ``rows`` vectors with ``sums``, and per component a column of ``directions``."""

    rows: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float | None

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.mean) @ self.directions

    def deviations(self, vectors: np.ndarray) -> list[Decimal | None]:
        """The exact sum of (rows * x - sums)^2 of each vector; None beyond 38 digits."""
        reach = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)))
        largest = reach * self.rows + max(map(abs, self.sums), default=0)
        if vectors.shape[1] * largest**2 < 2**63:
            gaps = vectors * self.rows - np.array(self.sums, np.int64)
            totals = (gaps * gaps).sum(axis=1).tolist()
        else:
            gaps = vectors.astype(object) * self.rows - np.array(self.sums, object)
            totals = (gaps * gaps).sum(axis=1).tolist()
        return [Decimal(total) if total < _DIGITS else None for total in totals]


def whole_vectors(rows: DataFrame, *, id_col: str, vector_col: str, per_unit: int = 256) -> DataFrame:
    """``id`` and ``x``, the entries as whole numbers of 1/``per_unit``, of the rows that take part."""
    return rows.where(finite(F.col(vector_col))).select(
        F.col(id_col).alias("id"),
        F.transform(F.col(vector_col).cast("array<double>"), lambda c: F.floor(c * per_unit)).alias("x"),
    )


def _sums(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """Exact sums of every dimension, and the number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, np.zeros(length, object)
        for batch in batches:
            vectors = matrix(batch.column("x"), length)
            rows += len(vectors)
            if len(vectors):
                # The halves of the numbers cannot overflow when they are added up.
                high, low = vectors >> 31, vectors & (2**31 - 1)
                sums = sums + high.sum(axis=0).astype(object) * 2**31 + low.sum(axis=0).astype(object)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(length), pa.int32()), pa.array([rows] * length, pa.int64()),
                 pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))],
                ["i", "n", "total"],
            )

    found = (
        fit.mapInArrow(add, "i int, n bigint, total decimal(38,0)")
        .groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    )
    return found[0]["n"], [int(row["total"]) for row in found]


def _covariance(fit: DataFrame, project, mean: np.ndarray, rows: int) -> np.ndarray:
    """The covariance of what ``project`` makes of the vectors, divisor ``rows``, centred first."""
    length = len(mean)

    def part(batch: pa.RecordBatch) -> np.ndarray:
        centred = project(batch) - mean
        return centred.T @ centred

    return sum_matrices(fit, part, (length, length)) / rows


def fit_whitening(vectors: DataFrame, *, length: int, components: int = 4) -> Whitening:
    """The components of ``whole_vectors`` of one length, each distinct vector counted once.

    Components are as many as have a variance above rounding errors, ``components`` at
    most. ``identity_error`` is the largest absolute entry of the covariance of
    the whitened distinct vectors minus the identity, from a pass over them.
    """
    fit = stage(vectors.select("x").distinct(), "fit")
    rows, sums = _sums(fit, length)
    mean = np.array([total / rows for total in sums])
    cov = _covariance(fit, lambda batch: matrix(batch.column("x"), length), mean, rows)
    values, directions = leading(cov, components)
    trace = float(np.trace(cov))
    kept = values > trace * length * np.finfo(np.float64).eps
    values, directions = values[kept], directions[:, kept]
    found = Whitening(rows, sums, mean, values, directions / np.sqrt(values), trace, None)
    if len(values):
        def white(batch: pa.RecordBatch) -> np.ndarray:
            return found.project(matrix(batch.column("x"), length))

        count = len(values)
        centre = sum_matrices(fit, lambda batch: white(batch).sum(axis=0)[None], (1, count))[0] / rows
        white_cov = _covariance(fit, white, centre, rows)
        found.identity_error = float(np.abs(white_cov - np.eye(count)).max())
    return found


def whiten(
    rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4,
    per_unit: int = 256,
) -> DataFrame:
    """Every row's whitened coordinate on each leading component.

    One row per input row and ``component`` (from 1, by falling variance): ``n``
    distinct vectors were fitted, ``deviation`` is the exact sum of
    (n * x - S)^2 over the dimensions as a decimal (null beyond 38 digits),
    ``explained`` the component's share of the variance, ``identity_error`` one
    value for all rows. Components without variance are left out, so that fewer
    dimensions or fewer independent vectors give fewer of them, and a table of
    equal vectors gives no rows.

    Rows whose vector is null, empty or holds null or non-finite entries are left
    out, and so are vectors of another length than most have. Repeated rows are
    each given and count once in the fit; a null id stays null. Entries beyond
    what a long holds stop at its ends. Extra columns are not looked at; an
    empty table gives no rows. Memory per task is a batch of vectors and a
    matrix of the square of their length; the driver holds a few such matrices.
    """
    vectors = whole_vectors(rows, id_col=id_col, vector_col=vector_col, per_unit=per_unit)
    kind = vectors.schema["id"].dataType
    id_type, schema = to_arrow_type(kind), _RESULT.format(id=kind.simpleString())
    length = usual_length(vectors, "x")
    model = None
    if length is not None:
        vectors = vectors.where(F.size("x") == length)
        model = fit_whitening(vectors, length=length, components=components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0 if model is None else len(model.values)
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            x = matrix(batch.column("x"), length)
            deviations = model.deviations(x)
            white = model.project(x)
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(id_type).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.rows, np.int64)),
                    pa.array(deviations, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained"],
            )

    return vectors.mapInArrow(project, schema).withColumnRenamed("id", id_col).withColumn(
        "identity_error", F.lit(model.identity_error if model else None).cast("double")
    )
