"""What the operators on embeddings share: which rows take part, and sums over blocks of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether every entry is a finite number; false for a null or empty vector."""
    entries = vector.cast("array<double>")
    good = F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))


def usual_length(rows: DataFrame, vector_col: str) -> int | None:
    """The length most vectors have, the larger of two equally common; None without rows."""
    first = (
        rows.groupBy(F.size(vector_col).alias("length")).count()
        .orderBy(F.desc("count"), F.desc("length")).first()
    )
    return first["length"] if first else None


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column without nulls, of lists of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def sum_matrices(
    rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, int]
) -> np.ndarray:
    """The sum over all batches of the matrix that ``of`` makes of each.

    Every task adds up its own and gives one row per matrix row; Spark adds these
    entry by entry, and only the sum itself reaches the driver.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(shape[0]), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                ["i", "part"],
            )

    entries = (
        rows.mapInArrow(add, "i int, part array<double>")
        .select("i", F.posexplode("part").alias("j", "part"))
        .groupBy("i", "j").agg(F.sum("part").alias("part"))
    )
    out = np.zeros(shape)
    found = entries.toArrow()
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["part"].to_numpy()
    return out
