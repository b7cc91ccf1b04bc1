"""Exact nearest neighbours by inner product, as a block matrix join.

Vectors are stored with 8-bit codes, their scale and what rounding took away.
A task takes one block of queries and one share of the stored vectors, and goes
through that share tile by tile: whole-number products of the codes give every
inner product up to a known error, only pairs that can still be among a query's
best are multiplied out in double precision, and heaps keep the best. The heaps
of one query's shares are merged at the end. Nothing is approximated away: a
pair is left out only where its upper bound is below k scores already found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesync.llm.common import file_system, stage
from tablesync.llm.vectors import finite, matrix, usual_length

_FIELDS = (
    "id bigint, first boolean, vector binary, codes binary, scale double, norm double, lost double"
)
_FOUND = "query bigint, query_id bigint, vec_id bigint, score double"
_NO_ID = 2**63  # a null id counts as larger than all


class Block:
    """Some stored vectors as matrices."""

    def __init__(self, batch: pa.RecordBatch, kind: str):
        def numbers(name: str) -> np.ndarray:
            return batch.column(name).to_numpy(zero_copy_only=False)

        def stacked(name: str, dtype: str) -> np.ndarray:
            joined = b"".join(batch.column(name).to_pylist())
            return np.frombuffer(joined, dtype).reshape(batch.num_rows, -1)

        self.scale, self.norm, self.lost = map(numbers, ("scale", "norm", "lost"))
        self.first = numbers("first").astype(bool)
        self.ids = [_NO_ID if i is None else i for i in batch.column("id").to_pylist()]
        self.codes = stacked("codes", "i1").astype(np.float32)
        self.vectors = stacked("vector", kind).astype(np.float64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes from -127 to 127, their scale, the vectors' norms and the norms of what rounding lost."""
    scale = np.abs(vectors).max(axis=1) / 127
    # A scale that is too small to divide by makes all codes zero: everything is lost, and counted so.
    usable = scale > 1e-290
    units = vectors / np.where(usable, scale, 1.0)[:, None]
    codes = np.where(usable[:, None], np.rint(units), 0.0).astype(np.int8)
    lost = np.linalg.norm(vectors - codes * scale[:, None], axis=1)
    return codes, scale, np.linalg.norm(vectors, axis=1), lost


def _with_codes(vectors: DataFrame, kind: str, length: int) -> DataFrame:
    """``id``, ``first`` and ``vector`` with codes, vectors as bytes of ``kind``."""

    def add_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matrix(batch.column("vector"), length)
            codes, scale, norm, lost = encode(found.astype(np.float64))
            blobs = [[row.tobytes() for row in rows] for rows in (found.astype(kind), codes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("first"), *(pa.array(b, pa.binary()) for b in blobs),
                 *(pa.array(numbers, pa.float64()) for numbers in (scale, norm, lost))],
                ["id", "first", "vector", "codes", "scale", "norm", "lost"],
            )

    return vectors.mapInArrow(add_codes, _FIELDS)


def _smallest_copies(vectors: DataFrame, copies: int) -> DataFrame:
    """Of equal vectors the ``copies`` smallest ids, and whether each is the first of its id.

    Ties go to smaller ids, so no other copy can be among that many nearest.
    """
    same = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last())
    few = vectors.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= copies)
    again = (F.col("nth") > 1) & F.lag("id").over(same).eqNullSafe(F.col("id"))
    return few.select("id", (~again).alias("first"), "vector")


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whole-number products of codes; 1,024 columns at a time they are exact in single precision."""
    total = 0.0
    for start in range(0, left.shape[1], 1024):
        part = left[:, start:start + 1024] @ right[:, start:start + 1024].T
        total = total + part.astype(np.float64)
    return total


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up from the first entry to the last."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


class Best:
    """The best ``k`` candidates of every query of a block, in heaps."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k, self.names = queries, k, np.array(queries.ids, object)
        self.heaps: list[list[tuple]] = [[] for _ in queries.ids]
        self.floor = np.full(len(queries.ids), -np.inf)  # the k-th best score so far

    def own(self, at: np.ndarray, other: np.ndarray, some: Block) -> np.ndarray:
        """Which pairs are a query and its own row: the first stored one of its id and vector."""
        same = some.first[other] & (self.names[at] == np.array(some.ids, object)[other]).astype(bool)
        pairs = np.flatnonzero(same)
        same[pairs] = (self.queries.vectors[at[pairs]] == some.vectors[other[pairs]]).all(axis=1)
        return same

    def add(self, some: Block) -> None:
        """Let the candidates of a tile compete."""
        q = self.queries
        about = products(q.codes, some.codes)
        about *= q.scale[:, None]
        about *= some.scale[None, :]
        # |u.v - u'.v'| <= |u'| |v - v'| + |u - u'| |v|, and a little for the rounding of doubles.
        error = (q.norm + q.lost)[:, None] * some.lost[None, :]
        error += (q.lost + 1e-12 * q.norm)[:, None] * some.norm[None, :]
        floor = self.floor
        if np.isneginf(floor).any() and len(some.ids) > self.k:
            # k others have at least this score, whichever one is the query's own row.
            lower = np.partition(about - error, -self.k - 1, axis=1)[:, -self.k - 1]
            floor = np.maximum(floor, lower)
        about += error
        at, other = np.nonzero(~(about < floor[:, None]))
        own = self.own(at, other, some)
        at, other = at[~own], other[~own]
        step = 1 << 18  # pairs that are multiplied out at once
        for start in range(0, len(at), step):
            self._push(at[start:start + step], other[start:start + step], some)

    def _push(self, at: np.ndarray, other: np.ndarray, some: Block) -> None:
        score = scores(self.queries.vectors[at], some.vectors[other])
        good = ~(score < self.floor[at])
        touched = set()
        for query, candidate, value in zip(at[good].tolist(), other[good].tolist(), score[good].tolist()):
            heap, item = self.heaps[query], (value, -some.ids[candidate])
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
            touched.add(query)
        for query in touched:
            if len(self.heaps[query]) == self.k:
                self.floor[query] = self.heaps[query][0][0]

    def rows(self, first: int) -> pa.RecordBatch:
        """What the heaps hold, the queries numbered from ``first``."""
        found = [
            (number, id_, None if -less == _NO_ID else -less, value)
            for number, (id_, heap) in enumerate(zip(self.queries.ids, self.heaps), first)
            for value, less in heap
        ]
        columns = list(zip(*found)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["query", "query_id", "vec_id", "score"]
        )


def _batches(uris: list[str], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of stored files, ``size`` at a time."""
    for uri in uris:
        system, path = file_system(uri)
        with system.open_input_file(path) as source, pq.ParquetFile(source) as file:
            yield from (batch for batch in file.iter_batches(batch_size=size) if batch.num_rows)


def _tiles(
    spark: SparkSession, query_files: list[str], files: list[str], *, k: int, kind: str, tile: int,
    query_block: int, tasks: int,
) -> DataFrame:
    """The best of every query block within every share of the stored files."""
    shares = max(1, min(len(files), -(-tasks // max(1, len(query_files)))))
    count = len(query_files) * shares
    jobs = spark.range(0, count, 1, max(1, count))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("id").to_pylist():
                block, share = divmod(number, shares)
                asked = 0
                for queries in _batches([query_files[block]], query_block):
                    best = Best(Block(queries, kind), k)
                    for candidates in _batches(files[share::shares], tile):
                        best.add(Block(candidates, kind))
                    yield best.rows(block << 32 | asked)
                    asked += queries.num_rows

    return jobs.mapInArrow(search, _FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """One query's heaps into one, as its rows come by."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranked(group: tuple, heap: list[tuple]) -> list[tuple]:
            ordered = sorted(heap, reverse=True)
            return [
                (group[1], rank, None if -less == _NO_ID else -less, value)
                for rank, (value, less) in enumerate(ordered, 1)
            ]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
                ["query_id", "rank", "vec_id", "score"],
            )

        present, heap, out = None, [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("query", "query_id", "vec_id", "score")]
            for number, query, id_, value in zip(*columns):
                if present is None or present[0] != number:
                    if present is not None:
                        out += ranked(present, heap)
                    present, heap = (number, query), []
                    if len(out) >= 4096:
                        yield batch_of(out)
                        out = []
                item = (value, -(_NO_ID if id_ is None else id_))
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        if present is not None:
            yield batch_of(out + ranked(present, heap))

    return (
        found.repartition("query").sortWithinPartitions("query")
        .mapInArrow(merge, "query_id bigint, rank int, vec_id bigint, score double")
    )


def nearest(
    rows: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 20, query_block: int = 2048, tile: int = 1024, tasks: int | None = None,
) -> DataFrame:
    """The ``k`` rows of largest inner product with each query, nearest first.

    Queries are the rows where ``is_query``, a condition on ``id``, holds;
    candidates are all rows but the query's own. Gives query_id, ``rank`` from 1,
    vec_id and ``score``, the inner product in double precision added up from the
    first entry to the last. Ties go to the smaller id. With fewer candidates
    than ``k`` all are given. The result is exact.

    Vectors that are null, empty, zero or hold null or non-finite entries take no
    part, neither do vectors of another length than most have. Repeated rows
    are rows of their own: they find each other and are found, with ties as above.
    A null id is never a query and comes after all others in a tie. Extra
    columns are not looked at; an empty table gives no rows.

    The work is the number of queries times the number of candidates. A task
    holds ``query_block`` queries with their heaps, one tile of that by
    ``tile`` numbers, and reads its share of the stored vectors file by file.
    ``tasks`` (by default eight times the cores) is how many tasks there are at least, as far
    as there are files; with more query blocks than that every block is a task that reads all
    files, so the rows that are merged do not grow with the square of the table.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col)
    kind = "<f4" if dict(rows.dtypes)[vector_col] == "array<float>" else "<f8"
    usable = rows.where(finite(vector) & F.exists(vector, lambda c: c != 0)).select(
        F.col(id_col).cast("bigint").alias("id"),
        (vector if kind == "<f4" else vector.cast("array<double>")).alias("vector"),
    )
    length = usual_length(usable, "vector") or 0
    usable = usable.where(F.size("vector") == length)
    asked = usable.where(F.coalesce(is_query, F.lit(False))).withColumn("first", F.lit(True))
    blocks = max(1, -(-asked.count() // query_block))
    queries = stage(_with_codes(asked.repartition(blocks), kind, length), "queries")
    # A query that is itself among the stored copies needs one more beside it.
    stored = stage(_with_codes(_smallest_copies(usable, k + 1), kind, length), "vectors")
    found = _tiles(
        spark, queries.inputFiles(), stored.inputFiles(), k=k, kind=kind, tile=tile,
        query_block=query_block, tasks=tasks or 8 * spark.sparkContext.defaultParallelism,
    )
    return _merged(found, k)
