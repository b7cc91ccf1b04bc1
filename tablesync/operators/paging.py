"""Projection, filters, pages and exact batches over a key order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from tablesync.functions.measures import bar, percent
from tablesync.session import stage

# monotonically_increasing_id() puts the partition above 33 bits of row position.
POSITION_BITS = 33
# A page that ends beyond this many rows is cut by row number, not by a driver top-k.
TOP_K_ROWS = 100_000


def project_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns in the given order."""
    return df.select(*columns)


def after_key(keys: list[str], last: tuple) -> Column:
    """Whether a (composite) key lies after ``last``, compared column by column.

    The leading column is also compared alone, which the scan can push down.
    """
    steps = [
        reduce(
            lambda a, b: a & b,
            [F.col(k) == F.lit(v) for k, v in zip(keys[:i], last[:i])],
            F.col(keys[i]) > F.lit(last[i]),
        )
        for i in range(len(keys))
    ]
    test = reduce(lambda a, b: a | b, steps)
    return test if len(keys) == 1 else (F.col(keys[0]) >= F.lit(last[0])) & test


def keyset_filter(df: DataFrame, keys: list[str], last: tuple | None) -> DataFrame:
    """Rows after the key ``last``; all rows when there is no last key."""
    return df if last is None else df.filter(after_key(keys, last))


def prefix_filter(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def contains_filter(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose text holds ``part`` in any case."""
    return df.filter(F.lower(column).contains(part.lower()))


def exclude_list(df: DataFrame, column: str, excluded: list[str]) -> DataFrame:
    """Rows with a non-empty value outside the list."""
    return df.filter((F.col(column) != "") & ~F.col(column).isin(*excluded))


def total_order(df: DataFrame, keys: list[str]) -> list[str]:
    """The key columns, then all others, so that equal keys have an order too."""
    return keys + [c for c in df.columns if c not in keys]


def ordered_scan(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows in key order (a range-partitioned sort)."""
    return df.orderBy(*total_order(df, keys))


def keyset_page(df: DataFrame, keys: list[str], last: tuple | None, size: int) -> DataFrame:
    """The next ``size`` rows after a key. A whole-table walk uses ``batch_assign``."""
    return offset_page(keyset_filter(df, keys, last), keys, 0, size)


def offset_page(
    df: DataFrame, keys: list[str], offset: int, size: int, top_k_rows: int = TOP_K_ROWS
) -> DataFrame:
    """``size`` rows from position ``offset`` in key order.

    Near the start it is a top-k. Further in, rows are placed in parallel and
    the page is cut out by position, which the scan can skip to: no task
    holds ``offset`` rows. Both give the page in key order.
    """
    order = total_order(df, keys)
    if offset + size <= top_k_rows:
        return df.orderBy(*order).offset(offset).limit(size)
    placed = place_rows(df, order)
    cuts = [F.lit(False)]
    for part, start, n in partition_starts(placed).collect():
        low, high = max(offset - start, 0), min(offset + size - start, n) - 1
        if low <= high:
            base = part << POSITION_BITS
            cuts.append(F.col("_pos").between(base + low, base + high))
    return placed.filter(reduce(lambda a, b: a | b, cuts)).orderBy("_pos").drop("_pos")


def write_rank_index(df: DataFrame, keys: list[str], path: str, step: int = 10_000) -> None:
    """Write every ``step``-th row's place in key order (``row_no``) with its order columns to ``path``.

    The one sort that deep pages need; it holds as long as the table does not change. Each task
    writes the marks of the rows it reads, so the index lies in many files of which each holds few places.
    """
    order = total_order(df, keys)
    marks = number_rows(df, order).filter(F.col("row_no") % step == 0)
    marks.select("row_no", *order).sortWithinPartitions("row_no").write.parquet(path)


def indexed_page(
    df: DataFrame, keys: list[str], index_path: str, offset: int, size: int
) -> DataFrame:
    """The page of ``offset_page``, from a rank index of the same table.

    Two rows of the index say between which rows the page lies. Only these few rows are put in
    order; the leading key's bounds reach the scan.
    """
    order = total_order(df, keys)
    index = df.sparkSession.read.schema(
        T.StructType([T.StructField("row_no", T.LongType()), *[df.schema[c] for c in order]])
    ).parquet(index_path)
    low = index.filter(F.col("row_no") <= offset).orderBy(F.desc("row_no")).first()
    high = index.filter(F.col("row_no") >= offset + size).orderBy("row_no").first()
    if low is None:
        return df.limit(0)
    rows, place = df, F.struct(*order)
    for mark, leading, whole in ((low, ">=", place >= _mark(df, order, low)),
                                 (high, "<=", None if high is None else place <= _mark(df, order, high))):
        if mark is None:
            continue
        rows = rows.filter(whole)
        if mark[order[0]] is not None:  # a NULL comes before all values
            value = F.lit(mark[order[0]]).cast(df.schema[order[0]].dataType)
            first = F.col(order[0])
            rows = rows.filter(first >= value if leading == ">=" else first.isNull() | (first <= value))
    return rows.orderBy(*order).offset(offset - low["row_no"]).limit(size)


def _mark(df: DataFrame, order: list[str], row) -> Column:
    return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in order])


def place_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in the given order over all partitions, with their place in ``_pos``.

    They are range-partitioned and sorted once and written to the shared
    folder, so every later pass sees the same places.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return stage(placed, "placed")


def partition_starts(placed: DataFrame) -> DataFrame:
    """Number of the first row and row count of each partition; one row per partition."""
    part = F.shiftright("_pos", POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0))
    return sizes.select("_part", start.alias("_start"), "n")


def number_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Number all rows 0, 1, 2 … in the given order without gathering them.

    Only one row per partition is summed up and broadcast.
    """
    placed = place_rows(df, order)
    starts = partition_starts(placed).select("_part", "_start")
    position = F.col("_pos").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", F.shiftright("_pos", POSITION_BITS))
        .join(F.broadcast(starts), "_part")
        .withColumn("row_no", F.col("_start") + position)
        .drop("_part", "_start", "_pos")
    )


def batch_assign(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Each row with its number and its batch of ``size`` rows in key order."""
    numbered = number_rows(df, total_order(df, keys))
    return numbered.withColumn("batch_id", F.floor(F.col("row_no") / size).cast("bigint"))


def batch_plan(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """First and last key and row count of each batch; only the last is short.

    Only the key and a hash of the row are sorted. The hash splits a key with
    very many rows over several range partitions. Once rows are numbered, the
    two rows at the edges of each batch are all that is grouped.
    """
    narrow = df.select(*keys, F.xxhash64(*df.columns).alias("_tie"))
    numbered = number_rows(narrow, keys + ["_tie"])
    total = numbered.count()
    place = F.col("row_no") % size
    edge = (place == 0) | (place == size - 1) | (F.col("row_no") == total - 1)
    key = F.struct(*keys)
    batch = F.floor(F.col("row_no") / size).cast("bigint")
    return (
        numbered.filter(edge)
        .groupBy(batch.alias("batch_id"))
        .agg(F.min(key).alias("first"), F.max(key).alias("last"))
        .select(
            "batch_id",
            *[F.col(f"first.{k}").alias(f"first_{k}") for k in keys],
            *[F.col(f"last.{k}").alias(f"last_{k}") for k in keys],
            F.least(F.lit(size), F.lit(total) - F.col("batch_id") * size)
            .cast("bigint")
            .alias("rows"),
        )
    )


def batch_progress(plan: DataFrame, size: int, total_rows: int, width: int = 20) -> DataFrame:
    """Rows done, percentage and bar after each batch of a plan.

    Every batch before the last is full, so the running total follows from
    the batch number and needs no window over the plan.
    """
    done = F.col("batch_id") * size + F.col("rows")
    total = F.lit(total_rows).cast("bigint")
    share = done.cast("double") / total * 100
    return plan.select(
        "batch_id",
        "rows",
        done.alias("processed_rows"),
        total.alias("total_rows"),
        percent(done, total, 2).alias("percent"),
        bar(share, width).alias("bar"),
    )
