"""Where two tables differ: order-free checksums of ranges, cut finer only where they disagree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.session import stage

# A range that disagrees is cut into this many; fewer rows than this are compared one by one.
FAN = 256
LEAF_ROWS = 100_000
WHOLE = ("tinyint", "smallint", "int", "bigint")


def _place(df: DataFrame, keys: list[str]) -> Column:
    """A number that orders rows into ranges: the leading key, or a hash of a key of another kind.

    Rows without a key lie in a range of their own before all others.
    """
    if dict(df.dtypes)[keys[0]] in WHOLE:
        return F.col(f"`{keys[0]}`").cast("decimal(20,0)")
    return F.when(F.col(f"`{keys[0]}`").isNotNull(), F.xxhash64(*[F.col(f"`{k}`") for k in keys])).cast("decimal(20,0)")


def _narrow(df: DataFrame, keys: list[str], columns: list[str], side: str) -> DataFrame:
    """Key, place, and two hashes of the row's columns; NULL hashes unlike any value beside it."""
    cells = [c for name in columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return df.select(
        *[F.col(f"`{k}`").alias(f"key{n}") for n, k in enumerate(keys)], _place(df, keys).alias("place"),
        F.xxhash64(*cells).cast("decimal(20,0)").alias("h1"),
        F.xxhash64(F.lit(7), *cells).cast("decimal(20,0)").alias("h2"), F.lit(side).alias("side"),
    )


def _sums(side: str) -> list[Column]:
    mine = F.col("side") == side
    return [
        F.count_if(mine).alias(f"{side}_rows"),
        *[F.coalesce(F.sum(F.when(mine, F.col(h))), F.lit(0)).alias(f"{side}_{h}") for h in ("h1", "h2")],
    ]


def _differ() -> Column:
    return (
        (F.col("src_rows") != F.col("dest_rows")) | (F.col("src_h1") != F.col("dest_h1"))
        | (F.col("src_h2") != F.col("dest_h2"))
    )


def differing_ranges(
    source: DataFrame, dest: DataFrame, keys: list[str], columns: list[str] | None = None,
    fan: int = FAN, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The ranges in which two tables hold different rows: (first, last, src_rows, dest_rows).

    The range of all keys is cut into ``fan`` parts; those whose row counts or
    sums of row hashes differ are cut again, until they hold ``leaf_rows`` rows
    together or a single key each. Sums do not depend on the order of rows, and are added up
    per task before the shuffle. ``first`` and ``last`` are of the leading
    key if it is a whole number, else of its hash; both are NULL for rows without a key. One pass over
    both tables per level, at most eight for 64 bits; levels cost what they read, the tree is
    never kept whole.
    """
    columns = columns or source.columns
    rows = _narrow(source, keys, columns, "src").unionByName(_narrow(dest, keys, columns, "dest"))
    ends = rows.agg(F.min("place"), F.max("place")).first()
    low, high = (int(end) if end is not None else 0 for end in ends)
    width, differing = high - low + 1, None
    while True:
        finer = max(1, -(-width // fan))
        numbered = rows.withColumn("part", _part(low, finer))
        if differing is not None:
            numbered = numbered.withColumn("above", _part(low, width)).join(
                differing.select(F.col("part").alias("above")), "above", "left_semi"
            )
        sums = numbered.groupBy("part").agg(*_sums("src"), *_sums("dest")).filter(_differ())
        differing = stage(sums.select("part", "src_rows", "dest_rows"), "differing")
        width = finer
        left = differing.agg(F.sum(F.col("src_rows") + F.col("dest_rows"))).first()[0] or 0
        if width == 1 or left <= leaf_rows:
            break
    keyed = F.col("part") >= 0
    first = (F.lit(low).cast("decimal(20,0)") + F.col("part") * F.lit(width).cast("decimal(20,0)")).cast("bigint")
    last = F.least(
        F.lit(high).cast("decimal(20,0)"),
        F.lit(low).cast("decimal(20,0)") + (F.col("part") + 1) * F.lit(width).cast("decimal(20,0)") - 1,
    ).cast("bigint")
    return differing.select(
        F.when(keyed, first).alias("first"), F.when(keyed, last).alias("last"), "src_rows", "dest_rows"
    )


def _part(low: int, width: int) -> Column:
    """The number of the part of ``width`` places that a place lies in; -1 for rows without a key."""
    return F.when(F.col("place").isNull(), F.lit(-1).cast("decimal(20,0)")).otherwise(_whole(low, width))


def _whole(low: int, width: int) -> Column:
    gap = F.col("place") - F.lit(low).cast("decimal(20,0)")
    size = F.lit(width).cast("decimal(20,0)")
    # Without its rest the division is exact.
    return ((gap - gap % size) / size).cast("decimal(20,0)")


def row_differences(
    source: DataFrame, dest: DataFrame, keys: list[str], columns: list[str] | None = None,
    fan: int = FAN, leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The keys at which two tables differ: keys, src_rows, dest_rows and ``kind``.

    ``missing`` at the destination, ``extra`` there, ``lost`` or ``doubled`` copies of a key that both
    hold, or ``changed`` rows. Only rows of differing ranges are grouped by key. Rows
    without a key are compared as one key that is NULL.
    """
    columns = columns or source.columns
    ranges = differing_ranges(source, dest, keys, columns, fan, leaf_rows)
    rows = _narrow(source, keys, columns, "src").unionByName(_narrow(dest, keys, columns, "dest"))
    named = [f"key{n}" for n in range(len(keys))]
    spans = [tuple(row) for row in ranges.select("first", "last").limit(MOST_SPANS + 1).collect()]
    if len(spans) <= MOST_SPANS:  # as literals they reach the scan
        inside = F.lit(False)
        for first, last in _joined(spans):
            inside = inside | (F.col("place").isNull() if first is None else F.col("place").between(first, last))
        rows = rows.filter(inside)
    found = rows.groupBy(*named).agg(*_sums("src"), *_sums("dest")).filter(_differ())
    src, dst = F.col("src_rows"), F.col("dest_rows")
    kind = (
        F.when(dst == 0, "missing").when(src == 0, "extra").when(dst < src, "lost")
        .when(dst > src, "doubled").otherwise("changed")
    )
    return found.select(
        *[F.col(n).alias(k) for n, k in zip(named, keys)], "src_rows", "dest_rows", kind.alias("kind")
    )


# With more ranges than this all rows are compared, which gives the same result.
MOST_SPANS = 1000


def _joined(spans: list[tuple]) -> list[tuple]:
    """Ranges that follow each other as one."""
    out: list[tuple] = []
    for first, last in sorted(spans, key=lambda s: (s[0] is not None, s[0] or 0)):
        if out and first is not None and out[-1][1] is not None and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out
