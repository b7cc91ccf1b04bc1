"""Joins and row picks that hold when one key owns a third of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from tablesync.session import stage

# A key counts as hot once it would fill this part of an even shuffle partition. The summary keeps
# at most 1 / LEAST_SHARE keys; beyond 2,500 partitions it no longer follows their number, and keys
# of up to that share (four partitions of 20,000) are left to the adaptive skew join.
HOT_PART = 0.5
LEAST_SHARE = 0.0002
# A measured set of keys up to this size is broadcast. It counts what a row takes in a hash table.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 48


def hot_share(spark: SparkSession) -> float:
    """The share of the rows from which on a key is hot; it falls with the number of partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SHARE, HOT_PART / max(partitions, 1))


def hot_key_hashes(df: DataFrame, keys: list[str], share: float | None = None) -> list[int]:
    """Hashes of every key that owns at least ``share`` of the rows.

    One pass over the key columns with a map-side summary (``freqItems``
    misses no such key and keeps at most ``1 / share`` candidates per task),
    so what reaches the driver is bounded by ``share`` and not by the data.
    NULL keys count like any other, so many missing references spread too.
    """
    share = hot_share(df.sparkSession) if share is None else share
    row = df.select(F.xxhash64(*keys).alias("h")).stat.freqItems(["h"], share).first()
    return list(row[0] or [])


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, share: float | None = None
) -> DataFrame:
    """``left.join(right, keys, how)`` for a ``left`` that may have hot keys.

    ``right`` holds each key once. Rows of hot keys are spread over all
    shuffle partitions by their place, equal rows too, and the few hot keys
    of ``right`` are repeated once per salt; every other row is joined as
    usual. Catalyst and AQE still choose a broadcast when ``right`` is small
    enough by their own size check. The columns of ``left`` keep their order.

    If ``left`` itself comes out of a shuffle, its rows are written first: a task that is run
    again after a loss may see them in another order, and a place must not change meanwhile.
    """
    more = [] if how in ("left_anti", "left_semi") else right.columns
    columns = left.columns + [c for c in more if c not in keys]
    hot = hot_key_hashes(left, keys, share)
    if not hot:
        return left.join(right, keys, how).select(*columns)
    if _is_shuffled(left):
        left = stage(left, "salted")
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.xxhash64(*keys).isin(hot)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    salted_left = left.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
    salted_right = right.withColumn(
        "_salt",
        F.explode(
            F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return salted_left.join(salted_right, keys + ["_salt"], how).select(*columns)


def _is_shuffled(df: DataFrame) -> bool:
    """Whether rows come out of a shuffle; a broadcast leaves the rows beside it in their order."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Exchange" in plan.replace("BroadcastExchange", "")


def value_bytes(field: T.StructField) -> Column | int:
    """Bytes of a column's values: texts and bytes by length, nested values as their JSON."""
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.col(f"`{field.name}`"))), F.lit(0))
    return kind_bytes(kind)


def kind_bytes(kind: T.DataType) -> int:
    """Bytes of a value of a type of fixed width."""
    if isinstance(kind, T.DecimalType):
        return 8 if kind.precision <= 18 else 16
    narrow = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    return narrow.get(kind.simpleString(), 8)


def data_bytes(df: DataFrame, row_bytes: int = 0) -> int:
    """Bytes of the values of ``df``, and ``row_bytes`` more for each row."""
    sizes = [value_bytes(f) for f in df.schema]
    fixed = row_bytes + sum(size for size in sizes if isinstance(size, int))
    total = reduce(lambda a, b: a + b, [s for s in sizes if not isinstance(s, int)], F.lit(fixed))
    return df.agg(F.sum(total.cast("bigint"))).first()[0] or 0


def join_on_key_set(
    left: DataFrame, key_set: DataFrame, keys: list[str], how: str,
    broadcast_bytes: int = BROADCAST_BYTES, write_out: bool = True,
) -> DataFrame:
    """Join rows with a set of keys that may be small or as large as the rows.

    The set is measured first. Up to ``broadcast_bytes`` it is broadcast, and
    ``left``, whatever its size and skew, is neither shuffled nor looked
    through for hot keys. A larger set is joined by shuffling.

    A set that took work to find is written out, so that measuring does not
    find it twice. Leave that out for columns read as they are.
    """
    found = stage(key_set, "keys") if write_out else key_set
    if data_bytes(found, ROW_BYTES) > broadcast_bytes:
        return salted_join(left, found, keys, how)
    more = [] if how in ("left_anti", "left_semi") else found.columns
    columns = left.columns + [c for c in more if c not in keys]
    return left.join(F.broadcast(found), keys, how).select(*columns)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``.

    ``row_number() = 1`` makes Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a hot key shuffles one row per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order_cols])


def earliest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order_cols])
