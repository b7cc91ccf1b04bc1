"""Where the keys of files and folders lie, so that only those a range or a key needs are read.

A zone is a file or a folder with its smallest and largest key. Keys are
compared column by column, NULL first, as Spark sorts them.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.paging import after_key, keyset_filter

# Files of a table that is sorted for ranges hold about this many rows.
ROWS_PER_FILE = 1_000_000
# Bits per key of a Bloom filter, how many of them a key sets, and bits per stored piece. All bits
# of a key lie in one piece.
BITS_PER_KEY = 10
HASHES = 3
PIECE_BITS = 32768
# A folder's number stands above so many bits of a piece's.
SLOT_BITS = 40


def key_range(df: DataFrame, keys: list[str], after: tuple | None, upto: tuple | None) -> DataFrame:
    """Rows with ``after < key <= upto``; without a lower end also those without a key."""
    rows = keyset_filter(df, keys, after)
    if upto is None:
        return rows
    return rows.filter(~F.coalesce(after_key(keys, upto), F.lit(False)))


def sort_value(key: Sequence) -> tuple:
    """A key in a form that Python orders as Spark does: NULL first, NaN last, texts by bytes."""
    parts = []
    for value in key:
        if value is None:
            parts.append((0, 0))
        elif isinstance(value, float) and math.isnan(value):
            parts.append((2, 0))
        elif isinstance(value, str):
            parts.append((1, value.encode()))
        else:
            parts.append((1, bytes(value) if isinstance(value, bytearray) else value))
    return tuple(parts)


@dataclass(frozen=True)
class Zone:
    path: str
    first: tuple
    last: tuple
    rows: int


@dataclass
class ZoneMap:
    """The files of a stored table with their bounds; one short row per file."""

    spark: SparkSession
    schema: T.StructType
    keys: list[str]
    zones: list[Zone] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(zone.rows for zone in self.zones)

    def between(self, after: tuple | None, upto: tuple | None) -> list[Zone]:
        """The files that can hold keys with ``after < key <= upto``."""
        low = None if after is None else sort_value(after)
        high = None if upto is None else sort_value(upto)
        return [
            zone for zone in self.zones
            if (low is None or sort_value(zone.last) > low)
            and (high is None or sort_value(zone.first) <= high)
        ]

    def read(self, after: tuple | None = None, upto: tuple | None = None) -> DataFrame:
        """The rows of a range, from the files that can hold them."""
        files = [unquote(zone.path) for zone in self.between(after, upto)]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return key_range(self.spark.read.schema(self.schema).parquet(*files), self.keys, after, upto)

    def range_ends(self, rows_per_range: int) -> list[tuple | None]:
        """The last keys of ranges of ``rows_per_range`` rows, the last one open.

        The files are sorted and follow each other, so a row's number is its
        place in its file after the rows of earlier files.
        """
        ordered = sorted(self.zones, key=lambda z: (sort_value(z.first), sort_value(z.last)))
        starts, before = [], 0
        for zone in ordered:
            starts.append((zone.path, before))
            before += zone.rows
        if before <= rows_per_range:
            return [None]
        offsets = self.spark.createDataFrame(starts, "_path string, _start bigint")
        place = F.col("_start") + F.col("_row") + 1
        stored = self.spark.read.schema(self.schema).parquet(*[unquote(z.path) for z in ordered])
        ends = (
            stored.select(*self.keys, F.col("_metadata.file_path").alias("_path"),
                          F.col("_metadata.row_index").alias("_row"))
            .join(F.broadcast(offsets), "_path")
            .filter((place % rows_per_range == 0) & (place < before))
            .select(place.alias("_place"), *self.keys).orderBy("_place").collect()
        )
        return [*(tuple(row)[1:] for row in ends), None]


def zone_map(stored: DataFrame, keys: list[str]) -> ZoneMap:
    """The bounds of every file of a table that is read from Parquet; reads the keys once."""
    key = F.struct(*keys)
    found = (
        stored.select(F.col("_metadata.file_path").alias("path"), key.alias("key"))
        .groupBy("path").agg(F.min("key").alias("first"), F.max("key").alias("last"),
                             F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    zones = [Zone(r["path"], tuple(r["first"]), tuple(r["last"]), r["rows"]) for r in found]
    return ZoneMap(stored.sparkSession, stored.schema, keys, zones)


def sorted_zones(df: DataFrame, keys: list[str], path: str, files: int) -> ZoneMap:
    """Write ``df`` in key order to ``path``; every file holds a range of keys.

    ``df`` is read twice, once for the ends of the files. A row's place is the
    last thing that is compared, so a key with very many rows is split too.
    """
    placed = df.repartitionByRange(files, *keys, F.monotonically_increasing_id())
    placed.sortWithinPartitions(*keys).write.parquet(path)
    return zone_map(df.sparkSession.read.schema(df.schema).parquet(path), keys)


def clustered(zones: ZoneMap, ends: list[tuple | None], path: str, files: int) -> ZoneMap:
    """The same rows in files of which every range needs few.

    They are left as they are if all ranges together read at most twice the rows,
    else they are sorted into new files below ``path``.
    """
    starts = [None, *ends[:-1]]
    read = sum(z.rows for after, upto in zip(starts, ends) for z in zones.between(after, upto))
    if read <= 2 * zones.rows or not zones.zones:
        return zones
    return sorted_zones(zones.read(), zones.keys, path, files)


def file_count(rows: int, ranges: int) -> int:
    """How many files a table of ``rows`` rows is sorted into for ``ranges`` ranges."""
    return max(1, ranges, -(-rows // ROWS_PER_FILE))


# --- bounds and Bloom filters of a table's folders -------------------------------------------


def folder_uri(spark: SparkSession, folder: str) -> str:
    """A folder as the file paths of its rows begin."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:/", system.makeQualified(place).toUri().toString())


def with_folder(spark: SparkSession, folders: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of folders, and in ``_folder`` the one each lies in."""
    names = spark.createDataFrame(
        [(folder_uri(spark, f), f) for f in folders], "_uri string, _folder string"
    )
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(*folders)
    # The folder of a file's path, in plain string functions: they run once a row.
    name = F.substring_index("_metadata.file_path", "/", -1)
    folder = F.substring(F.col("_metadata.file_path"), F.lit(1), F.length("_metadata.file_path") - F.length(name) - 1)
    local = F.concat(F.lit("file:/"), F.ltrim(F.substring(folder, 6, 1 << 30), F.lit("/")))
    uri = F.when(folder.startswith("file:/"), local).otherwise(folder)
    return rows.select("*", uri.alias("_uri")).join(F.broadcast(names), "_uri").drop("_uri")


def key_piece(keys: list[str], bits: Column) -> Column:
    """The piece of a filter of ``bits`` bits that holds all bits of a key."""
    return F.pmod(F.xxhash64(F.lit(HASHES), *keys), F.floor(bits / PIECE_BITS).cast("bigint"))


def key_bits(keys: list[str]) -> Column:
    """The bits of its piece that a key sets."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(n), *keys), F.lit(PIECE_BITS)) for n in range(HASHES)])


@dataclass(frozen=True)
class FolderZones:
    """What is stored beside a table about the keys of its folders."""

    bounds: DataFrame  # folder, first, last, rows, bits
    pieces: DataFrame  # folder, piece, set


def folder_zones(spark: SparkSession, path: str, folders: Sequence[str], keys: list[str]) -> FolderZones:
    """Bounds and filters of ``folders`` of the table at ``path``.

    Those that have none yet are read once, keys only, and theirs are kept beside the
    table; a folder never changes, so neither do its bounds.
    """
    kinds = {f.name: f.dataType for f in spark.read.parquet(*folders).schema}
    key = T.StructType([T.StructField(k, kinds[k]) for k in keys])
    bounds_schema = T.StructType([
        T.StructField("folder", T.StringType()), T.StructField("first", key), T.StructField("last", key),
        T.StructField("rows", T.LongType()), T.StructField("bits", T.LongType()),
    ])
    piece_schema = "folder string, piece bigint, set binary"
    # The empty tables are there so that a first look finds folders to read.
    # Filters below "zones" spread a key's bits over several pieces; those are not read any more.
    place = f"{path}/blocks/{'-'.join(keys)}"
    if not folder_exists(spark, place):
        spark.createDataFrame([], bounds_schema).write.parquet(f"{place}/bounds/none")
        spark.createDataFrame([], piece_schema).write.parquet(f"{place}/pieces/none")

    def stored(kind: str, schema) -> DataFrame:
        reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(f"{place}/{kind}").filter(F.col("folder").isin(list(folders)))

    known = {row["folder"] for row in stored("bounds", bounds_schema).select("folder").collect()}
    missing = [f for f in folders if f not in known]
    if missing:
        # Rows are grouped by a folder's number, which is sorted faster than its name.
        numbers = F.broadcast(spark.createDataFrame(list(enumerate(missing)), "_number bigint, folder string"))
        rows = with_folder(spark, missing).join(numbers, F.col("_folder") == F.col("folder")).select("_number", *keys)
        key, name = F.struct(*keys), uuid.uuid4().hex
        rows.groupBy("_number").agg(
            F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows"),
        ).join(numbers, "_number").select(
            "folder", "first", "last", "rows",
            (F.ceil(F.col("rows") * BITS_PER_KEY / PIECE_BITS).cast("bigint") * PIECE_BITS).alias("bits"),
        ).write.parquet(f"{place}/bounds/{name}")
        sizes = spark.read.schema(bounds_schema).parquet(f"{place}/bounds/{name}").select("folder", "bits")
        sizes = F.broadcast(sizes.join(numbers, "folder").select("_number", F.col("bits").alias("_bits")))
        slot = F.shiftleft("_number", SLOT_BITS) + key_piece(keys, F.col("_bits"))
        (
            rows.join(sizes, "_number")
            .select(slot.alias("slot"), F.explode(key_bits(keys)).alias("bit"))
            .groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("set"))
            .withColumn("_number", F.shiftright("slot", SLOT_BITS)).join(numbers, "_number")
            .select("folder", F.col("slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).alias("piece"), "set")
            .write.parquet(f"{place}/pieces/{name}")
        )
    return FolderZones(stored("bounds", bounds_schema), stored("pieces", piece_schema))


def folders_of_keys(batch_keys: DataFrame, zones: FolderZones, keys: list[str]) -> DataFrame:
    """The folders that may hold each key, by their bounds and then by their filters.

    Gives the key columns and ``folder``; keys that no folder can hold are left out. The
    bounds are one row per folder. A key with a NULL lies in no folder.
    """
    key = F.struct(*[F.col(f"k.`{k}`") for k in keys])
    near = batch_keys.dropna(subset=keys).alias("k").join(
        F.broadcast(zones.bounds.alias("z")),
        (key >= F.col("z.first")) & (key <= F.col("z.last")),
    ).select(*[F.col(f"k.`{k}`").alias(k) for k in keys], "folder", "bits")
    asked = near.select(*keys, "folder", key_piece(keys, F.col("bits")).alias("piece"))
    # One row for each key and folder meets the one piece that can hold the key.
    found = asked.join(zones.pieces, ["folder", "piece"])
    return found.filter(F.forall(key_bits(keys), _is_set)).select(*keys, "folder")


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("set"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.call_function("shiftright", byte.cast("int"), (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))
