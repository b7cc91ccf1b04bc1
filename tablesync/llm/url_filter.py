"""URL filters by host and path rules, looked up in a sorted digest array.

The rules are stored once as Arrow files in the shared folder: 64-bit xxhash
keys in order, with the full rule beside each key. Tasks memory-map the files,
probe all candidate prefixes of a batch of URLs with one binary search per file
and compare the stored text before a hit counts, so a digest collision never
decides anything.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import file_system, fresh_path, qualified, slices, stage

_INDEX = pa.schema([("digest", pa.uint64()), ("rule", pa.string()), ("verdict", pa.string())])
_RESULT = "id {id}, host string, path string, rule string, verdict string"
_RULES_PER_FILE = 1_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path. Null, or a text without ``://``, has neither."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return host, path[:stop]


def _digests(keys: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64, len(keys))


def build_index(rules: DataFrame, shards: int | None = None) -> DataFrame:
    """Write ``rules`` (host, path, verdict) as digest arrays.

    Returns one row per file: path, first and last digest. There are ``shards`` files, by default one
    for every million rules. Rules that are given
    twice are stored once; of one rule with both verdicts, ``block`` stays.
    Rules without a host or a verdict are no rules; a null path is empty.
    """
    spark = rules.sparkSession
    target = qualified(spark, fresh_path(spark, "url-index"))
    shards = shards or -(-rules.count() // _RULES_PER_FILE) or 1
    keyed = (
        rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .groupBy(F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"))
        .agg(F.max("verdict").alias("verdict"))
    )

    def add_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rule = batch.column("rule")
            # Spark orders signed numbers: the top bit is flipped to keep the unsigned order.
            place = (_digests(rule.to_pylist()) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), rule, batch.column("verdict")], ["place", "rule", "verdict"]
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = None
        for batch in batches:
            if not batch.num_rows:
                continue
            digest = batch.column("place").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
            if sink is None:
                system, folder = file_system(target)
                system.create_dir(folder, recursive=True)
                name = f"{uuid.uuid4().hex}.arrow"
                stream = system.open_output_stream(f"{folder}/{name}")
                sink, first = pa.ipc.new_file(stream, _INDEX), digest[0]
            sink.write(pa.record_batch(
                [pa.array(digest), batch.column("rule"), batch.column("verdict")], schema=_INDEX
            ))
            last = digest[-1]
        if sink is not None:
            sink.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({
                "file": [f"{target}/{name}"], "first": [str(first)], "last": [str(last)]
            })

    placed = keyed.mapInArrow(add_digests, "place bigint, rule string, verdict string")
    ordered = placed.repartitionByRange(shards, "place").sortWithinPartitions("place", "rule")
    return stage(ordered.mapInArrow(write, "file string, first string, last string"), "url-files")


def _open(path: str) -> tuple[np.ndarray, pa.Table]:
    """An index file: memory-mapped where the shared folder is mounted, else read."""
    system, place = file_system(path)
    if system.type_name == "local":
        source = pa.memory_map(place)
    else:
        source = pa.BufferReader(system.open_input_file(place).read_buffer())
    stored = pa.ipc.open_file(source).read_all()
    return stored.column("digest").to_numpy(), stored


class _Index:
    """The files of an index, each opened once a digest within its bounds is asked for."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files, self.opened = files, {}

    def holding(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Table]]:
        for path, first, last in self.files:
            if not ((wanted >= np.uint64(first)) & (wanted <= np.uint64(last))).any():
                continue
            if path not in self.opened:
                self.opened[path] = _open(path)
            yield self.opened[path]


def _probe(keys: list[str], files: Iterable[tuple[np.ndarray, pa.Table]]) -> dict[str, str]:
    """The stored rules among ``keys``, with their verdicts."""
    found: dict[str, str] = {}
    wanted = _digests(keys)
    for digests, stored in files:
        at = np.searchsorted(digests, wanted)
        for i in np.flatnonzero(digests[np.minimum(at, len(digests) - 1)] == wanted):
            k = int(at[i])
            while k < len(digests) and digests[k] == wanted[i]:  # rules may share a digest
                if stored.column("rule")[k].as_py() == keys[i]:
                    found[keys[i]] = stored.column("verdict")[k].as_py()
                k += 1
    return found


def _candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """All rules that could fit, longest first; of equally long ones the longer host first."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    paths = [path[:n] for n in lengths if n <= len(path)]
    return sorted((h + p for h in hosts for p in paths if h), key=len, reverse=True)


def judge_urls(
    pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", shards: int | None = None,
) -> DataFrame:
    """Host, path, the rule that decides, and the verdict for every URL.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits
    its host and all subdomains where the URL's path starts with the rule's
    path; the longest fitting rule wins, of equally long ones that with the
    longer host. A URL that no stored rule fits gets ``default`` and a null rule.

    One row per input row, repeated rows included. A null URL, an empty one and
    one without ``://`` have an empty host and path and get ``default``. Ids may
    be null or repeat. Extra columns are not looked at. Without rules every URL
    gets ``default``; empty pages give an empty result. Long URLs are looked up
    with as many prefixes as rules have different path lengths.
    """
    index = build_index(rules, shards)
    # One short row per file and one number per path length: both bounded by their parameters.
    files = sorted((row["file"], int(row["first"]), int(row["last"])) for row in index.collect())
    lengths = sorted(
        row["n"] for row in rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .select(F.char_length(F.coalesce("path", F.lit(""))).alias("n")).distinct().collect()
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _Index(files)
        for batch in slices(batches, 4096):
            parts = [split_url(url) for url in batch.column("url").to_pylist()]
            wanted = [_candidates(host, path, lengths) for host, path in parts]
            asked = list(dict.fromkeys(k for keys in wanted for k in keys))
            hits = _probe(asked, opened.holding(_digests(asked)))
            chosen = [next((k for k in keys if k in hits), None) for keys in wanted]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"),
                pa.array([host for host, _ in parts], pa.string()),
                pa.array([path for _, path in parts], pa.string()),
                pa.array(chosen, pa.string()),
                pa.array([hits.get(rule, default) for rule in chosen], pa.string()),
            ], ["id", "host", "path", "rule", "verdict"])

    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(judge, _RESULT.format(id=kind)).withColumnRenamed("id", id_col)
