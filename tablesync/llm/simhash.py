"""SimHash fingerprints, and the groups of texts whose fingerprints nearly agree.

Fingerprints within the radius agree in all but ``radius`` of any number of
blocks, so equal fingerprints are brought together by every choice of the
blocks that must agree. Within such a bucket they are compared bit-sliced: 64
fingerprints lie across 64 words, one word per bit, and one fingerprint is
compared with all 64 at once by exclusive-or and carry-save counters. A word of
64 comparisons is given up when all of them are beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesync.llm.common import lower_ascii, plain_words, slices, stage, texts_of
from tablesync.llm.graph import components

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_PLACES = np.arange(8) * 256


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 without words."""
    words = plain_words(lower_ascii(text))
    if not words:
        return 0
    joined = b" ".join(words)
    starts = list(accumulate([len(w) + 1 for w in words], initial=0))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), len(words) - width + 1
    for first in range(0, total, 1 << 16):  # bounded memory for very long texts
        last = min(first + (1 << 16), total)
        hashes = np.array(
            [digest(joined[a:b - 1], seed)
             for a, b in zip(starts[first:last], starts[first + width:last + width])], "<u8"
        )
        places = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_PLACES
        counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
        ones += (counts @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
    seed: int = 42,
) -> DataFrame:
    """id, key (a hash of the text) and fingerprint (64 bits as a bigint) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(own.view(np.int64))],
                ["id", "key", "fingerprint"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(compute, f"id {kind}, key bigint, fingerprint bigint")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """For each 64 fingerprints 64 words: word k holds everyone's bit k."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    turned = np.ascontiguousarray(bits.transpose(0, 2, 1))
    return np.packbits(turned, axis=2, bitorder="little").view("<u8")[:, :, 0]


def _low_bits(count: np.ndarray) -> np.ndarray:
    """Words whose ``count`` lowest bits are set, 0 to 64."""
    count = np.clip(count, 0, 64)
    half = np.minimum(count, 63).astype(np.uint64)
    words = (np.uint64(1) << half) - np.uint64(1)
    return np.where(count == 64, ~np.uint64(0), words)


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over the radius."""
    over = np.zeros_like(counters[0])
    equal = ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            over |= equal & counters[k]
            equal = equal & ~counters[k]
    return over


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save addition of three bits: (sum, carry)."""
    either = a ^ b
    return either ^ c, (a & b) | (either & c)


def near_lanes(planes: np.ndarray, values: np.ndarray, query: np.ndarray, block: np.ndarray,
               lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each (query, block of 64), the lanes within the radius: (query, block, lanes)."""
    width = max(2, (radius + 1).bit_length())
    counters = [np.zeros(len(query), np.uint64) for _ in range(width)]
    one = np.uint64(1)
    for bit in range(0, 64, 4):
        asked = values[query]
        differ = [
            planes[block, bit + k] ^ (~np.uint64(0) * (asked >> np.uint64(bit + k) & one))
            for k in range(4)
        ]
        counters[0], first = _add(counters[0], differ[0], differ[1])
        counters[0], second = _add(counters[0], differ[2], differ[3])
        counters[1], carry = _add(counters[1], first, second)
        for k in range(2, width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        lanes = lanes & ~(_beyond(counters, radius) | carry)
        live = np.flatnonzero(lanes)
        if 4 * len(live) <= 3 * len(lanes):  # drop the words that are given up
            query, block, lanes = query[live], block[live], lanes[live]
            counters = [counter[live] for counter in counters]
        if not len(lanes):
            break
    live = np.flatnonzero(lanes)
    return query[live], block[live], lanes[live]


class Forest:
    """Union of links between numbered items, smallest number as root."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up


def link_groups(values: np.ndarray, ends: np.ndarray, radius: int,
                words: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Links that tie together what is within the radius in the same group.

    ``ends`` has for each item the end of its group. At most one link per item
    comes out: the links of a spanning forest.
    """
    planes, forest, count = bit_planes(values), Forest(len(values)), len(values)
    items = np.arange(count)
    asking = items[ends > items + 1]
    first = (asking + 1) // 64
    blocks = (ends[asking] - 1) // 64 - first + 1
    bounds = np.concatenate([[0], np.cumsum(blocks)])
    for low in range(0, int(bounds[-1]), words):
        flat = np.arange(low, min(low + words, int(bounds[-1])))
        at = np.searchsorted(bounds, flat, side="right") - 1
        query, block = asking[at], first[at] + flat - bounds[at]
        lanes = _low_bits(ends[query] - 64 * block) & ~_low_bits(query + 1 - 64 * block)
        query, block, lanes = near_lanes(planes, values, query, block, lanes, radius)
        if len(query):
            hits = np.unpackbits(
                lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            row, lane = np.nonzero(hits)
            forest.join(query[row], 64 * block[row] + lane)
    linked = np.flatnonzero(forest.parent != items)
    return values[linked], values[forest.parent[linked]]


def near_links(
    distinct: DataFrame, *, radius: int = 4, blocks: int = 6, bucket_rows: int = 1 << 16,
    buffer_rows: int = 1 << 18,
) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``radius`` bits.

    ``distinct`` has each ``fingerprint`` once. With ``blocks`` blocks every
    choice of ``blocks - radius`` of them is a bucket key, so no pair is missed;
    more blocks mean more but narrower keys, with the same result. A bucket of
    more than ``bucket_rows`` is dealt into parts, and every two of its parts
    are compared by a task of their own.
    """
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << cuts[b + 1]) - (1 << cuts[b])) for b in chosen)
             for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[
        F.struct(F.lit(n).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("value"))
        for n, mask in enumerate(signed)
    ])
    keyed = distinct.select("fingerprint", F.explode(keys).alias("key")).select(
        "fingerprint", "key.choice", "key.value"
    )
    large = (
        keyed.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > bucket_rows)
        .select("choice", "value", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts"))
    )
    large = stage(large, "buckets")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    pairs = F.filter(
        F.transform(other, lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j"))),
        lambda p: p["i"] < p["j"],
    )
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    if large.isEmpty():
        dealt = keyed.withColumns({"i": F.lit(0), "j": F.lit(0)})
    else:
        dealt = (
            keyed.join(large, ["choice", "value"], "left")
            .withColumn("pair", F.explode(F.when(F.col("parts").isNull(), alone).otherwise(pairs)))
            .select("fingerprint", "choice", "value", "pair.i", "pair.j")
        )
    grouping = ["choice", "value", "i", "j"]
    ordered = dealt.repartition(*grouping).sortWithinPartitions(*grouping)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows
            if not rows:
                return
            whole = np.concatenate(held, axis=1)
            new = np.concatenate([[True], (whole[1:, 1:] != whole[1:, :-1]).any(axis=0)])
            starts = np.flatnonzero(new)
            done = len(new) if last else int(starts[-1])
            if done:
                starts = starts[starts < done]
                sizes = np.diff(np.append(starts, done))
                ends = np.repeat(starts + sizes, sizes)
                kept = ends - np.repeat(starts, sizes) > 1  # alone in its bucket: nothing to compare
                values = whole[0, :done][kept].view(np.uint64)
                sizes = sizes[sizes > 1]
                a, b = link_groups(values, np.repeat(np.cumsum(sizes), sizes), radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                )
            held, rows = [whole[:, done:]], len(new) - done

        for batch in batches:
            held.append(np.stack([
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("fingerprint", *grouping)
            ]))
            rows += batch.num_rows
            if rows >= buffer_rows:
                yield from flush(False)
        yield from flush(True)

    return ordered.mapInArrow(link, "a bigint, b bigint")


def classes(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
    seed: int = 42, radius: int = 4, blocks: int = 6,
) -> DataFrame:
    """id, key (a hash of the text), fingerprint, root (a fingerprint of its component) and
    component_id of every row. See ``near_duplicates``."""
    own = stage(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed),
                "fingerprints")
    firsts = own.groupBy("fingerprint").agg(F.min("id").alias("first"))
    tied = components(near_links(firsts.select("fingerprint"), radius=radius, blocks=blocks))
    rooted = stage(
        firsts.join(tied.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
        ), "roots",
    )
    smallest = stage(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    return own.join(rooted.join(smallest, "root").drop("first"), "fingerprint")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """id, fingerprint (16 lower-case hex digits) and component_id of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id that links lead to, its own included.
    Words are lower-cased (A-Z) and split at ASCII white space; a text of fewer
    words than a shingle is one shingle.

    A null or empty text, or one without words, has fingerprint 0 and is linked
    like any other. Equal texts, and repeated rows, have equal fingerprints and
    so one component. Null ids are never smallest; a component of null ids only
    has a null id. Extra columns are not looked at. No rows give no rows. Texts
    of any length are read whole. ``options`` are those of ``classes``.
    """
    return classes(docs, id_col=id_col, **options).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay when of each component one row does.

    That is a row with the smallest id (null ids last), of those the one whose
    text has the smallest hash; of rows that are equal in both, any one.
    """
    found = classes(docs, id_col=id_col, text_col=text_col, **options)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    stays = found.groupBy("root").agg(F.min(place).alias("place")).select("place.id", "place.key")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("key"))
    same = F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r.key") == F.col("s.key"))
    left = rows.alias("r").join(stays.alias("s"), same, "left_semi")
    nth = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.xxhash64("row")))
    return left.withColumn("nth", nth).where("nth = 1").select("row.*")
