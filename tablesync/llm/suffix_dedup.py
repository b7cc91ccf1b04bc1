"""Removes byte strings that occur earlier in the corpus, by prefix doubling.

Names of 1, 2, 4, ... 32 bytes at every place are made inside the tasks, each
from the two names of half its length. Sorting all places would move many
times the corpus, so only some places go on: of the 69 names of 32 bytes in any
100 bytes the smallest marks the place that stands for that string, which
depends on nothing but the string, so equal strings are always sorted by equal
marked names. Spark sorts the marked places at growing length:

* by the name of 32 bytes: a name that is nowhere else is done with, and so are
  all strings it stands for;
* by the stretch of text that a marked place stands for: later copies of a whole
  stretch are removed, its first copy goes on if the name has other stretches;
* by the name of 66 bytes to one side, within which the strings of 100 bytes,
  now past the threshold, are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import slices, stage, texts_of

LENGTH = 100
GRAM = 32
SIDE = 34
_REACH = LENGTH - GRAM
_BUFFER_TEXTS = 1 << 16
_PLACE_BITS = 24
# What a stretch's row says: to be sorted out, a later copy that goes, one to look into for sure.
OPEN, GONE, SHARED = 0, 1, 2
# What a side's row says: its name goes string by string, a side, one string, a run that goes.
SPREAD, SIDE_ROW, STRING, RUN = 0, 1, 2, 3
_SLOT_BITS = 22
_LAST_ID = (1 << 63) - 1
_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Limits:
    """What a task holds, and from when on it deals the rows of a common name out.

    ``buffer_bytes`` of texts are marked at a time. A name with more than ``name_contents`` contents
    in a buffer, or that occurs in ``name_buffers`` buffers of a task, is dealt out by content; so is
    one with more than ``side_rows`` longer sides in a task, or ``group_rows`` in all, string by
    string. ``remembered`` names or strings are known at a time. No value changes a result.
    """

    buffer_bytes: int = 2 << 20
    name_contents: int = 16
    name_buffers: int = 4
    side_rows: int = 64
    group_rows: int = 4096
    remembered: int = 1 << 16


class _Sent:
    """The smallest order that a task has sent of a key. Forgetting one only sends more."""

    def __init__(self, limit: int):
        self.limit, self.least = limit, {}

    def compare(self, key, order: tuple) -> int:
        """1 if an earlier one was sent, 0 for the same one, -1 if this is the earliest so far."""
        known = self.least.get(key)
        if known is not None and known <= order:
            return int(known < order)
        if known is None and len(self.least) >= self.limit:
            self.least.clear()
        self.least[key] = order
        return -1


class _Watch:
    """Names that a task meets in buffer after buffer, and what it has sent of them.

    Occurrences are counted in slots, which several names may share: a name is watched too early at
    worst. Once too many are watched all are forgotten, and names must occur twice as often.
    """

    def __init__(self, limits: Limits):
        self.counts = np.zeros(1 << _SLOT_BITS, np.uint16)
        self.limits, self.from_count = limits, limits.name_buffers
        self._forget()

    def _forget(self) -> None:
        self.names = np.empty(0, np.uint64)
        self.sent = _Sent(self.limits.remembered)
        self.opened: dict[int, bytes] = {}  # the first content of a name that went to its place
        self.shared: set[int] = set()  # names of which two contents did

    def has(self, name: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.zeros(len(name), bool)
        at = np.searchsorted(self.names, name)
        return self.names[np.minimum(at, len(self.names) - 1)] == name

    def count(self, name: np.ndarray) -> None:
        """Count the distinct names of a buffer and watch those that have occurred often enough."""
        slot = name & np.uint64(len(self.counts) - 1)
        self.counts[slot] = np.minimum(self.counts[slot], np.uint16(0xFFFE)) + np.uint16(1)
        often = name[self.counts[slot] >= self.from_count]
        new = often[~self.has(often)]
        if len(new) + len(self.names) > 4 * self.limits.remembered:
            self._forget()
            self.from_count *= 2
        elif len(new):
            self.names = np.union1d(self.names, new)

    def kind(self, name: int, content: bytes, order: tuple) -> int | None:
        """What becomes of the first stretch of a content in a buffer; None: it was sent before.

        A name is shared once two different contents have gone to its place from here: from then on
        its other contents need not go there.
        """
        known = self.sent.compare((name, content), order)
        if known >= 0:
            return GONE if known else None
        if name in self.shared:
            return SHARED
        if self.opened.setdefault(name, content) != content:
            self.shared.add(name)
        return OPEN


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for a pair of names."""
    out = a * _ODD[0]
    out += b * _ODD[1]
    out ^= out >> np.uint64(29)
    out *= _ODD[1]
    out ^= out >> np.uint64(32)
    return out


def names(data: np.ndarray) -> np.ndarray:
    """The names of the GRAM bytes from every place on that has so many."""
    name, size = _SEEDS[data], 1
    while size < GRAM:
        name = _mix(name[:-size], name[size:])
        size *= 2
    return name


def marks(gram: np.ndarray) -> np.ndarray:
    """For every string of LENGTH bytes the place of its smallest name, the leftmost of equals."""
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least, size = (gram & ~low) | np.arange(len(gram), dtype=np.uint64), 1
    while 2 * size <= _REACH + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = _REACH + 1 - size
    least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
    return (least & low).astype(np.int64)


def stretches(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The marked places of some texts: doc, place, far, near, name, content.

    A marked place stands for the strings that start ``near`` to ``far`` bytes
    before it; ``content`` is the 128-bit digest of the text they cover, as two numbers.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    if len(data) < LENGTH:
        return {}
    gram = names(data)
    mark = marks(gram)
    starts = np.arange(len(mark))
    doc = np.searchsorted(bounds, starts, side="right") - 1
    inside = starts + LENGTH <= bounds[doc + 1]
    starts, mark, doc = starts[inside], mark[inside], doc[inside]
    if not len(starts):
        return {}
    new = np.ones(len(starts), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    place = mark[first]
    far, near = place - starts[first], place - starts[last]
    digest, spans = xxhash.xxh3_128_digest, zip(
        starts[first].tolist(), (starts[last] + LENGTH).tolist(), (far << 8 | near).tolist()
    )
    content = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b, seed in spans]), "<u8")
    return {"doc": doc[first], "place": place - bounds[doc[first]], "far": far, "near": near,
            "name": gram[place], "content": content.reshape(-1, 2)}


def _binary(content: np.ndarray) -> pa.Array:
    """Digests of two numbers each as a column of 16 bytes."""
    ends = pa.py_buffer(np.arange(len(content) + 1, dtype=np.int32) * 16)
    return pa.Array.from_buffers(pa.binary(), len(content), [None, ends, pa.py_buffer(content.tobytes())])


def _pack(place: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    return place << 14 | far << 7 | near


def unpack(packed: int) -> tuple[int, int, int]:
    return packed >> 14, packed >> 7 & 127, packed & 127


def _mark_documents(batches: Iterator[pa.RecordBatch], limits: Limits = Limits()) -> Iterator[pa.RecordBatch]:
    """(name, content, oid, key, packed, kind) of every stretch.

    Later copies within what a task holds at a time are GONE; they are dealt out
    by document, so that a text with very many copies sends few rows to the
    place of its name. A name with more contents than ``name_contents`` at a time is
    shared beyond doubt: two of them tell so at its place, the others are
    SHARED and dealt out by content. The same is done for names that a task
    meets in buffer after buffer, with what it remembers of former ones, so that
    a name sends a task's few rows to one place and not a buffer's.
    """
    watch = _Watch(limits)

    def flush(texts, oids, keys, begin=0) -> pa.RecordBatch | None:
        found = stretches(texts)
        if not found:
            return None
        found["place"] += begin
        order = sorted(range(len(texts)), key=lambda n: (oids[n], keys[n]))
        rank = np.empty(len(texts), np.int64)
        rank[order] = np.cumsum([0] + [
            (oids[a], keys[a]) != (oids[b], keys[b]) for a, b in zip(order, order[1:])
        ])
        own = rank[found["doc"]]
        turn = np.lexsort((found["place"], own, found["content"][:, 1], found["content"][:, 0], found["name"]))
        name, content, doc, place = (found[c][turn] for c in ("name", "content", "doc", "place"))
        own = own[turn]
        again = np.zeros(len(turn), bool)
        again[1:] = (name[1:] == name[:-1]) & (content[1:] == content[:-1]).all(axis=1)
        same = np.zeros(len(turn), bool)  # the same row of the table a second time
        same[1:] = again[1:] & (own[1:] == own[:-1]) & (place[1:] == place[:-1])
        packed = _pack(place, found["far"][turn], found["near"][turn])
        oid, key = np.array(oids, np.int64)[doc], np.array(keys, np.int64)[doc]
        firsts = np.flatnonzero(~again)
        own_name = name[firsts]
        starts = np.flatnonzero(np.append(True, own_name[1:] != own_name[:-1]))
        sizes = np.diff(np.append(starts, len(firsts)))
        nth = np.arange(len(firsts)) - np.repeat(starts, sizes)
        spread = firsts[(np.repeat(sizes, sizes) > limits.name_contents) & (nth >= 2)]
        kind = np.where(again, GONE, OPEN).astype(np.int8)
        kind[spread] = SHARED
        by_row = _mix(oid.view(np.uint64), key.view(np.uint64))  # copies have one key, not one id
        for at in firsts[watch.has(own_name)].tolist():
            own_kind = watch.kind(int(name[at]), content[at].tobytes(), (int(oid[at]), int(key[at]), int(packed[at])))
            same[at] |= own_kind is None
            kind[at] = OPEN if own_kind is None else own_kind
        watch.count(own_name[starts])
        route = np.where(kind == GONE, by_row, name)
        dealt = kind == SHARED
        route[dealt] = _mix(name[dealt], content[dealt, 0])
        route = route.view(np.int64)
        kept = ~same
        numbers = [pa.array(c[kept]) for c in (route, oid, key, packed, kind)]
        numbers.insert(1, _binary(content[kept]))
        return pa.RecordBatch.from_arrays(numbers, ["name", "content", "oid", "key", "packed", "kind"])

    texts: list[bytes] = []
    oids: list[int] = []
    keys: list[int] = []
    held = 0
    for batch in slices(batches, 64):
        for text, oid, key in zip(texts_of(batch), batch["oid"].to_pylist(), batch["key"].to_pylist()):
            if len(text) > limits.buffer_bytes:  # in parts; a string lies wholly in the one it starts in
                for begin in range(0, len(text) - LENGTH + 1, limits.buffer_bytes):
                    part = text[begin:begin + limits.buffer_bytes + LENGTH - 1]
                    if (out := flush([part], [oid], [key], begin)) is not None:
                        yield out
                continue
            if held + len(text) > limits.buffer_bytes or len(texts) >= _BUFFER_TEXTS:
                if (out := flush(texts, oids, keys)) is not None:
                    yield out
                texts, oids, keys, held = [], [], [], 0
            texts.append(text)
            oids.append(oid)
            keys.append(key)
            held += len(text)
    if (out := flush(texts, oids, keys)) is not None:
        yield out


_STRETCH = "name bigint, content binary, oid bigint, key bigint, packed bigint, kind tinyint"


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted stretches those that are removed (``known``) and those to look into.

    Rows come by kind, name, content and order. Of a name the state is one row.
    """
    columns = ("kind", "name", "content", "oid", "key", "packed")
    heads: dict[int, tuple] = {}  # per kind the first row of the present content
    given = False  # whether that of the open ones has been passed on already

    def rows(chosen: np.ndarray, known: bool, oid, key, packed) -> pa.RecordBatch:
        columns = [pa.array(c[chosen], pa.int64()) for c in (oid, key, packed)]
        flags = pa.array(np.full(len(columns[0]), known), pa.bool_())
        return pa.RecordBatch.from_arrays([*columns, flags], ["oid", "key", "packed", "known"])

    for batch in batches:
        kind, *rest = (batch.column(c).to_numpy(zero_copy_only=False) for c in columns)
        gone = kind == GONE
        if gone.any():
            yield rows(gone, True, *rest[2:])
        for own_kind in (OPEN, SHARED):
            own = kind == own_kind
            if not own.any():
                continue
            name, content, oid, key, packed = (c[own] for c in rest)
            head = heads.get(own_kind)
            if head:
                name, content, oid, key, packed = (
                    np.insert(c, 0, h) for h, c in zip(head, (name, content, oid, key, packed))
                )
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (content[1:] != content[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(name)), 0))
            # A row that equals the first one is the same row of the table a second time.
            later = ~new & ~((oid == oid[first]) & (key == key[first]) & (packed == packed[first]))
            yield rows(later, True, oid, key, packed)
            firsts = np.flatnonzero(new)
            if own_kind == SHARED:
                out = firsts[1:] if head else firsts
            else:
                same_name = name[firsts][1:] == name[firsts][:-1]
                shared = np.append(False, same_name) | np.append(same_name, False)
                out = firsts[shared]
                out = out[out > 0] if given else out
                given = bool(shared[-1]) or given and len(firsts) == 1
            yield rows(out, False, oid, key, packed)
            heads[own_kind] = tuple(c[firsts[-1]] for c in (name, content, oid, key, packed))


_SIDE = "name bigint, kind tinyint, oid bigint, key bigint, begin bigint, strings bigint, content binary"
_SIDE_KINDS = [pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _batch(rows: list[tuple], kinds: list[pa.DataType], fields: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], fields)


def _strings(sent: _Sent, oid: int, key: int, begin: int, strings: int, content: bytes) -> Iterator[tuple]:
    """A side's strings as (oid, key, first, last, whole): each by its digest, but those of which
    the task has sent an earlier one as runs, with null for ``whole``."""
    run = None
    for n in range(len(content) - LENGTH + 1):
        # Strings are told apart by how far before the mark they start.
        whole = xxhash.xxh3_128_digest(content[n:n + LENGTH] + bytes([(strings >> 7) - n]))
        known = sent.compare(whole, (oid, key, begin + n))
        if known > 0:
            run = (run[0] if run else begin + n, begin + n)
            continue
        if run:
            yield oid, key, *run, None
            run = None
        if known < 0:
            yield oid, key, begin + n, begin + n, whole
    if run:
        yield oid, key, *run, None


def _sides(batches: Iterator[pa.RecordBatch], limits: Limits = Limits()) -> Iterator[pa.RecordBatch]:
    """For marked places to look into: the strings that have SIDE more bytes before the
    name, and those that have them behind it, each with a name of that longer part.

    A name with more than ``side_rows`` sides in a task is SPREAD: one row tells its
    place so, and its further sides go string by string and are dealt out by string.
    """
    unpacker = zstandard.ZstdDecompressor()
    digest = xxhash.xxh64_intdigest
    fields = ["name", "kind", "oid", "key", "begin", "strings", "content"]
    sent = _Sent(limits.remembered)
    counts: dict[int, int] = {}

    def side(name: int, oid: int, key: int, begin: int, strings: int, content: bytes) -> Iterator[tuple]:
        if name not in counts and len(counts) >= limits.remembered:
            counts.clear()
        counts[name] = count = counts.get(name, 0) + 1
        if count <= limits.side_rows:
            yield name, SIDE_ROW, oid, key, begin, strings, content
            return
        if count == limits.side_rows + 1:
            yield name, SPREAD, 0, 0, 0, 0, b""
        for *row, whole in _strings(sent, oid, key, begin, strings, content):
            route = int.from_bytes(whole[:8], "little", signed=True) if whole else key
            yield route, STRING if whole else RUN, *row, whole

    rows: list[tuple] = []
    for batch in slices(batches, 64):
        columns = [batch.column(c).to_pylist() for c in ("oid", "key", "text", "places")]
        for oid, key, packed_text, places in zip(*columns):
            text = unpacker.decompress(packed_text)
            for place, far, near in map(unpack, places):
                # (farthest and nearest start, the longer name's begin, its seed)
                for high, low, at, seed in (
                    (far, max(near, SIDE), place - SIDE, 1), (min(far, SIDE - 1), near, place, 2)
                ):
                    if low <= high:
                        name = digest(text[at:at + GRAM + SIDE], seed)
                        begin, end = place - high, place - low + LENGTH
                        name = name - (1 << 64) if name >> 63 else name
                        rows += side(name, oid, key, begin, high << 7 | low, text[begin:end])
                if len(rows) >= 4096:
                    yield _batch(rows, _SIDE_KINDS, fields)
                    rows = []
    if rows:
        yield _batch(rows, _SIDE_KINDS, fields)


def _compare(batches: Iterator[pa.RecordBatch], limits: Limits = Limits()) -> Iterator[pa.RecordBatch]:
    """Of sides that are sorted by name, kind and order: runs of strings that occur earlier.

    Rows are (oid, key, first, last, whole): start places, and null for ``whole``;
    strings of spread names and of those with very many rows come out one by one with
    their digest, as do rows that are strings or runs already.
    """
    fields = ["oid", "key", "first", "last", "whole"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    sent = _Sent(limits.remembered)

    def settle(group: list[tuple]) -> list[tuple]:
        seen: set[tuple[int, bytes]] = set()
        out = []
        for oid, key, begin, strings, content in group:
            run = None
            for n in range(len(content) - LENGTH + 1):
                string = ((strings >> 7) - n, content[n:n + LENGTH])
                if string in seen:
                    run = (run[0] if run else n, n)
                    continue
                seen.add(string)
                if run:
                    out.append((oid, key, begin + run[0], begin + run[1], None))
                    run = None
            if run:
                out.append((oid, key, begin + run[0], begin + run[1], None))
        return out

    current = None
    group: list[tuple] = []  # the sides of the present name, unless it is spread
    spread = False
    previous = None
    rows: list[tuple] = []
    for batch in slices(batches, 1024):
        for name, kind, *row in zip(*(batch.column(c).to_pylist() for c in
                                      ("name", "kind", "oid", "key", "begin", "strings", "content"))):
            if kind in (STRING, RUN):
                rows.append(tuple(row))
            else:
                if name != current:
                    if len(group) > 1:
                        rows += settle(group)
                    current, group, spread, previous = name, [], False, None
                if kind == SPREAD:  # comes before the sides
                    spread = True
                elif row[:4] != previous:  # else the same row of the table a second time
                    previous = row[:4]
                    if spread:
                        rows += _strings(sent, *row)
                    else:
                        group.append(tuple(row))
                        if len(group) > limits.group_rows:
                            rows += [string for member in group for string in _strings(sent, *member)]
                            group, spread = [], True
            if len(rows) >= 8192:
                yield _batch(rows, kinds, fields)
                rows = []
    if len(group) > 1:
        rows += settle(group)
    if rows:
        yield _batch(rows, kinds, fields)


def _later_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of single strings that are sorted by digest and order, all but the first."""
    last, first = None, None
    for batch in slices(batches, 4096):
        rows = []
        for whole, *row in zip(*(batch.column(c).to_pylist() for c in
                                 ("whole", "oid", "key", "first", "last"))):
            if whole != last:
                last, first = whole, row
            elif row != first:
                rows.append(row)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], ["oid", "key", "first", "last"])


def join_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Removed byte ranges from runs of start places; what touches becomes one."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + LENGTH)
        else:
            out.append([first, last + LENGTH])
    return [(a, b) for a, b in out]


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches):
        texts = pa.array([packer.compress(t) for t in texts_of(batch)], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", texts)


def repeated_spans(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cut: bool = False,
    limits: Limits = Limits(),
) -> DataFrame:
    """id, n_bytes, text (UTF-8 bytes; what is left of it if ``cut``) and spans (first, end) of what occurs earlier in the corpus.

    A byte belongs to a span if some LENGTH bytes around it also start earlier:
    in a row with a smaller id, or in the same text further ahead. Strings never
    reach across texts; spans do not touch each other.

    One row per input row. Ids are whole numbers; a null id is larger than all
    others. Rows with equal id and text are one document: their spans are the
    same, and they are not each other's copies. Of rows with equal id and
    different texts, the one with the smaller text hash comes first. A null text
    is empty; texts shorter than LENGTH have no spans. Extra columns are not
    looked at. No rows give no rows. Long texts are read whole.

    A name, a stretch or a string that is common over the whole corpus sends a few rows per task
    to one place, whatever the size of a task; ``limits`` says how few.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST_ID)).alias("oid"),
        F.xxhash64(text).alias("key"), text.alias("text"),
    )
    order = ["oid", "key", "packed"]
    marked = source.select("oid", "key", "text").mapInArrow(
        lambda batches: _mark_documents(batches, limits), _STRETCH
    )
    sorted_out = (
        marked.repartition("name").sortWithinPartitions("kind", "name", "content", *order)
        .mapInArrow(_sort_out, "oid bigint, key bigint, packed bigint, known boolean")
    )
    stretched = stage(sorted_out, "stretches")
    short = source.mapInArrow(
        _compress, f"id {source.schema['id'].dataType.simpleString()}, oid bigint, key bigint, text binary"
    )
    open_places = (
        stretched.where("NOT known").groupBy("oid", "key").agg(F.collect_set("packed").alias("places"))
    )
    sides = short.select("oid", "key", "text").join(open_places, ["oid", "key"]).mapInArrow(
        lambda batches: _sides(batches, limits), _SIDE
    )
    compared = stage(
        sides.repartition("name").sortWithinPartitions("name", "kind", "oid", "key", "begin", "strings")
        .mapInArrow(lambda batches: _compare(batches, limits), "oid bigint, key bigint, first bigint, last bigint, whole binary"),
        "sides",
    )
    place = F.shiftright("packed", 14)
    runs = stretched.where("known").select(
        "oid", "key", (place - F.shiftright("packed", 7).bitwiseAND(F.lit(127))).alias("first"),
        (place - F.col("packed").bitwiseAND(F.lit(127))).alias("last"),
    ).unionByName(compared.where("whole IS NULL").drop("whole"))
    single = compared.where("whole IS NOT NULL")
    runs = runs.unionByName(
        single.repartition("whole").sortWithinPartitions("whole", "oid", "key", "first")
        .mapInArrow(_later_strings, "oid bigint, key bigint, first bigint, last bigint")
    )
    # One whole number per run: a run is shorter than a kilobyte.
    numbered = runs.select("oid", "key", (F.col("first") * 1024 + F.col("last") - F.col("first")).alias("run"))
    per_text = numbered.groupBy("oid", "key").agg(F.collect_list("run").alias("runs"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches):
            found = [
                [{"first": a, "end": b} for a, b in join_runs([(r >> 10, (r >> 10) + (r & 1023)) for r in own or ()])]
                for own in batch.column("runs").to_pylist()
            ]
            texts = [unpacker.decompress(t) for t in batch.column("text").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            if cut:
                texts = [without(text, own) if own else text for text, own in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), sizes, pa.array(texts, pa.binary()), pa.array(found, kind)],
                ["id", "n_bytes", "text", "spans"])

    kind = source.schema["id"].dataType.simpleString()
    return short.join(per_text, ["oid", "key"], "left").select("id", "text", "runs").mapInArrow(
        spans, f"id {kind}, n_bytes bigint, text binary, spans array<struct<first:bigint,end:bigint>>"
    ).withColumnRenamed("id", id_col)


def without(text: bytes, spans: list[dict]) -> bytes:
    """What is left of a text without its spans, which lie in order."""
    begins = [0, *(s["end"] for s in spans)]
    return b"".join(text[a:b] for a, b in zip(begins, [*(s["first"] for s in spans), len(text)]))


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """id, n_bytes, spans and ``kept``, the text's remaining bytes. See ``repeated_spans``."""
    return repeated_spans(docs, id_col=id_col, text_col=text_col, cut=True, limits=limits).select(
        id_col, "n_bytes", "spans", F.col("text").alias("kept")
    )
