"""Finds and removes passages of benchmark items.

The phrases of the benchmark are written to the shared folder once. Every task
indexes the documents it reads, a shard of a bounded number of words at a time,
as an FM-index over word symbols, searches all phrases backward in it, block by
block, locates the occurrences and merges them into spans of words. Neither
side is shuffled or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablesync.llm.common import WORD_BYTES, file_system, lower_ascii, slices, stage, texts_of
from tablesync.llm.fm_index import BITS, FIRST, GAP, FMIndex

SHARD_WORDS = 1 << 19
_PHRASES_PER_FILE = 100_000
_KEPT_FILES = 8
_SHARD_TEXTS = 1 << 16


def write_phrases(
    benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text", window: int = 10
) -> list[str]:
    """Files of (phrase, item): every window of words of every item, each pair once.

    An item of fewer words than a window is one phrase; one without words is
    none. A null item is named by an empty text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            phrases, items = [], []
            for item, text in zip(batch.column("item").to_pylist(), texts_of(batch)):
                words = WORD_BYTES.findall(lower_ascii(text))
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    phrases.append(b" ".join(words[at:at + window]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(phrases, pa.binary()), pa.array(items, pa.string())], ["phrase", "item"]
            )

    source = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.col(text_col).alias("text"),
    )
    pairs = stage(source.mapInArrow(cut, "phrase binary, item string").distinct(), "phrases")
    files = -(-pairs.count() // _PHRASES_PER_FILE)
    # One name per file; a task holds the phrases of a few files at a time.
    return sorted(stage(pairs.repartition(files, "phrase"), "phrases").inputFiles()) if files else []


class _Block:
    """The phrases of one file, as hashes of their words."""

    def __init__(self, path: str):
        system, place = file_system(path)
        stored = pq.read_table(place, filesystem=system)
        items_of: dict[bytes, list[str]] = {}
        for phrase, item in zip(stored["phrase"].to_pylist(), stored["item"].to_pylist()):
            items_of.setdefault(phrase, []).append(item)
        words = [phrase.split(b" ") for phrase in items_of]
        self.items = list(items_of.values())
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.hashes = np.zeros((len(words), max(self.lengths, default=0)), np.uint64)
        for row, own in zip(self.hashes, words):
            row[:len(own)] = word_hashes(own)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; they hold within one process only."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def symbols(hashes: np.ndarray) -> np.ndarray:
    """The index's symbols. Words may share one; what is found is compared by its hashes."""
    free = (1 << BITS) - FIRST
    return ((hashes ^ hashes >> np.uint64(32)) % np.uint64(free)).astype(np.int64) + FIRST


class Finder:
    """Finds all phrases in documents that are given as word hashes."""

    def __init__(self, files: list[str], shard_words: int = SHARD_WORDS):
        self.files, self.shard_words, self.kept = files, shard_words, {}

    def blocks(self) -> Iterator[_Block]:
        for path in self.files:
            block = self.kept.get(path) or _Block(path)
            if len(self.kept) < _KEPT_FILES:
                self.kept[path] = block
            yield block

    def find(self, docs: list[np.ndarray], window: int) -> list[tuple[np.ndarray, set[str]]]:
        """For each document which words are hit, and by which items."""
        hits = [np.zeros(len(doc) + 1, np.int64) for doc in docs]
        items: list[set[str]] = [set() for _ in docs]
        shard: list[tuple[int, int, np.ndarray]] = []
        held = 0
        for n, doc in enumerate(docs):
            # A long document goes into several shards that overlap by all but one word of a window.
            for start in range(0, max(1, len(doc) - window + 1), self.shard_words):
                piece = doc[start:start + self.shard_words + window - 1]
                if held and held + len(piece) > self.shard_words:
                    self._search(shard, hits, items)
                    shard, held = [], 0
                if len(piece):
                    shard.append((n, start, piece))
                    held += len(piece) + 1
        if shard:
            self._search(shard, hits, items)
        return [(np.cumsum(h[:-1]) > 0, found) for h, found in zip(hits, items)]

    def _search(self, shard, hits, items) -> None:
        gap = np.array([0], np.uint64)
        hashes = np.concatenate([part for *_, piece in shard for part in (piece, gap)])
        sizes = np.array([len(piece) + 1 for *_, piece in shard])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        text = symbols(hashes)
        text[bounds[1:] - 1] = GAP
        index = FMIndex(text)
        for block in self.blocks():
            low, high = index.search(symbols(block.hashes), block.lengths)
            found = np.flatnonzero(high > low)
            counts = high[found] - low[found]
            phrase = np.repeat(found, counts)
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            place = index.locate(low[phrase] + inside)
            length = block.lengths[phrase]
            same = np.ones(len(place), bool)
            for k in range(block.hashes.shape[1]):
                at = np.minimum(place + k, len(hashes) - 1)
                same &= (k >= length) | (hashes[at] == block.hashes[phrase, k])
            place, length, phrase = place[same], length[same], phrase[same]
            part = np.searchsorted(bounds, place, side="right") - 1
            order = np.argsort(part, kind="stable")
            place, length, phrase, part = place[order], length[order], phrase[order], part[order]
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(part))):
                n, start, _ = shard[part[a]]
                begin = place[a:b] - bounds[part[a]] + start
                np.add.at(hits[n], begin, 1)
                np.add.at(hits[n], begin + length[a:b], -1)
                for p in np.unique(phrase[a:b]):
                    items[n].update(block.items[p])


def spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as (first, behind the last)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int, *column):
    """Batches, gathered until they hold a shard's words: (batch, texts, word hashes)."""
    rows: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    hashes: list[np.ndarray] = []
    held = 0
    for batch in slices(batches, 64):
        rows.append(batch)
        for text in texts_of(batch, *column):
            texts.append(text)
            hashes.append(word_hashes(WORD_BYTES.findall(lower_ascii(text))))
            held += len(hashes[-1])
        if held >= shard_words or len(texts) >= _SHARD_TEXTS:  # texts may have no words
            yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0], texts, hashes
            rows, texts, hashes, held = [], [], [], 0
    if texts:
        yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0], texts, hashes


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", window: int = 10, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """id, n_words, n_hit, items (sorted texts) and spans (first, behind the last word).

    A word is hit if it lies in any occurrence of ``window`` consecutive words
    of an item, or of all words of a shorter item. Words are runs of letters,
    digits and bytes above 0x7F, A-Z in lower case.

    One row per input row; ids may be null or repeat. A null, empty or wordless
    text has no hits, and so has every text if the benchmark is empty; a null
    or wordless item matches nothing. Repeated items count once. Extra columns
    are not looked at. No rows give no rows. Long texts are searched whole, in
    overlapping shards.
    """
    files = write_phrases(benchmark, item_col=item_col, text_col=text_col, window=window)
    span = StructType([StructField("first", LongType()), StructField("end", LongType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(files, shard_words)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch, _, hashes in _shards(batches, shard_words):
            found = finder.find(hashes, window)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"),
                pa.array([len(h) for h in hashes], pa.int64()),
                pa.array([int(hit.sum()) for hit, _ in found], pa.int64()),
                pa.array([sorted(items) for _, items in found], pa.list_(pa.string())),
                pa.array([[{"first": a, "end": b} for a, b in spans_of(hit)] for hit, _ in found], kind),
            ], ["id", "n_words", "n_hit", "items", "spans"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([
        source.schema["id"], StructField("n_words", LongType()), StructField("n_hit", LongType()),
        StructField("items", ArrayType(StringType())), StructField("spans", ArrayType(span)),
    ])
    return source.mapInArrow(find, schema).withColumnRenamed("id", id_col)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [match.span() for match in WORD_BYTES.finditer(lower_ascii(text))]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at:places[first][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]])


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    window: int = 10, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """All rows as ``row`` (a struct of the input's columns), ``clean`` text and ``n_hit``.

    What is hit is cut out, and again if the rest then holds a phrase across a
    cut, until nothing is hit. Texts without hits, null ones included, stay as
    they are. See ``find_contamination`` for what is hit.
    """
    files = write_phrases(benchmark, item_col=item_col, text_col=text_col, window=window)
    source, field = docs.select(F.struct("*").alias("row")), docs.columns.index(text_col)
    schema = StructType([
        source.schema["row"], StructField("clean", StringType()), StructField("n_hit", LongType()),
    ])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(files, shard_words)
        for batch, texts, hashes in _shards(batches, shard_words, "row", field):
            total = [0] * len(texts)
            waiting = list(range(len(texts)))
            while waiting:
                again = []
                for n, (hit, _) in zip(waiting, finder.find([hashes[n] for n in waiting], window)):
                    if hit.any():
                        texts[n] = cut_words(texts[n], spans_of(hit))
                        hashes[n] = word_hashes(WORD_BYTES.findall(lower_ascii(texts[n])))
                        total[n] += int(hit.sum())
                        again.append(n)
                waiting = again
            empty = pc.is_null(pc.struct_field(batch.column("row"), [field])).to_pylist()
            clean = [None if none else text.decode() for text, none in zip(texts, empty)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(clean, pa.string()), pa.array(total, pa.int64())],
                ["row", "clean", "n_hit"],
            )

    return source.mapInArrow(remove, schema)

