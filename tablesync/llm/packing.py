"""Packs tokenised documents into sequences by best-fit decreasing.

Documents longer than a window are first cut into full windows. The rests are
placed longest first into the tightest open window, which a segment tree over
the remaining capacities finds. Every task packs what it reads, in blocks of a
bounded number of tokens, so nothing is shuffled and memory does not grow with
the table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from tablesync.llm.common import slices

_RESULT = (
    "id {id}, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_BLOCK_DOCS = 1 << 17
# The characters with the property White_Space.
_LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
_JOINT = re.compile(r"(?<=\S)(?= )")
_BLANKS = re.compile(r"\s ")


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """The tokens of a tokenizer file that stand for their own text wherever it occurs."""
    known = Tokenizer.from_file(tokenizer_path).get_added_tokens_decoder()
    for token in known.values():
        if token.lstrip or token.rstrip or token.single_word or token.normalized:
            raise ValueError(f"{token.content} does not stand for its own text alone")
    return {token.content: id_ for id_, token in known.items()}


def may_hold_long_blanks(text: str) -> bool:
    """Whether two marks 2,048 characters apart are both blank, as within any run of 4,096."""
    marks = text[::2048]
    return any(a.isspace() and b.isspace() for a, b in zip(marks, marks[1:]))


class Encoder:
    """Token ids of a byte-level BPE, as little-endian 32-bit numbers.

    The text is first cut at the ``added`` tokens. No other token reaches across
    a space that follows a visible character, so the text is cut there and the
    ids of short pieces are remembered, ``memory`` pieces at most.
    """

    def __init__(
        self, ranks_path: str, pattern: str, memory: int = 200_000, added: dict[str, int] | None = None
    ):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding(
            "packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.memory, self.known = memory, {}
        self.added = {text: np.array([id_], "<u4").tobytes() for text, id_ in (added or {}).items()}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(longest_first)})") if self.added else None

    def fresh(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def _later(self, piece: str) -> bytes:
        """The ids of a piece behind a space."""
        ids = self.fresh(f" {piece}")
        if len(piece) <= 32:
            if len(self.known) >= self.memory:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self._ordinary(text)
        return b"".join(
            self.added[part] if place % 2 else self._ordinary(part)
            for place, part in enumerate(self.cut.split(text))
        )

    def _ordinary(self, text: str) -> bytes:
        """Ids of a text without added tokens.

        A long run of white space is one piece, which no pattern has to find; the
        last blank before a visible character is a piece of its own or
        belongs to what follows.
        """
        if not may_hold_long_blanks(text):
            return self._in_pieces(text)
        out, at = [], 0
        for run in _LONG_BLANKS.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out.append(self._in_pieces(text[at:run.start()]))
            out.append(np.array(self.bpe._encode_single_piece(text[run.start():end]), "<u4").tobytes())
            at = end
        return b"".join(out) + self._in_pieces(text[at:])

    def _in_pieces(self, text: str) -> bytes:
        if not text:
            return b""
        if _BLANKS.search(text):
            first, *later = _JOINT.split(text)
            later = [piece[1:] for piece in later]
        else:
            first, *later = text.split(" ")
        known = self.known.get
        ids = [known(piece) or self._later(piece) for piece in later]
        return (self.fresh(first) if first else b"") + b"".join(ids)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _mark(self, room: int) -> None:
        node = room + self.leaves
        value = bool(self.windows[room])
        while node and self.filled[node] != value:
            self.filled[node] = value
            node >>= 1
            value = self.filled[2 * node] or self.filled[2 * node + 1] if node else 0

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._mark(room)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room for ``need``: (room, window)."""
        node = need + self.leaves
        while not self.filled[node]:
            while node & 1:  # a right child: everything further right is below the parent's sibling
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        self._mark(room)
        return room, window


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows as lists of piece numbers; pieces go in longest first, ties in given order."""
    windows: list[list[int]] = []
    open_windows = OpenWindows(capacity)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        room, window = open_windows.tightest(need) or (capacity, len(windows))
        if window == len(windows):
            windows.append([])
        windows[window].append(piece)
        if room > need:
            open_windows.put(room - need, window)
    return windows


def split_at_powers(sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """Cuts one window's pieces into sequences whose lengths are powers of two.

    Gives for each sequence (piece, first id in it, number of ids).
    """
    total, out, piece, used = sum(sizes), [], 0, 0
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        need, sequence = 1 << bit, []
        while need:
            take = min(need, sizes[piece] - used)
            sequence.append((piece, used, take))
            need, used = need - take, used + take
            if used == sizes[piece]:
                piece, used = piece + 1, 0
        out.append(sequence)
    return out


def pack_documents(
    docs: DataFrame, *, ranks_path: str, pattern: str, tokenizer_path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, block_tokens: int = 4_000_000,
) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences.

    Every document is its token ids and then ``end_id``; a null or empty text is
    that one id. ``ids`` holds a piece's ids as little-endian unsigned 32-bit
    numbers, ``start`` the ids of its document before it, ``offset`` its place
    in the sequence, without gaps. A sequence has at most ``window`` ids and is
    to be padded to ``window`` unless its length is a power of two; of each
    block the one window that is at most half full is cut into such lengths.

    ``ranks_path`` (a rank file) and ``pattern`` name the tokenizer, ``tokenizer_path`` the file that
    lists its added tokens, which are found inside texts too. Blocks end
    at a document once they hold ``block_tokens`` ids or 131,072 documents, so
    memory is bounded by that and the longest document. Repeated rows and null ids are packed like
    any others; extra columns are not looked at; an empty table gives no rows.
    Sequence ids are unique and the same again when a task is run again.
    """
    size = 4  # bytes per id
    added = added_tokens(tokenizer_path) if tokenizer_path else {}

    def pack_block(block: list[tuple], sequence: int) -> tuple[pa.RecordBatch, int]:
        rows: list[tuple] = []
        rests: list[tuple] = []
        for doc, ids in block:
            tokens = len(ids) // size
            whole = tokens - tokens % window
            for start in range(0, whole, window):
                rows.append((doc, start, ids[start * size:(start + window) * size], tokens, sequence, 0))
                sequence += 1
            if tokens > whole:
                rests.append((doc, whole, ids[whole * size:], tokens))
        lengths = np.array([len(rest[2]) // size for rest in rests], np.int64)
        for pieces in best_fit(lengths, window):
            sizes = [int(lengths[p]) for p in pieces]
            if 2 * sum(sizes) <= window:
                parts = split_at_powers(sizes)
            else:
                parts = [[(n, 0, count) for n, count in enumerate(sizes)]]
            for part in parts:
                offset = 0
                for n, first, count in part:
                    doc, start, ids, tokens = rests[pieces[n]]
                    cut = ids[first * size:(first + count) * size]
                    rows.append((doc, start + first, cut, tokens, sequence, offset))
                    offset += count
                sequence += 1
        doc, start, ids, tokens, sequences, offsets = zip(*rows)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        columns = (start, [len(i) // size for i in ids], ids, tokens, sequences, offsets)
        names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([pa.array(doc, id_type), *arrays], ["id", *names]), sequence

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, pattern, added=added)
        end = np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        block: list[tuple] = []
        held = 0
        for batch in slices(batches):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + end
                block.append((doc, ids))
                held += len(ids) // size
                if held >= block_tokens or len(block) >= _BLOCK_DOCS:
                    packed, sequence = pack_block(block, sequence)
                    yield from slices([packed], 4096)
                    block, held = [], 0
        if block:
            packed, sequence = pack_block(block, sequence)
            yield from slices([packed], 4096)

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    field = source.schema["id"].dataType
    id_type = to_arrow_type(field)
    packed = source.mapInArrow(pack, _RESULT.format(id=field.simpleString()))
    return packed.withColumnRenamed("id", id_col)
