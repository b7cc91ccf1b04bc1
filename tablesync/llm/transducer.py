"""A byte transducer over UTF-8 and a verified hash table of word spans.

The transducer is a table: state and byte give the next state and what the byte
counts as. Its state depends on the last four bytes at most, so a buffer is cut
into lanes that run side by side, each warmed up on the four bytes before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"
WORD_START, WORD_END, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16
COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

_WARM, _LANE = 4, 256
_WINDOW = 1 << 20  # bytes that are looked at together
_MULTIPLIER = 0x9E3779B97F4A7C15
_WORD_LIMIT = 512  # longer words are compared as slices


def _build_table() -> np.ndarray:
    """For state and byte: the next state in the high byte, the actions in the low one.

    A state is whether the byte before belonged to a word, and how many
    continuation bytes of its character are still to come.
    """
    table = np.zeros((8, 256), np.uint16)
    for state in range(8):
        in_word, pending = state & 1, state >> 1
        for byte in range(256):
            space = byte in SPACES
            follows = 0x80 <= byte < 0xC0
            # A continuation byte that nothing waits for counts as a character of its own.
            actions = 0 if follows and pending else POINT
            if space:
                actions |= WORD_END if in_word else 0
            else:
                actions |= 0 if in_word else WORD_START
            actions |= CAPITAL if 65 <= byte <= 90 else 0
            actions |= SYMBOL if byte in SYMBOLS else 0
            if follows:
                left = max(0, pending - 1)
            else:
                left = 3 if 0xF0 <= byte < 0xF8 else 2 if 0xE0 <= byte < 0xF0 else 1 if 0xC0 <= byte < 0xE0 else 0
            table[state, byte] = (left << 1 | (not space)) << 8 | actions
    return table.ravel()


TABLE = _build_table()


def transduce(buffer: np.ndarray, before: bytes = b"") -> np.ndarray:
    """The actions of every byte of ``buffer``, which ``before`` precedes."""
    size = len(buffer)
    lanes = max(1, -(-size // _LANE))
    padded = np.full(_WARM + lanes * _LANE, SPACES[0], np.uint8)
    padded[_WARM:_WARM + size] = buffer
    tail = before[-_WARM:]
    padded[_WARM - len(tail):_WARM] = np.frombuffer(tail, np.uint8)
    steps = np.lib.stride_tricks.as_strided(padded, (_WARM + _LANE, lanes), (1, _LANE))
    actions = np.empty((_LANE, lanes), np.uint8)
    state = np.zeros(lanes, np.uint16)
    for step in range(_WARM + _LANE):
        entry = TABLE[state | steps[step]]
        state = entry & 0xFF00
        if step >= _WARM:
            actions[step - _WARM] = entry  # the low byte
    return actions.T.ravel()[:size]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64, and a random value per byte."""
    inverse = pow(_MULTIPLIER, -1, 2**64)
    up, down = np.full(size, _MULTIPLIER, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    values = np.random.default_rng(11).integers(0, 2**64, 256, np.uint64)
    return np.multiply.accumulate(up), np.multiply.accumulate(down), values


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, from one running sum over the buffer."""
    up, down, values = _powers(1 << max(16, len(buffer).bit_length()))
    running = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(values[buffer] * up[:len(buffer)], out=running[1:])
    hashes = (running[ends] - running[starts]) * down[starts]
    hashes ^= hashes >> np.uint64(32)
    return hashes * np.uint64(_MULTIPLIER)


def _equal_spans(
    buffer: np.ndarray, eights: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Whether spans of equal lengths hold the same bytes, eight at a time."""
    same = np.ones(len(left), bool)
    open_ = np.arange(len(left))
    at = 0
    while len(open_):
        size = np.minimum(lengths[open_] - at, 8).astype(np.uint64)
        differ = (eights[left[open_] + at] ^ eights[right[open_] + at]) << (np.uint64(64) - 8 * size)
        same[open_] = differ == 0
        at += 8
        open_ = open_[(differ == 0) & (lengths[open_] > at)]
        if at >= _WORD_LIMIT:
            for n in open_.tolist():
                a, b, size = left[n], right[n], lengths[n]
                same[n] = buffer[a:a + size].tobytes() == buffer[b:b + size].tobytes()
            break
    return same


def first_spans(
    buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray, hashes: np.ndarray
) -> np.ndarray:
    """Which word spans are the first of their word within their owner.

    All spans go into one table with open addressing; a place is shared only by
    spans whose owner, length and bytes are the same.
    """
    count = len(starts)
    bits = max(4, (2 * count).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    mixed = (hashes ^ (owners.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(_MULTIPLIER)
    slots = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    lengths = ends - starts
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    eights = np.ascontiguousarray(
        np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(buffer) + 1,), (1,))
    )
    first = np.zeros(count, bool)
    pending = np.arange(count)
    while len(pending):
        at = slots[pending]
        claims = pending[table[at] < 0][::-1]  # of several claims of a place the first span's counts
        table[slots[claims]] = claims
        holder = table[at]
        mine = holder == pending
        first[pending[mine]] = True
        alike = ~mine & (hashes[holder] == hashes[pending]) & (owners[holder] == owners[pending])
        alike &= lengths[holder] == lengths[pending]
        pairs = np.flatnonzero(alike)
        a, b = pending[pairs], holder[pairs]
        alike[pairs] = _equal_spans(buffer, eights, starts[a], starts[b], lengths[a])
        pending = pending[~(mine | alike)]
        slots[pending] = (slots[pending] + 1) & ((1 << bits) - 1)
    return first


def pieces(text: bytes) -> Iterator[tuple[int, int]]:
    """A text in stretches that end at white space; only one long word is ever longer than a window."""
    at = 0
    while len(text) - at > _WINDOW:
        cut = max(text.rfind(space, at, at + _WINDOW) for space in (bytes([b]) for b in SPACES))
        if cut < at:
            later = [text.find(bytes([b]), at + _WINDOW) for b in SPACES]
            cut = min((place for place in later if place >= 0), default=len(text) - 1)
        yield at, cut + 1
        at = cut + 1
    yield at, len(text)


def _count_buffer(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """COUNTS of every part; and the first spans of words with the parts they are in."""
    joined = b" ".join(parts) + b" "
    buffer = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    actions = transduce(buffer)
    starts, ends = (np.flatnonzero(actions & bit) for bit in (WORD_START, WORD_END))
    owners = np.searchsorted(bounds, starts, "right") - 1
    first = first_spans(buffer, starts, ends, owners, span_hashes(buffer, starts, ends))

    def per_part(bit: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(actions & bit), bounds))

    points = np.add.reduceat((actions & POINT) >> 3, bounds[:-1], dtype=np.int64) - 1
    counts = np.stack([
        np.bincount(owners, minlength=len(parts)), np.bincount(owners[first], minlength=len(parts)),
        per_part(CAPITAL), points, per_part(SYMBOL),
    ], axis=1)
    return counts, starts[first], ends[first], owners[first], joined


def _count_long_word(word: bytes) -> np.ndarray:
    """COUNTS of one word, window by window; its distinct words are left to the caller."""
    total = np.array([1, 0, 0, 0, 0], np.int64)
    for at in range(0, len(word), _WINDOW):
        part = np.frombuffer(word[at:at + _WINDOW], np.uint8)
        actions = transduce(part, word[max(0, at - _WARM):at] or b" ")
        total[2:] += [np.count_nonzero(actions & bit) for bit in (CAPITAL, POINT, SYMBOL)]
    return total


def _count_long(text: bytes) -> np.ndarray:
    """COUNTS of a text of more than a window; it holds each of its distinct words once."""
    total, seen = np.zeros(len(COUNTS), np.int64), set()
    for start, end in pieces(text):
        if end - start > _WINDOW:
            word = text[start:end].rstrip(SPACES)
            total += _count_long_word(word)
            total[3] += end - start - len(word)
            seen.add(word)
            continue
        counts, starts, ends, _, joined = _count_buffer([text[start:end]])
        total += counts[0]
        seen.update(joined[a:b] for a, b in zip(starts.tolist(), ends.tolist()))
    total[1] = len(seen)
    return total


def count_texts(texts: list[bytes]) -> np.ndarray:
    """A row of COUNTS per text, in order."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    held: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        if len(text) > _WINDOW:
            out[number] = _count_long(text)
            continue
        if held and size + len(text) > _WINDOW:
            out[held] = _count_buffer([texts[n] for n in held])[0]
            held, size = [], 0
        held.append(number)
        size += len(text) + 1
    if held:
        out[held] = _count_buffer([texts[n] for n in held])[0]
    return out
