"""An FM-index over a sequence of symbols: wavelet-tree ranks and a sampled suffix array."""

from __future__ import annotations

import numpy as np

END, GAP, FIRST = 0, 1, 2  # the end of the sequence, a break in it, the first free symbol
BITS = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The order of all suffixes, by prefix doubling from four symbols on.

    Breaks count as different from each other, in order of place, so that no
    comparison goes beyond one.
    """
    size = len(symbols)
    wide = np.zeros(size + 3, np.uint64)
    wide[:size] = symbols
    key = np.zeros(size, np.uint64)
    broken = np.zeros(size, bool)
    for k in range(4):
        # What follows a break does not count.
        key = key << np.uint64(BITS) | np.where(broken, np.uint64(0), wide[k:size + k])
        broken |= wide[k:size + k] == GAP
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    starts = np.ones(size, bool)
    starts[1:] = (ordered[1:] != ordered[:-1]) | broken[order[1:]]
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(size), 0))
    reach = 4
    slots = np.flatnonzero(~(starts & np.append(starts[1:], True)))
    while len(slots):
        places = order[slots]
        beyond = places + reach
        following = np.where(beyond < size, rank[np.minimum(beyond, size - 1)] + 1, 0)
        pair = rank[places] << 32 | following
        turn = np.argsort(pair, kind="stable")
        places, pair = places[turn], pair[turn]
        order[slots] = places
        first = np.ones(len(slots), bool)
        first[1:] = pair[1:] != pair[:-1]
        rank[places] = np.maximum.accumulate(np.where(first, slots, 0))
        slots = slots[~(first & np.append(first[1:], True))]
        reach *= 2
    return order


class _Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word, rest = upto >> 6, (upto & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks of symbols in a sequence, one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray):
        self.levels, self.zeros = [], []
        for bit in reversed(range(BITS)):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append(_Bits(ones))
            self.zeros.append(len(symbols) - int(ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, *upto: np.ndarray) -> list[np.ndarray]:
        """For each symbol its occurrences before the places."""
        places, start = list(upto), np.zeros(len(symbol), np.int64)
        for depth, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (BITS - 1 - depth) & 1).astype(bool)
            for k, place in enumerate([start, *places]):
                ones = level.ones(place)
                moved = np.where(one, zeros + ones, place - ones)
                if k:
                    places[k - 1] = moved
                else:
                    start = moved
        return [place - start for place in places]

    def symbol_and_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its occurrences before it."""
        symbol, start = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one = level.at(place)
            symbol = symbol << 1 | one
            ones, ones_start = level.ones(place), level.ones(start)
            place = np.where(one, zeros + ones, place - ones)
            start = np.where(one, zeros + ones_start, start - ones_start)
        return symbol, place - start


class FMIndex:
    """Counts and places of phrases in a sequence of symbols from FIRST on, with GAPs."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        text = np.append(symbols, END).astype(np.int64)
        order = suffix_order(text)
        self.tree = WaveletTree(text[order - 1])
        counts = np.bincount(text, minlength=1 << BITS)
        self.smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        # Every sample-th place is kept, and what follows a break: no walk crosses one.
        marked = order % sample == 0
        marked |= (order > 0) & (text[order - 1] == GAP)
        self.marked, self.places, self.size = _Bits(marked), order[marked], len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows that start with each phrase; rows of ``phrases`` are padded."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        live = np.arange(len(phrases))
        for back in range(phrases.shape[1] if len(phrases) else 0):
            live = live[lengths[live] > back]
            symbol = phrases[live, lengths[live] - 1 - back].astype(np.int64)
            first, last = self.tree.rank(symbol, low[live], high[live])
            low[live], high[live] = self.smaller[symbol] + first, self.smaller[symbol] + last
            gone = low[live] >= high[live]
            high[live[gone]] = low[live[gone]]
            live = live[~gone]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places that rows stand for, by walking back to the nearest kept one."""
        out, steps = np.empty(len(rows), np.int64), 0
        waiting = np.arange(len(rows))
        while len(waiting):
            kept = self.marked.at(rows)
            out[waiting[kept]] = self.places[self.marked.ones(rows[kept])] + steps
            waiting, rows = waiting[~kept], rows[~kept]
            symbol, rank = self.tree.symbol_and_rank(rows)
            rows = self.smaller[symbol] + rank
            steps += 1
        return out
