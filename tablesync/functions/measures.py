"""Percentages, tolerances, bars and repeatable draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How far two row counts may differ, the bits of a word and a second multiplier.
TOLERANCE_FLOOR = 100
TOLERANCE_RATE = 0.001
WORD_BITS = 31
WORD = (1 << WORD_BITS) - 1
SECOND = 1566083941


def tolerance(rows: Column, floor: int = TOLERANCE_FLOOR, rate: float = TOLERANCE_RATE) -> Column:
    """Allowed difference: a share of ``rows``, but never under ``floor``."""
    return F.greatest(F.lit(floor).cast("bigint"), F.floor(rows * F.lit(rate)).cast("bigint"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` of ``whole`` in percent; 0 when there is nothing."""
    return F.when(
        whole > 0, F.round(part.cast("double") / whole.cast("double") * 100, digits)
    ).otherwise(F.lit(0.0))


def bar(share: Column, width: int, full: str = "▓", empty: str = "░") -> Column:
    """A text bar with ``floor(share / 100 * width)`` filled cells."""
    filled = F.floor(share / 100 * width).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit(full), filled),
                    F.repeat(F.lit(empty), F.lit(width) - filled), F.lit("]"))


def draw(id_col: Column, multiplier: int, bound: int) -> Column:
    """A repeatable number in ``0 .. bound - 1`` that depends on the id alone.

    All bits of the id are spread over two words of 31 bits, whose product with
    the bound is summed up word by word, so that no step leaves 64 bits: ids and
    bounds may be as large as a bigint below 2^62 holds. Another multiplier gives
    another sequence.
    """
    if not 0 < bound < 1 << 2 * WORD_BITS:
        raise ValueError(f"bound must lie between 1 and 2^62, got {bound}")
    number, word = id_col.cast("bigint"), F.lit(WORD).cast("bigint")
    low, rest = number.bitwiseAND(word), F.shiftrightunsigned(number, WORD_BITS)
    high = rest.bitwiseAND(word).bitwiseXOR(F.shiftright(rest, WORD_BITS))
    upper = (low * multiplier + high * SECOND).bitwiseAND(word)
    lower = (upper.bitwiseXOR(high) * multiplier + low).bitwiseAND(word)
    big, small = bound >> WORD_BITS, bound & WORD
    middle = upper * small + lower * big + F.shiftright(lower * small, WORD_BITS)
    return upper * big + F.shiftright(middle, WORD_BITS)


def draw_short(id_col: Column, multiplier: int, bound: int | None) -> Column:
    """The draw from the lowest 31 bits of an id alone; without a bound it is NULL.

    Ids that agree in these bits draw the same, and only 2^31 numbers are told apart, so it
    is for bounds well below that; ``draw`` has no such limit.
    """
    word = F.lit(WORD).cast("bigint")
    spread = (id_col.cast("bigint").bitwiseAND(word) * multiplier).bitwiseAND(word)
    return F.shiftright(spread * F.lit(bound).cast("bigint"), WORD_BITS)


def pick(id_col: Column, multiplier: int, choices: tuple[str, ...]) -> Column:
    """One of ``choices``, drawn by id."""
    index = (draw(id_col, multiplier, len(choices)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(choice) for choice in choices]), index)
