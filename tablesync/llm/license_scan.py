"""Finds short licence notices, exactly and with a bounded number of edits.

A notice that may have ``k`` edits is split into ``k + 1`` pieces: whatever the
edits hit, one piece is whole. One Aho-Corasick pass finds the pieces, and the
bounded-error search of the regex library is run only around them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import WORD_BYTES, lower_ascii, slices, texts_of


@dataclass(frozen=True)
class Notice:
    """Words of a notice, its label, and words that must be there unchanged."""

    words: str
    label: str
    keys: tuple[str, ...] = ()


# Phrases that count as they stand, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Notices that may be misspelt. The keys tell one licence from its neighbours.
NOTICES = (
    Notice("under the mit license", "mit", ("mit",)),
    Notice("apache license version 2", "apache-2", ("2",)),
    Notice("licensed under cc by nc", "cc-by-nc", ("nc",)),
    Notice("creative commons attribution noncommercial", "cc-by-nc"),
    Notice("gnu general public license version 3", "gpl-3", ("3",)),
    Notice("gnu general public license version 2", "gpl-2", ("2",)),
    Notice("mozilla public license version 2", "mpl-2", ("2",)),
    Notice("redistribution and use in source and binary forms", "bsd"),
)

_RESULT = (
    "id {id}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, spans array<struct<label:string,"
    "first_word:bigint,last_word:bigint,errors:int>>"
)
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                            ("last_word", pa.int64()), ("errors", pa.int32())]))


def pieces(words: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces that make up the notice, with their offsets."""
    cuts = [round(i * len(words) / (edits + 1)) for i in range(edits + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


def places(text: str, phrase: str) -> list[int]:
    """All places of a phrase in ' '-padded words, also those that share words."""
    found, at = [], text.find(f" {phrase} ")
    while at >= 0:
        found.append(at + 1)
        at = text.find(f" {phrase} ", at + 1)
    return found


def word_numbers(text: str, offsets: list[int]) -> dict[int, int]:
    """The number of the word at or before each offset, counted from 0 in one pass."""
    numbers, spaces, done = {}, 0, 0
    for at in sorted(set(offsets)):
        spaces += text.count(" ", done, at)
        done, numbers[at] = at, spaces - 1
    return numbers


class _Scanner:
    """The compiled notices of one task."""

    def __init__(self, notices: tuple[Notice, ...], chars_per_edit: int):
        self.notices, self.edits, self.patterns = notices, [], []
        self.seeds = ahocorasick.Automaton()
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(notices):
            edits = len(notice.words) // chars_per_edit
            self.edits.append(edits)
            self.patterns.append(regex.compile(
                rf"(?e)(?<= )(?:{regex.escape(notice.words, literal_spaces=True)}){{e<={edits}}}(?= )"
            ))
            for offset, piece in pieces(notice.words, edits):
                by_piece.setdefault(piece, []).append((n, offset))
        for piece, where in by_piece.items():
            self.seeds.add_word(piece, (len(piece), where))
        if by_piece:
            self.seeds.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each notice the joined ranges in which it can begin and end."""
        found: dict[int, list[list[int]]] = {}
        if not len(self.seeds):
            return found
        ranges: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.seeds.iter(text):
            for n, offset in where:
                begin = end + 1 - size - offset
                reach = self.edits[n]
                ranges.setdefault(n, []).append(
                    (max(0, begin - reach), begin + len(self.notices[n].words) + reach + 1)
                )
        for n, own in ranges.items():
            joined = found.setdefault(n, [])
            for low, high in sorted(own):
                if joined and low <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], high)
                else:
                    joined.append([low, high])
        return found

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, begin, end, edits) of every verified match, in order of place."""
        out = []
        for n, ranges in self.windows(text).items():
            keys = set(self.notices[n].keys)
            for low, high in ranges:
                for match in self.patterns[n].finditer(text, low, min(high, len(text))):
                    if keys <= set(match.group().split(" ")):
                        out.append((n, match.start(), match.end(), sum(match.fuzzy_counts)))
        return sorted(out, key=lambda m: (m[1], m[2], m[0]))


def _scan(text: bytes, phrases, scanner: _Scanner) -> tuple:
    words = WORD_BYTES.findall(lower_ascii(text))
    joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
    base = [(at, label) for phrase, label in phrases for at in places(joined, phrase)]
    fuzzy = scanner.matches(joined)
    numbers = word_numbers(
        joined, [at for at, _ in base] + [m[1] for m in fuzzy] + [m[2] for m in fuzzy]
    )
    starts = [numbers[at] for at, _ in base]
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(scanner.notices[n].label for n, *_ in fuzzy)})
    closeness = [1 - errors / len(scanner.notices[n].words) for n, _, _, errors in fuzzy]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(base_labels), ",".join(labels), 1.0 if base else max(closeness, default=0.0),
        [{"label": scanner.notices[n].label, "first_word": numbers[begin],
          "last_word": numbers[end], "errors": errors} for n, begin, end, errors in fuzzy],
    )


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    phrases: tuple = PHRASES, notices: tuple[Notice, ...] = NOTICES, chars_per_edit: int = 10,
) -> DataFrame:
    """Licence labels of every whole text, with the places they were found at.

    ``phrases`` count where their words stand consecutively. ``notices`` may
    also differ by one edit (a character put in, left out or changed) for every
    ``chars_per_edit`` characters, if their key words are unchanged; their
    matches are in ``spans`` (word numbers from 0) and do not overlap for one
    notice. ``score`` is 1 for a phrase, else 1 - edits / length of the closest
    notice, else 0.

    One row per input row, in any order; repeated rows give repeated results. A
    null or empty text has no words, no labels (empty texts), null places and
    score 0. Ids may be null. Extra columns are not looked at. Texts of any
    length are scanned whole, in memory that grows with the single text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(notices, chars_per_edit)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPAN]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                 "score", "spans"]
        for batch in slices(batches):
            rows = list(zip(*(_scan(text, phrases, scanner) for text in texts_of(batch))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id")] + [pa.array(c, kind) for c, kind in zip(rows, kinds)],
                ["id", *names],
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(scan, _RESULT.format(id=kind)).withColumnRenamed("id", id_col)
