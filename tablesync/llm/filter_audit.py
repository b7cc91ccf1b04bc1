"""How five filters interact in every order, per source.

One pass of a byte transducer counts what the filters ask of a text. Which
filters a document fails is a set of at most 32; all orders and steps follow
from how many documents of a part fail each set, so what is summed per part is
32 rows and nothing of an order's 120 ever touches a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablesync.llm.common import slices, stage, texts_of
from tablesync.llm.transducer import COUNTS, count_texts

FILTERS = "ABCDE"
_TOTALS = ["documents", "good", "toxic"]
_RESULT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_facts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``id``, ``part``, a 128-bit ``digest`` of the text and the transducer's counts.

    Words are maximal runs without ASCII white space, case-sensitive. One row per
    input row; a null text is empty, a null part the empty string. A text of more than a
    megabyte is counted in windows of that size.
    """
    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    )
    kind = source.schema["id"].dataType
    id_type = to_arrow_type(kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch)
            digests = [blake2b(text, digest_size=16).digest() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(id_type), batch.column("part").cast(pa.string()),
                 pa.array(digests, pa.binary()), *map(pa.array, count_texts(texts).T.copy())],
                ["id", "part", "digest", *COUNTS],
            )

    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    return source.mapInArrow(count, f"id {kind.simpleString()}, part string, digest binary, {counts}")


def failures() -> list[Column]:
    """What fails each filter but the last, over the counts of ``text_facts``."""
    return [
        F.col("n_words") < 50,
        100 * F.col("n_distinct") < 65 * F.col("n_words"),
        100 * F.col("n_capitals") > 5 * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]


def failure_sets(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """Per part and set of failed filters: ``documents``, and how many are ``good`` and ``toxic``.

    ``fails`` has bit k for filter k. The last filter fails where a smaller id
    has the same text. Documents are summed by id, text, part and failed filters first, so repeated
    rows make one row, and no join is on a text alone, however many copies it has.
    """
    bits = sum(
        (failed.cast("int") * (1 << k) for k, failed in enumerate(failures())), F.lit(0)
    ).alias("fails")
    facts = text_facts(docs, id_col=id_col, text_col=text_col, part_col=part_col)
    placed = stage(facts.select("id", "part", "digest", bits), "facts")
    units = placed.groupBy("id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("documents"))
    earliest = (
        placed.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id"))
        .withColumn("earliest", F.lit(True))
    )
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    copied = F.col("id").isNotNull() & F.col("earliest").isNull()
    last = 1 << (len(FILTERS) - 1)
    return (
        units.join(earliest, ["id", "digest"], "left").join(marked, "id", "left")
        .groupBy("part", (F.col("fails") + F.when(copied, last).otherwise(0)).alias("fails"))
        .agg(
            F.sum("documents").alias("documents"),
            *(F.coalesce(F.sum(F.when(F.col(c), F.col("documents"))), F.lit(0)).alias(c)
              for c in ("good", "toxic")),
        )
    )


def step_rows(counts: np.ndarray) -> list[tuple]:
    """All orders and steps of one part, from ``counts`` by set of failed filters and _TOTALS."""
    sets = np.arange(len(counts))
    total = counts[:, 0].sum()
    rows, removed_by = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0  # bits of the filters that ran earlier
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            fails = (sets & bit) > 0
            gone = (sets & before) > 0
            removed, good, toxic = counts[fails & ~gone].sum(axis=0).tolist()
            before |= bit
            rows.append([
                "".join(order), step, int(total - counts[(sets & before) > 0, 0].sum()), removed,
                int(counts[fails & gone, 0].sum()), int(counts[sets == bit, 0].sum()), good, toxic, name,
            ])
            removed_by[name] += removed
    return [(*row[:-1], removed_by[row[-1]]) for row in rows]


def audit_filters(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """What each filter removes at each step of each order, per part.

    A document fails A with under 50 words, B where fewer than 65 of 100 words
    are distinct, C where more than 5 of 100 code points are A-Z, D with one
    of ``#$%&*|``, E where a smaller id has the same text, removed or not. Per
    part, order and step: documents ``kept`` after it, ``removed`` by it, ``redundant`` (fail it, but
    went before), ``unique_fails`` (fail this filter alone), ``good_lost`` and ``toxic_lost``
    (removed here, labelled quality 1 or toxic 1), and ``shapley``, what its filter removes summed
    over all orders.

    Parts are the values of ``part_col``, a null and an empty one together; all
    steps of a part are given, zeros included. Null and empty texts have no words. A
    null id is no one's copy, has no label and makes no other document a copy.
    Repeated rows count each, and none of them is a copy of another with its
    id. A document has a label if any row of ``labels`` gives it. Extra columns are not
    looked at; an empty table gives no rows.
    """
    totals = failure_sets(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col)
    # At most 32 rows of each part come together.
    parts = totals.groupBy("part").agg(F.collect_list(F.struct("fails", *_TOTALS)).alias("sets"))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                 "good_lost", "toxic_lost", "shapley"]
        for batch in batches:
            for part, sets in zip(batch.column("part").to_pylist(), batch.column("sets").to_pylist()):
                counts = np.zeros((1 << len(FILTERS), len(_TOTALS)), np.int64)
                for entry in sets:
                    counts[entry["fails"]] = [entry[c] for c in _TOTALS]
                columns = zip(*((part, *row) for row in step_rows(counts)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return parts.mapInArrow(steps, _RESULT)
