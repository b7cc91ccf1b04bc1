"""Quality rules: plain limits, then robust multivariate outliers.

Statistics of every text are transformed to vectors. For each language and
source a minimum covariance determinant estimate is found by concentration
steps: the half of the rows nearest to the present centre gives the next centre
and covariance, until the determinant falls no more. A row far from its group's
centre by Mahalanobis distance is rejected. All sums run over all rows and are
added up by group; the start is the coordinatewise median, so nothing is drawn
at random.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesync.llm.common import file_system, fresh_path, plain_words, qualified, slices, stage, texts_of

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER = bytes(range(65, 91))
MARKS = b"!?~^_=+/\\@{}[]"

# The transformed statistics and the spread below which a difference means nothing.
VECTOR = {
    "log_words": 1.0, "word_length": 1.0, "symbols": 0.04, "capitals": 0.12, "marks": 0.06,
    "line_repeats": 0.3, "word_repeats": 0.15,
}
_UNIT = 1024  # vectors are whole multiples of 1 / _UNIT, so that sums do not depend on order
_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words in ``size``-word windows that are found twice or more, the first included.

    Most texts have no such window, which hashes tell at once; else windows are
    ranked exactly, from those of half their length, in a few arrays of the text's words.
    """
    count = len(words) - size + 1
    if count < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    names = np.zeros(count, np.uint64)
    for k in range(size):
        names = (names ^ hashes[k:k + count]) * np.uint64(0x9E3779B97F4A7C15)
        names ^= names >> np.uint64(29)
    order = np.sort(names)
    doubled = order[1:][order[1:] == order[:-1]]
    if not len(doubled):
        return 0
    # The names only sort out; what counts is that the words are equal.
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    ranks, width = ids, 1
    while width < size:
        step = min(width, size - width)
        pairs = ranks[:len(ranks) - step] * np.int64(len(words)) + ranks[step:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        width += step
    again = np.flatnonzero(np.bincount(ranks)[ranks] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + size, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def statistics(text: bytes) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the vector."""
    words = plain_words(text)
    letters = b"".join(words)
    chars = len(letters.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    doubled = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    capitals = len(letters) - len(letters.translate(None, UPPER))
    marks = len(letters) - len(letters.translate(None, MARKS))
    vector = (
        np.log1p(len(words)), min(chars / max(1, len(words)), 100.0),
        np.sqrt(min(1.0, symbols / max(1, chars))), np.sqrt(min(1.0, capitals / max(1, chars))),
        np.sqrt(min(1.0, marks / max(1, chars))), np.sqrt(doubled / max(1, len(lines))),
        np.sqrt(repeats / max(1, len(words))),
    )
    return (len(words), chars, symbols, doubled, repeats, *(round(_UNIT * v) for v in vector))


def text_statistics(docs: DataFrame, *, id_col: str, text_col: str, groups: list[str]) -> DataFrame:
    """id, the group columns g0, g1..., the counts, and the vector in whole units."""

    names = [*_STATS, *VECTOR]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ["id", *(f"g{n}" for n in range(len(groups)))]
        for batch in slices(batches):
            rows = np.array([statistics(t) for t in texts_of(batch)], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(column) for column in rows.T.copy()],
                [*kept, *names],
            )

    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        # Null is a group of its own, and no name's neighbour.
        *(F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("-")).alias(f"g{n}")
          for n, g in enumerate(groups)),
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name != "text")
    return source.mapInArrow(compute, kinds + "".join(f", {n} bigint" for n in names))


def chi_square(share: float, dimensions: int) -> float:
    """The quantile of a chi-square distribution (Wilson and Hilferty)."""
    spread = 2 / (9 * dimensions)
    return dimensions * (1 - spread + NormalDist().inv_cdf(share) * spread**0.5) ** 3


def _middle(counts: DataFrame, by: list[str], value: str, name: str = "middle") -> DataFrame:
    """The middle of whole numbers per group, from the ``count`` of each value."""
    running = Window.partitionBy(*by).orderBy(value)
    below = counts.withColumn("upto", F.sum("count").over(running)).withColumn(
        "total", F.sum("count").over(Window.partitionBy(*by))
    )
    return below.where(F.col("upto") * 2 >= F.col("total")).groupBy(*by).agg(F.min(value).alias(name))


def _median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The middle of whole numbers per group."""
    return _middle(rows.groupBy(*by, value).count(), by, value)


class _Estimates:
    """The rows of a stored table of groups that batches of rows ask for.

    The rows lie in the order of their groups, so what is read is bounded by a batch.
    """

    def __init__(self, uri: str, columns: list[str]):
        system, path = file_system(uri)
        self.source = dataset.dataset(path, filesystem=system, format="parquet")
        self.columns, self.places, self.values = columns, {}, {}

    def of(self, groups: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """For every row the number of its group, -1 without one; and the columns by that number."""
        coded = groups.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if not all(name in self.places for name in names):
            group = pc.field("group")
            found = self.source.to_table(
                ["group", *self.columns], filter=(group >= min(names)) & (group <= max(names))
            )
            self.places = {name: n for n, name in enumerate(found["group"].to_pylist())}
            self.places |= {name: -1 for name in names if name not in self.places}
            self.values = {
                name: np.array(found[name].to_pylist()) for name in self.columns if found.num_rows
            }
        numbers = np.array([self.places[name] for name in names], np.int64)
        return numbers[coded.indices.to_numpy(zero_copy_only=False)], self.values


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in VECTOR], axis=1)


def _distances(vectors: np.ndarray, centre: np.ndarray, precision: np.ndarray) -> np.ndarray:
    """Squared Mahalanobis distances, each from its own centre."""
    gaps = vectors / _UNIT - centre
    return np.einsum("ij,ijk,ik->i", gaps, precision.reshape(-1, len(VECTOR), len(VECTOR)), gaps)


def _ranks(distances: np.ndarray) -> np.ndarray:
    """Distances in whole steps of a thousandth of their logarithm, for counting."""
    return np.rint(1000 * np.log(1e-6 + np.maximum(distances, 0.0))).astype(np.int64)


def _cuts(usable: DataFrame, estimate: str) -> DataFrame:
    """The middle rank, ``cut``, of every moving group's distances from its estimate."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Estimates(estimate, ["centre", "precision", "moving"])
        for batch in batches:
            if not batch.num_rows:
                continue
            group, values = known.of(batch.column("group"))
            rows = np.flatnonzero(values["moving"][group])
            if not len(rows):
                continue
            at = group[rows]
            ranks = _ranks(_distances(_vectors(batch)[rows], values["centre"][at], values["precision"][at]))
            pairs, first, counts = np.unique(
                np.stack([at, ranks], axis=1), axis=0, return_index=True, return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("group").take(pa.array(rows[first])), pa.array(pairs[:, 1]), pa.array(counts)],
                ["group", "rank", "rows"],
            )

    counts = usable.select("group", *VECTOR).mapInArrow(count, "group string, rank bigint, rows bigint")
    return _middle(counts.groupBy("group", "rank").agg(F.sum("rows").alias("count")), ["group"], "rank", "cut")


def _near_sums(usable: DataFrame, estimate: str, cuts: str) -> DataFrame:
    """Per moving group and ``k`` the ``total`` of the rows up to its cut.

    k 0 counts them, then come the sums about the middles and those of the products of two.
    """
    size = len(VECTOR)
    left, right = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Estimates(estimate, ["middle", "centre", "precision", "moving"])
        limits = _Estimates(cuts, ["cut"])
        for batch in batches:
            if not batch.num_rows:
                continue
            group, values = known.of(batch.column("group"))
            rows = np.flatnonzero(values["moving"][group])
            if not len(rows):
                continue
            at, vectors = group[rows], _vectors(batch)[rows]
            limit, cut = limits.of(batch.column("group").take(pa.array(rows)))
            ranks = _ranks(_distances(vectors, values["centre"][at], values["precision"][at]))
            near = np.flatnonzero(ranks <= cut["cut"][limit])
            near = near[np.argsort(at[near], kind="stable")]
            if not len(near):
                continue
            about = vectors[near] - values["middle"][at[near]]
            terms = np.concatenate(
                [np.ones((len(near), 1), np.int64), about, about[:, left] * about[:, right]], axis=1
            )
            first = np.flatnonzero(np.r_[True, np.diff(at[near]) > 0])
            totals = np.add.reduceat(terms, first, axis=0)
            width = totals.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group").take(pa.array(np.repeat(rows[near[first]], width))),
                 pa.array(np.tile(np.arange(width, dtype=np.int32), len(first))), pa.array(totals.ravel())],
                ["group", "k", "total"],
            )

    return (
        usable.select("group", *VECTOR).mapInArrow(add, "group string, k int, total bigint")
        .groupBy("group", "k").agg(F.sum(F.col("total").cast("decimal(20,0)")).cast("double").alias("total"))
    )


_ESTIMATE = (
    "group string, middle array<bigint>, centre array<double>, precision array<double>, "
    "volume double, moving boolean"
)


def _estimates(sums: DataFrame, estimate: str) -> DataFrame:
    """The moving groups' next estimates; a group whose determinant falls no more keeps its own."""
    size = len(VECTOR)
    left, right = np.triu_indices(size)
    floors = np.array(list(VECTOR.values()))
    parts = ["middle", "centre", "precision", "volume"]

    def invert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Estimates(estimate, parts)
        for frame in frames:
            out = []
            if len(frame):
                at, values = known.of(pa.array(frame["group"], pa.string()))
            for number, name, totals in zip(range(len(frame)), frame["group"], frame["totals"]):
                middle, centre, precision, volume = (values[c][at[number]] for c in parts)
                totals = np.array(totals)
                mean, second = totals[1:size + 1] / totals[0], totals[size + 1:] / totals[0]
                cov = np.empty((size, size))
                cov[left, right] = cov[right, left] = second - mean[left] * mean[right]
                # The floors keep near-constant statistics from making the matrix singular.
                fresh = np.linalg.inv(cov / _UNIT**2 + np.diag(floors**2))
                found = -np.linalg.slogdet(fresh)[1]
                moving = bool(found < volume)
                if moving:
                    centre, precision, volume = (mean + middle) / _UNIT, fresh.ravel(), found
                out.append((name, middle.tolist(), centre.tolist(), precision.tolist(), float(volume), moving))
            yield pd.DataFrame(out, columns=["group", *parts, "moving"])

    totals = F.transform(F.array_sort(F.collect_list(F.struct("k", "total"))), lambda s: s["total"])
    return sums.groupBy("group").agg(totals.alias("totals")).mapInPandas(invert, _ESTIMATE)


def _start(usable: DataFrame) -> DataFrame:
    """Coordinatewise medians, and the spreads about them, as first estimates."""
    names, size = list(VECTOR), len(VECTOR)
    long = usable.select("group", F.posexplode(F.array(*names)).alias("axis", "value"))
    middles = stage(
        _median(long, ["group", "axis"], "value").groupBy("group").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("axis", "middle"))), lambda s: s["middle"])
            .alias("middle")
        ), "middles",
    )
    gaps = long.join(middles, "group").select(
        "group", "axis", F.abs(F.col("value") - F.element_at("middle", F.col("axis") + 1)).alias("gap")
    )
    floor = F.array(*[F.lit(v) for v in VECTOR.values()])
    spread = F.greatest(1.4826 * F.col("middle") / _UNIT, F.element_at(floor, F.col("axis") + 1))
    return (
        _median(gaps, ["group", "axis"], "gap").select("group", "axis", (1 / (spread * spread)).alias("w"))
        .groupBy("group").agg(F.array_sort(F.collect_list(F.struct("axis", "w"))).alias("w"))
        .join(middles, "group")
        .select(
            "group", "middle", F.transform("middle", lambda m: m / _UNIT).alias("centre"),
            F.flatten(F.transform("w", lambda s: F.transform(
                F.sequence(F.lit(0), F.lit(size - 1)),
                lambda k: F.when(k == s["axis"], s["w"]).otherwise(F.lit(0.0)),
            ))).alias("precision"),
            F.lit(float("inf")).alias("volume"), F.lit(True).alias("moving"),
        )
    )


def _keep(table: DataFrame, label: str) -> str:
    """Write a table of groups in their order; where it lies."""
    path = fresh_path(table.sparkSession, label)
    table.orderBy("group").write.parquet(path)
    return qualified(table.sparkSession, path)


def robust_distances(rows: DataFrame, *, steps: int | None = None) -> DataFrame:
    """The squared robust distance of every row of ``text_statistics``, as ``distance``.

    Every group is estimated from its own rows, however few; the floors of
    ``VECTOR`` keep its matrix regular. A group's steps go on until
    its determinant falls no more, or ``steps`` are done if given. Only rows with ``usable`` set enter the
    estimates. ``distance`` is scaled down so that the
    middle of each group is at most the middle of a chi-square distribution; it is null
    where a group has no usable row.

    The rows are written once in the order of their groups, a large group over
    many files. A step is two passes over them: one counts distances, one adds up the rows up to
    each group's middle distance. Tasks read the estimates of the groups in their own batches
    from the shared folder, so nothing is joined, broadcast or sent to the driver.
    """
    spark = rows.sparkSession
    keys = [c for c in rows.columns if c[0] == "g" and c[1:].isdigit()]
    ordered = rows.withColumn("group", F.to_json(F.struct(*keys))).orderBy(
        "group", F.monotonically_increasing_id()
    )
    placed = stage(ordered, "vectors")
    usable = placed.where("usable")
    estimate = _keep(_start(usable), "estimate")
    moving, done = not spark.read.parquet(estimate).isEmpty(), 0
    # Every step that counts lowers a determinant, and there are finitely many halves: it ends.
    while moving and (steps is None or done < steps):
        cuts = _keep(_cuts(usable, estimate), "cuts")
        new = _estimates(_near_sums(usable, estimate, cuts), estimate)
        old = spark.read.schema(_ESTIMATE).parquet(estimate)
        seen = Observation()
        estimate = _keep(
            old.where("not moving").unionByName(new).observe(seen, F.count_if("moving").alias("moving")),
            "estimate",
        )
        moving, done = seen.get["moving"] > 0, done + 1
    # The middle of the distances tells by how much the half's covariance is too small.
    settled = _keep(
        spark.read.schema(_ESTIMATE).parquet(estimate).withColumn("moving", F.lit(True)), "settled"
    )
    middles = _keep(_cuts(usable, settled), "cuts")
    size = len(VECTOR)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, middle = _Estimates(settled, ["centre", "precision"]), _Estimates(middles, ["cut"])
        for batch in batches:
            group, values = known.of(batch.column("group"))
            number, cut = middle.of(batch.column("group"))
            found = np.flatnonzero(group >= 0)
            distance = np.full(batch.num_rows, np.nan)
            if len(found):
                at = group[found]
                scale = (np.exp(cut["cut"][number[found]] / 1000) - 1e-6) / chi_square(0.5, size)
                distance[found] = _distances(
                    _vectors(batch)[found], values["centre"][at], values["precision"][at]
                ) / np.maximum(scale, 1.0)
            yield batch.append_column("distance", pa.array(distance, mask=group < 0))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema)
    return placed.mapInArrow(measure, f"{kinds}, distance double")


def judge_texts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    groups: tuple[str, ...] = ("lang", "source"), min_words: int = 10, repeat_percent: int = 20,
    tail: float = 1e-9, steps: int | None = None,
) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` and ``kept`` for every row.

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``repeat_percent`` of 100 words lie in repeated 5-word windows. Other rows
    are kept unless their squared robust distance from their group's centre is
    beyond what a normal vector passes with probability ``tail``. Rows that
    failed do not enter the estimates.

    One row per input row; repeated rows get equal results and count as often as
    they are there. A null or empty text has no words and fails. Null languages
    and sources are groups of their own. Extra columns are not looked at. No
    rows give no rows. Of rows at the same distance from their centre, as counted in steps of a
    thousandth, all or none belong to the nearer half. A text is looked at as a whole: a task
    needs some hundred bytes for each of its words.
    """
    stats = text_statistics(docs, id_col=id_col, text_col=text_col, groups=list(groups))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    rows = stage(stats.withColumn("usable", ~failed), "statistics")
    limit = chi_square(1 - tail, len(VECTOR))
    inside = F.coalesce(F.col("distance") <= limit, F.lit(True))
    return robust_distances(rows, steps=steps).select(
        F.col("id").alias(id_col), *_STATS, (~F.col("usable")).alias("base_failed"), "distance",
        (F.col("usable") & inside).alias("kept"),
    )
