"""Deletes runs of lines that occur earlier in the corpus.

Texts are sequences of line ids. Ranks of runs of 1, 2, 4, ... lines are found
by prefix doubling: the rank of a run is the place where it occurs first, and
the rank of a run of twice the length comes from the ranks of its two halves.
A place whose run occurs nowhere else drops out of every later round, so what
is left are the places whose longest common prefix with another is long enough;
neighbouring ones make up the maximal repeated runs. Everything is columns:
groupings that are summed up per task, joins and windows within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesync.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
_LAST_ID = (1 << 63) - 1
_PLACE = ["oid", "key", "seq"]


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row with its place in the order of texts, its lines, and the numbers of lines
    that have a word."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST_ID)).alias("oid"),
        F.xxhash64(text).alias("key"), lines.alias("lines"),
    )


def _rank(places: DataFrame, name: list[str]) -> DataFrame:
    """The places whose name occurs at another place too, with its first place as ``rank``."""
    place = F.struct(*_PLACE)
    firsts = (
        places.groupBy(*name).agg(F.min(place).alias("rank"), F.max(place).alias("last"))
        .where("rank < last").drop("last")
    )
    # Written first: both sides of the join are then dealt out for it, and a very common line's
    # places can be split over tasks.
    return places.join(stage(firsts, "firsts"), name).drop(*name)


def _double(ranked: DataFrame, ahead: int) -> DataFrame:
    """Ranks of longer runs from those of a run and the run ``ahead`` lines further."""
    along = Window.partitionBy("oid", "key").orderBy("seq")
    # Within a repeated run every line starts a repeated run, so the next rows are the next lines.
    paired = ranked.withColumn("next", F.lead(F.struct("seq", "rank"), ahead).over(along)).where(
        F.col("next.seq") == F.col("seq") + ahead
    )
    return _rank(paired.select(*_PLACE, F.col("rank").alias("a"), F.col("next.rank").alias("b")), ["a", "b"])


def repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2,
    min_words: int = 20,
) -> DataFrame:
    """(oid, key, removed): per text the numbers, among its lines with words, that go."""
    numbered = _numbered(docs, id_col, text_col)
    lines = stage(
        numbered.select(
            "oid", "key", F.posexplode(F.filter("lines", lambda line: line.rlike(WORD))).alias("seq", "line")
        ).select(
            *_PLACE, F.xxhash64("line").alias("a"), F.xxhash64(F.lit("again"), "line").alias("b"),
            (F.regexp_count("line", F.lit(WORD)) >= min_words).alias("long"),
        ).dropDuplicates(_PLACE),
        "lines",
    )
    single = stage(_rank(lines, ["a", "b"]), "ranks")
    ranked, size = single.drop("long"), 1
    while size < min_lines:
        ahead = min(size, min_lines - size)
        ranked, size = stage(_double(ranked, ahead), "ranks"), size + ahead
    later = F.col("rank") < F.struct(*_PLACE)
    runs = ranked.where(later).select(
        "oid", "key", F.explode(F.sequence("seq", F.col("seq") + (size - 1))).alias("seq")
    )
    alone = single.where(later & F.col("long")).select(*_PLACE)
    return runs.unionByName(alone).groupBy("oid", "key").agg(
        F.sort_array(F.collect_set("seq")).alias("removed")
    )


def _kept(lines: Column, worded: Column, removed: Column) -> Column:
    """The text without the removed lines."""
    gone = F.transform(removed, lambda n: F.get(worded, n))
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    return F.array_join(F.transform(F.array_except(every, gone), lambda n: F.get(lines, n)), "\n")


def delete_repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2,
    min_words: int = 20,
) -> DataFrame:
    """Every row as ``row`` (a struct of the input's columns), with ``kept``, the text that is
    left, ``n_lines``, ``n_removed`` lines and ``n_runs`` that they make up.

    Lines are split at line feeds. Lines without a word (nothing but ASCII white
    space) stay and are no part of a run, nor do they break one. A run of
    ``min_lines`` lines, or one line of ``min_words`` words, that also starts
    earlier is deleted: earlier is a row with a smaller id, or further ahead in
    the same text. Overlapping copies count, and runs are judged on the input.

    Ids are whole numbers; a null id is larger than all others. Rows with equal
    id and text are one document: they get the same result, and are not each
    other's copies. Of rows with equal id and different texts the smaller text
    hash comes first. A null text is empty and stays null. Extra columns are
    kept in ``row`` whatever their names. No rows give no rows. Texts of any
    length are taken whole. Lines are compared by 128 bits of hashes.
    """
    removed = repeated_lines(
        docs, id_col=id_col, text_col=text_col, min_lines=min_lines, min_words=min_words
    )
    # Split and numbered below the join, so that the work is done once per row.
    numbered = _numbered(docs, id_col, text_col).withColumn(
        "worded", F.filter(
            F.transform("lines", lambda line, n: F.when(line.rlike(WORD), n)), lambda n: n.isNotNull()
        )
    )
    joined = numbered.join(removed, ["oid", "key"], "left")
    gone = F.col("removed")
    ends = F.array_except(F.transform(gone, lambda n: n + 1), gone)
    return joined.select(
        "row",
        F.when(gone.isNull(), F.col(f"row.{text_col}"))
        .otherwise(_kept(F.col("lines"), F.col("worded"), gone)).alias("kept"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.size(ends), F.lit(0)).cast("bigint").alias("n_runs"),
    )
