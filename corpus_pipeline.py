"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes what its predecessor kept and returns the columns of its
input, the last one the packed pieces. Where a stage cuts text, ``n_chars``
follows, and a document goes only if the cut left it no word.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import compression_quality, decontaminate, line_dedup, packing, simhash
from tablesync.llm.common import stage, table
from tablesync.llm.queries import held_out


def _with_text(rows: DataFrame, like: DataFrame, text: Column, cut: Column) -> DataFrame:
    """The columns of ``like`` from ``row``, with the text that a stage left."""
    # A letter of either case, a digit, an underscore or anything beyond ASCII makes a word.
    worded = text.rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]")
    columns = [
        text.alias(name) if name == "text"
        else F.char_length(text).cast(kind).alias(name) if name == "n_chars"
        else F.col("row").getField(name).alias(name)
        for name, kind in like.dtypes
    ]
    return rows.where(~cut | worded).select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier gives a score of 0.7 or more."""
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = compression_quality.train(docs, labels)
    return compression_quality.add_scores(docs, model).where("score >= 0.7").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that occur earlier."""
    rows = line_dedup.delete_repeated_lines(docs)
    return _with_text(rows, docs, F.col("kept"), F.col("n_removed") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    rows = decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _with_text(rows, docs, F.col("clean"), F.col("n_hit") > 0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, with their places in sequences."""
    pieces = packing.pack_documents(
        docs, ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"),
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
    ("benchmark", benchmark), ("packing", pack),
]

# The classifier, the fingerprints and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
