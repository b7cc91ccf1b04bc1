"""The queries of this package, one per operator, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import (
    compression_quality,
    decontaminate,
    filter_audit,
    license_scan,
    line_dedup,
    nearest,
    packing,
    robust_rules,
    simhash,
    suffix_dedup,
    url_filter,
    warc,
    whitening,
)
from tablesync.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its SQL where SQL can say it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# The rules of the URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query("op10_url_filter", r"""
WITH parts AS (
  SELECT page_id,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS raw_host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), judged AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parts
), fitted AS (
  SELECT page_id, host, path,
    CASE
      WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
      WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
      WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
      WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/'
    END AS rule
  FROM judged
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fitted
""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(
        table(spark, sf_dir, "documents"),
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"),
    )
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op2_warc", """
WITH pages_read AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), headed AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS head FROM pages_read
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> head THEN head END AS refers_to
FROM headed
""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("url", "payload")


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def held_out() -> F.Column:
    """Documents whose labels may not be learned; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


@query("op4_compression_quality")
def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    scored = compression_quality.score_quality(table(spark, sf_dir, "documents"), labels)
    return scored.withColumn("held_out", held_out())


@query("op5_robust_rules")
def op5_robust_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_rules.judge_texts(table(spark, sf_dir, "documents"))


@query("op7_decontaminate", r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    array_to_string(words[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i
        FROM item_words WHERE len(words) > 0)
), windows AS (
  SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, size, unnest(range(1, greatest(len(words) - size + 2, 1))) AS i
        FROM doc_words, (SELECT DISTINCT size FROM phrases))
), found AS (
  SELECT doc_id, i, w.size, item_id FROM windows w JOIN phrases p ON w.size = p.size AND w.phrase = p.phrase
), hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.listed, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN items t ON t.doc_id = d.doc_id
""")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op1_line_dedup", r"""
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), every_line AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM texts
), worded AS (
  SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words
  FROM every_line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), paired AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY seq) AS following FROM worded
), marked AS (
  SELECT doc_id, seq, n_words, following,
    row_number() OVER (PARTITION BY line ORDER BY doc_id, seq) AS nth_line,
    row_number() OVER (PARTITION BY line, following ORDER BY doc_id, seq) AS nth_pair
  FROM paired
), gone AS (
  SELECT doc_id, seq FROM marked WHERE following IS NOT NULL AND nth_pair > 1
  UNION SELECT doc_id, seq + 1 FROM marked WHERE following IS NOT NULL AND nth_pair > 1
  UNION SELECT doc_id, seq FROM marked WHERE n_words >= 20 AND nth_line > 1
), runs AS (
  SELECT g.doc_id, count(*) AS n_removed, count(*) FILTER (WHERE n.seq IS NULL) AS n_runs
  FROM gone g LEFT JOIN gone n ON n.doc_id = g.doc_id AND n.seq = g.seq + 1 GROUP BY g.doc_id
), kept AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) AS text
  FROM every_line e LEFT JOIN worded w ON w.doc_id = e.doc_id AND w.pos = e.pos
  LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.seq = w.seq
  WHERE g.seq IS NULL GROUP BY e.doc_id
)
SELECT t.doc_id, CAST(len(t.lines) AS BIGINT) AS n_lines, coalesce(r.n_removed, 0) AS n_removed,
  coalesce(r.n_runs, 0) AS n_runs, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN runs r ON r.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.delete_repeated_lines(table(spark, sf_dir, "documents"))
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "n_runs",
        F.sha2(F.coalesce(F.encode("kept", "UTF-8"), F.lit(b"")), 256).alias("kept_sha256"),
    )


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # Null where the exact number is beyond what a long holds.
    return white.withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query("op13_nearest", """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS vector FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c)))
    AND list_bool_or(list_transform(embedding, lambda c: c <> 0))
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, vec_id, score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.pmod("id", F.lit(20)) == 0)


@query("op11_filter_audit", r"""
WITH worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marked AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INTEGER)), 0) AS good,
    coalesce(max(CAST(toxic = 1 AS INTEGER)), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    CAST(len(words) < 50 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INTEGER)
    + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS fails
  FROM worded w LEFT JOIN marked m ON m.doc_id = w.doc_id
), sets AS (
  SELECT part, fails, count(*) AS documents, sum(good) AS good, sum(toxic) AS toxic
  FROM judged GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits,
    a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS BIGINT) AS gone
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN fails & (gone | bit) = 0 THEN documents ELSE 0 END) AS kept,
    sum(CASE WHEN fails & gone = 0 AND fails & bit > 0 THEN documents ELSE 0 END) AS removed,
    sum(CASE WHEN fails & gone > 0 AND fails & bit > 0 THEN documents ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = bit THEN documents ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & gone = 0 AND fails & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & gone = 0 AND fails & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
