"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs once on small tables first, so that what is timed is the work and not the
start of the JVM, and counts with the better of two runs. Results go to the
``noop`` sink, except where writing is the query. ``copy_mb_per_sec`` and
``copy_rows_per_sec`` are taken from fresh copies of the largest tables into a
root of their own, with cleaning, in bytes of their values;
with ``BENCH_SCALING=1`` ``copy_mb_per_sec_by_cores`` repeats that on fewer cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tablesync.model import TableSpec  # noqa: E402
from tablesync.operators.skew import data_bytes  # noqa: E402
from tablesync.plans.copy import copy_tables  # noqa: E402
from tablesync.session import fresh_path, get_session  # noqa: E402
from workloads import QUERIES  # noqa: E402
from workloads.fixtures import RUN_TS  # noqa: E402
from workloads.registry import Inputs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")

HEADLINE = (
    "copy_table", "copy_table_resume", "copy_table_fresh", "copy_tables",
    "replace_into", "replace_into_multi_unique", "insert_ignore", "incremental_rows",
    "sanitize_rows", "sanitize_report", "validate_rows", "unique_violations", "orphan_rows",
    "batch_plan", "batch_assign", "ordered_scan", "row_counts", "count_check",
    "progress_report", "ledger_state", "ledger_summary", "resume_point",
    "catalog_columns", "index_groups", "missing_objects",
    "grant_statements", "dangling_grants", "gen_events", "gen_order_items",
    "stream_copy", "stream_sanitize", "stream_ledger",
)
COPIED = {"lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",),
          "documents": ("doc_id",)}
COPIES = 4
# With BENCH_SCALING=1 the copy is timed on 1, 2 and 4 cores as well, which takes minutes.
SCALING = os.environ.get("BENCH_SCALING") == "1"


def run(spark, name: str, sf_dir: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spent = time.perf_counter() - begin
    print(f"{name} {spent:.2f}", file=sys.stderr)
    return spent


def distinct_sources(spark, sf_dir: str) -> dict[TableSpec, DataFrame]:
    """The largest tables several times over under keys of their own, each time in files of
    its own, so that a copy has rows enough and reads no file twice."""
    inputs = Inputs(spark, sf_dir)
    sources = {}
    for table, keys in COPIED.items():
        path = fresh_path(spark, f"bench-{table}")
        for n in range(COPIES):
            shifted = inputs[table].withColumn(keys[0], F.col(keys[0]) + n * (1 << 40))
            shifted.repartition(2).write.mode("append").parquet(path)
        sources[TableSpec("bench", table, keys)] = spark.read.parquet(path)
    return sources


def copy_speed(spark, sf_dir: str) -> tuple[float, float]:
    """MB of data, by the width of their types, and rows per second of fresh copies."""
    sources = distinct_sources(spark, sf_dir)
    size = sum(data_bytes(df) for df in sources.values())
    best = None
    for _ in range(2):  # the first run is also the JIT's
        begin = time.perf_counter()
        _, results = copy_tables(spark, sources, RUN_TS, root=fresh_path(spark, "bench-copy"))
        spent = time.perf_counter() - begin
        best = spent if best is None else min(best, spent)
    return size / 1e6 / best, sum(result.rows for result in results.values()) / best


def session(cpus: int):
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session(int(CPUS))
    for name in HEADLINE:
        run(spark, name, WARM_DIR)
    seconds = {
        name: round(min(run(spark, name, SF_DIR) for _ in range(2)), 3) for name in HEADLINE
    }
    by_cores = {CPUS: copy_speed(spark, SF_DIR)}
    for cpus in (1, 2, 4):
        if SCALING and cpus < int(CPUS):
            spark.stop()
            spark = session(cpus)
            by_cores[str(cpus)] = copy_speed(spark, SF_DIR)
    megabytes, rows = by_cores[CPUS]
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "copy_mb_per_sec": round(megabytes, 2),
        "copy_rows_per_sec": round(rows),
        "copy_mb_per_sec_by_cores": {n: round(v[0], 2) for n, v in sorted(by_cores.items())},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
