import pytest
from pyspark.sql import functions as F

from tablesync.operators.paging import (
    batch_assign,
    batch_plan,
    batch_progress,
    indexed_page,
    keyset_filter,
    keyset_page,
    number_rows,
    offset_page,
    ordered_scan,
    write_rank_index,
)
from tablesync.session import fresh_path


@pytest.fixture(scope="module")
def even_ids(spark):
    """Ids 2, 4 … 200: a walk that takes a row count for a key loses nearly half of them."""
    return spark.range(2, 201, 2).withColumn("v", F.col("id") * 10)


@pytest.mark.parametrize("size", [1, 7, 10, 99, 100, 1000])
def test_batches_hold_every_row_once(even_ids, size):
    plan = batch_plan(even_ids, ["id"], size).orderBy("batch_id").collect()
    assert [p["batch_id"] for p in plan] == list(range(-(-100 // size)))
    assert all(p["rows"] == size for p in plan[:-1])
    assert sum(p["rows"] for p in plan) == 100
    assert [p["first_id"] for p in plan] == [2 + 2 * size * n for n in range(len(plan))]
    assert plan[-1]["last_id"] == 200
    walked = 0
    for p in plan:
        walked += even_ids.filter(f"id BETWEEN {p['first_id']} AND {p['last_id']}").count() \
            if size >= 10 else p["rows"]
    assert walked == 100


def test_keyset_pages_walk_over_gaps(even_ids):
    last, seen = None, []
    while True:
        page = [r["id"] for r in keyset_page(even_ids, ["id"], last, 30).collect()]
        if not page:
            break
        seen += page
        last = (page[-1],)
    assert seen == list(range(2, 201, 2))


def test_composite_keys_compare_column_by_column(spark):
    df = spark.createDataFrame([(1, 9), (2, 1), (2, 2), (2, 3), (3, 0)], "a int, b int")
    rows = keyset_filter(df, ["a", "b"], (2, 2)).orderBy("a", "b").collect()
    assert rows == [(2, 3), (3, 0)]
    assert keyset_filter(df, ["a", "b"], None).count() == 5


def test_leading_key_reaches_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    df = keyset_filter(lines, ["l_orderkey", "l_linenumber"], (500, 3)).select("l_partkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_orderkey,500)" in plan
    assert "l_extendedprice" not in plan


def test_one_key_with_a_third_of_the_rows_is_numbered_in_many_tasks(spark):
    row = F.col("id")
    df = spark.range(9000).select(
        F.when(row % 3 == 0, 7).otherwise(row).alias("k"), row.alias("v")
    )
    numbered = number_rows(df, ["k", "v"])
    assert sorted(r["row_no"] for r in numbered.select("row_no").collect()) == list(range(9000))
    # The order the plan sorts by: equal keys are split by the hash of the row.
    placed = df.withColumn("_tie", F.xxhash64("k", "v")).repartitionByRange(8, "k", "_tie")
    largest = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 2000
    plan = batch_plan(df, ["k"], 500).orderBy("batch_id").collect()
    assert len(plan) == 18 and sum(p["rows"] for p in plan) == 9000
    assert sum(p["first_k"] == 7 and p["last_k"] == 7 for p in plan) >= 5


def test_equal_rows_get_different_numbers(spark):
    df = spark.range(50).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    rows = batch_assign(df, ["k"], 20).collect()
    assert sorted(r["row_no"] for r in rows) == list(range(50))
    assert sorted(r["batch_id"] for r in rows) == [0] * 20 + [1] * 20 + [2] * 10


def test_order_and_pages_agree(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    ordered = [tuple(r) for r in ordered_scan(df, ["k"]).collect()]
    assert ordered == sorted(ordered)
    for offset in (0, 100, 490, 600):
        near = offset_page(df, ["k"], offset, 20)
        far = offset_page(df, ["k"], offset, 20, top_k_rows=0)
        assert [tuple(r) for r in near.collect()] == ordered[offset:offset + 20]
        assert [tuple(r) for r in far.collect()] == ordered[offset:offset + 20]


@pytest.mark.parametrize("step", [1, 7, 64, 10_000])
def test_pages_from_an_index(spark, step):
    path, table = fresh_path(spark, "ranks"), fresh_path(spark, "table")
    spark.range(500).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("v"), F.lit(1.5).alias("w"),
    ).write.parquet(table)
    df = spark.read.parquet(table)
    write_rank_index(df, ["k"], path, step)
    ordered = [tuple(r) for r in ordered_scan(df, ["k"]).collect()]
    for offset, size in ((0, 3), (40, 20), (123, 1), (490, 20), (500, 5), (900, 5), (0, 600)):
        page = indexed_page(df, ["k"], path, offset, size)
        assert [tuple(r) for r in page.collect()] == ordered[offset:offset + size]
    plan = indexed_page(df, ["k"], path, 300, 20)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan and "TakeOrderedAndProject" in plan
    assert step > 64 or "GreaterThanOrEqual(k" in plan  # the bounds reach the scan
    nothing = fresh_path(spark, "ranks")
    write_rank_index(df.limit(0), ["k"], nothing, step)
    assert indexed_page(df.limit(0), ["k"], nothing, 0, 5).collect() == []


def test_an_index_is_written_by_the_tasks_that_number_the_rows(spark):
    path, setting = fresh_path(spark, "ranks"), "spark.sql.adaptive.coalescePartitions.enabled"
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("k"))
    spark.conf.set(setting, "false")
    try:
        write_rank_index(df, ["k"], path, step=1)
    finally:
        spark.conf.unset(setting)
    index = spark.read.parquet(path)
    assert sorted(r["row_no"] for r in index.collect()) == list(range(5000))
    per_task = [r["count"] for r in index.groupBy(F.input_file_name()).count().collect()]
    assert len(per_task) >= 4 and max(per_task) < 2500
    assert [r["k"] for r in indexed_page(df, ["k"], path, 4321, 30).collect()] == list(range(4321, 4351))


def test_progress_after_each_batch(even_ids):
    plan = batch_plan(even_ids, ["id"], 30)
    rows = batch_progress(plan, 30, 100, width=40).orderBy("batch_id").collect()
    assert [r["processed_rows"] for r in rows] == [30, 60, 90, 100]
    assert [r["percent"] for r in rows] == [30.0, 60.0, 90.0, 100.0]
    assert [r["bar"].count("▓") for r in rows] == [12, 24, 36, 40]
    assert all(len(r["bar"]) == 42 for r in rows)


def test_no_rows_no_batches(spark):
    empty = spark.range(0)
    assert batch_plan(empty, ["id"], 10).count() == 0
    assert batch_assign(empty, ["id"], 10).count() == 0
