"""Joins and row picks when one key owns a third of the rows."""

import pytest
from pyspark.sql import functions as F

from tablesync.operators.skew import (
    data_bytes,
    first_per_key,
    hot_key_hashes,
    hot_share,
    join_on_key_set,
    latest_per_key,
    salted_join,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 rows: a third with key 7, a tenth with no key, the rest spread out."""
    row = F.col("id")
    key = F.when(row % 3 == 0, 7).when(row % 10 == 1, F.lit(None)).otherwise(row)
    return spark.range(9000).select(key.cast("bigint").alias("k"), row.alias("v"))


def test_hot_keys_are_found_and_bounded(spark, skewed):
    hot = hot_key_hashes(skewed, ["k"])
    expected = {r["h"] for r in spark.sql(
        "SELECT xxhash64(CAST(k AS BIGINT)) AS h FROM VALUES (7), (NULL) AS t(k)").collect()}
    assert expected <= set(hot)
    assert len(hot) <= 100


@pytest.mark.parametrize("how", ["left_anti", "left_semi", "left", "inner"])
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_salted_join_equals_the_plain_one(spark, skewed, how, broadcast):
    right = spark.range(0, 9000, 7).select(F.col("id").alias("k"))
    if how in ("left", "inner"):
        right = right.withColumn("w", F.col("k") * 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        salted = salted_join(skewed, right, ["k"], how)
        plain = skewed.join(right, "k", how)
        assert salted.columns == ["k", "v"] + ["w"] * (how in ("left", "inner"))
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["left_anti", "left_semi", "left"])
def test_a_key_set_is_broadcast_up_to_its_measured_size(spark, skewed, how):
    right = spark.range(0, 9000, 7).select(F.col("id").alias("k"))
    if how == "left":
        right = right.withColumn("w", F.lit("x"))
    assert data_bytes(right) == 1286 * (9 if how == "left" else 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = join_on_key_set(skewed, right, ["k"], how)
        large = join_on_key_set(skewed, right, ["k"], how, broadcast_bytes=1000)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (small, large)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans[0] and "hashpartitioning" not in plans[0]
    assert "SortMergeJoin" in plans[1] and "_salt" in plans[1]
    expected = sorted(map(str, skewed.join(right, "k", how).collect()))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect())) == expected


def test_hot_rows_are_spread_over_the_tasks(spark, skewed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = spark.range(0, 9000, 7).select(F.col("id").alias("k"))
        largest = (
            salted_join(skewed, right, ["k"], "left")
            .groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest < 2000  # 9,000 rows over 8 tasks; one hot key alone would be 3,000


def test_rows_beside_a_broadcast_are_not_written_out(spark, skewed):
    right = spark.range(0, 9000, 7).select(F.col("id").alias("k"))
    beside = skewed.join(F.broadcast(spark.range(100).select(F.col("id").alias("w"))), F.col("v") % 100 == F.col("w"))
    plans = [
        salted_join(left, right, ["k"], "left_anti")._jdf.queryExecution().optimizedPlan().toString()
        for left in (beside, beside.repartition(8, "v"))
    ]
    assert "_salt" in plans[0] and "Join Inner" in plans[0]  # the rows come straight from their join
    assert "_salt" in plans[1] and "Join Inner" not in plans[1]  # they come from what was written


def test_equal_rows_of_a_hot_key_are_spread_too(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
        right = spark.range(-1, 0).select(F.col("id").alias("k"))
        sizes = (
            salted_join(left, right, ["k"], "left_semi")
            .groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 10_000
    # Eight salts over eight partitions; without a spread one partition would hold all.
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 5000


def test_what_is_hot_follows_the_number_of_partitions(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 200 == 0, 1).otherwise(F.col("id")).alias("k"))
    mark = spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint"))).first()[0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert hot_share(spark) == 0.00025
        assert mark in hot_key_hashes(df, ["k"])  # half a per cent of the rows is ten partitions
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_measured_bytes_count_nested_values_and_rows(spark):
    df = spark.sql("SELECT array('abc') a, CAST(1 AS DECIMAL(30,0)) d, 1 i, CAST(NULL AS STRING) s")
    assert data_bytes(df) == len('["abc"]') + 16 + 4
    assert data_bytes(df, 48) == len('["abc"]') + 16 + 4 + 48


def test_one_row_per_key_is_cut_before_the_shuffle(spark, skewed):
    df = latest_per_key(skewed, ["k"], ["v"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert df.filter("k = 7").first()["v"] == 8997
    assert df.filter("k IS NULL").count() == 1


def test_first_per_key_by_any_order(skewed):
    row = first_per_key(skewed, ["k"], [F.col("v") % 100, F.col("v")]).filter("k = 7").first()
    assert row["v"] == 0


def test_rows_out_of_a_shuffle_have_fixed_places_before_they_are_salted(spark):
    rows = spark.range(4000).selectExpr("id % 2 * (id % 50) AS k", "id AS v")
    right = spark.range(50).selectExpr("id AS k", "id * 10 AS w")
    leaves = lambda df: df._jdf.queryExecution().analyzed().collectLeaves().mkString(" ")
    for left, written in ((rows, False), (rows.repartition(8, "v"), True)):
        joined = salted_join(left, right, ["k"], "left", share=0.2)
        assert ("parquet" in leaves(joined)) == written
        assert joined.filter("w <> k * 10 OR w IS NULL").isEmpty() and joined.count() == 4000
