"""Every registered query against its SQL, and what its plan must not hold."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.compare import differences
from workloads import QUERIES, SQL

NAMES = sorted(QUERIES)
# Joins of everything with everything, and rows handed to Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython")


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().toString()
    assert not [part for part in UNWANTED if part in plan]
    assert differences(df, duck, SQL[name]) == []


@pytest.mark.parametrize("largest", [899_999, 0, None])
def test_references_below_a_large_key_agree_with_their_sql(spark, tmp_path, largest):
    """At 5756 and the ids after it a second word of the draw would carry into the reference."""
    ids = [5756, 0, 9_000_000, 2**31 + 5, 2**45 + 5756, -3, None, *range(20_000, 60_000)]
    orders = [(key,) for key in ids]
    spark.createDataFrame(orders, "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    customers = spark.createDataFrame([(largest,), (None,)], "c_custkey bigint")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    for table in ("orders", "customer"):
        con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert differences(QUERIES["max_key_param"](spark, str(tmp_path)), con, SQL["max_key_param"]) == []


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= entry_module.queries().keys()
    assert set(SQL) <= entry_module.oracle_sql().keys() <= entry_module.queries().keys()


def test_comparison_sees_a_difference(spark, sf_dir, duck):
    df = QUERIES["gen_users"](spark, sf_dir)
    assert differences(df, duck, SQL["gen_users"].replace("1103515245", "1566083941"))
    assert differences(df, duck, SQL["gen_users"] + " LIMIT 7")
    assert differences(df.drop("age"), duck, SQL["gen_users"])


def test_entry_shows_the_copy_before_and_after(spark):
    rows = {r["table_name"]: r for r in entry_module.entry(spark).collect()}
    assert rows["before"]["status"] == "In Progress"
    assert rows["after"]["status"] == "Completed"
    assert rows["after"]["percent"] == 100.0
