"""Former folders of tables, and what must stay."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.plans import commands
from tablesync.plans.copy import copy_table
from tablesync.plans.merge import merge_rows
from tablesync.session import fresh_path
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.versions import open_table, remove_former, table_path

NOW = datetime(2024, 6, 1, 12)
SPEC = TableSpec("shop", "items", ("id",))


def rows(spark, first, last, name="a"):
    return spark.range(first, last).select("id", F.lit(name).alias("name"))


def contents(spark, root):
    return {r["id"]: r["name"] for r in open_table(spark, root, SPEC).collect()}


def test_only_what_no_version_needs_goes(spark):
    root = fresh_path(spark, "root")
    path = table_path(root, SPEC)
    assert remove_former(spark, path, 0) == []
    copy_table(rows(spark, 0, 30), SPEC, NOW, root=root, rows_per_range=10)
    assert remove_former(spark, path, 0) == []
    merge_rows(rows(spark, 5, 7, "b"), SPEC, root)  # one of three folders is written anew
    merge_rows(rows(spark, 12, 14, "c"), SPEC, root)
    merge_rows(rows(spark, 5, 6, "d"), SPEC, root)  # the first merge's folder is no longer in use
    merge_rows(rows(spark, 40, 42, "e"), SPEC, root)
    before = contents(spark, root)
    assert remove_former(spark, path, 3600) == []
    gone = remove_former(spark, f"file:{path}/", 0)
    assert len(gone) == 3 and contents(spark, root) == before
    assert [before[n] for n in (4, 5, 6, 12, 29, 41)] == ["a", "d", "b", "c", "a", "e"]
    assert remove_former(spark, path, 0) == []
    merge_rows(rows(spark, 0, 1, "f"), SPEC, root)
    assert contents(spark, root) == before | {0: "f"}


def test_ranges_of_an_unfinished_copy_stay(spark):
    root, ledger = fresh_path(spark, "root"), Ledger(spark, fresh_path(spark, "ledger"), "run")
    copy_table(rows(spark, 0, 4), SPEC, NOW, root=root)
    broken = rows(spark, 0, 12).withColumn(
        "name", F.when(F.col("id") == 11, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(PySparkException):
        copy_table(broken, SPEC, NOW, root=root, rows_per_range=4, ledger=ledger)
    other = TableSpec("shop", "none")
    report = commands.clean_up(spark, [SPEC, other], root, ledger, keep_seconds=0).collect()
    assert [(r["table_name"], r["error"]) for r in report] == [("items", None), ("none", None)]
    result = copy_table(rows(spark, 0, 12), SPEC, NOW, root=root, rows_per_range=4, ledger=ledger)
    assert result.rows == 12 and len(contents(spark, root)) == 12
    assert commands.clean_up(spark, [SPEC], root, ledger, keep_seconds=0).first()["removed"] >= 1
    assert len(contents(spark, root)) == 12
