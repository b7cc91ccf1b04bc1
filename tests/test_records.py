"""Tables with records: defaults, columns that take no NULL, and the order of creation."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.model import TableSpec
from tablesync.operators.catalog import table_records
from tablesync.operators.conform import conform_rows
from tablesync.plans.copy import copy_table
from tablesync.plans.merge import merge_rows
from tablesync.plans.structure import creation_rounds, ensure_catalog_tables, ensure_tables
from tablesync.session import fresh_path
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.records import ColumnRule, Reference, TableRecord, read_record, record_of
from tablesync.sources.versions import open_table, table_path

NOW = datetime(2024, 6, 1, 12)
SPEC = TableSpec("shop", "items", ("id",))
RECORD = TableRecord((
    ColumnRule("id", "bigint", False), ColumnRule("name", "string", False),
    ColumnRule("state", "string", False, "new"), ColumnRule("weight", "decimal(8,2)", True, "1.50"),
    ColumnRule("seen", "timestamp_ntz", False, "CURRENT_TIMESTAMP"), ColumnRule("note", "string", True, "NULL"),
), ("id",), (Reference(("name",), "shop.names", ("id",)),))


def created(spark):
    root = fresh_path(spark, "root")
    ensure_tables(spark, {SPEC: spark.createDataFrame([], RECORD.schema)}, root, records={SPEC: RECORD})
    return root


def test_a_record_is_kept_as_it_is(spark):
    root = created(spark)
    path = table_path(root, SPEC)
    assert read_record(spark, path) == RECORD
    other = TableRecord((ColumnRule("id", "int"),))
    ensure_tables(spark, {SPEC: spark.createDataFrame([], other.schema)}, root, records={SPEC: other})
    assert read_record(spark, path) == RECORD
    assert read_record(spark, path + "-none") is None
    schema = T.StructType([T.StructField("a", T.IntegerType(), False, {"default": "7"}),
                           T.StructField("b", T.ArrayType(T.StringType()))])
    assert record_of(schema).schema == schema


def test_left_out_columns_get_their_defaults(spark):
    rows = spark.createDataFrame([("x", 1, None), ("y", 2, "here")], "NAME string, id bigint, note string")
    got = [tuple(r) for r in conform_rows(rows, RECORD, NOW).orderBy("id").collect()]
    weight = got[0][3]
    assert got == [(1, "x", "new", weight, NOW, None), (2, "y", "new", weight, NOW, "here")]
    assert str(weight) == "1.50"


def test_what_does_not_fit_is_refused(spark):
    with pytest.raises(ValueError, match="does not have: extra"):
        conform_rows(spark.createDataFrame([(1, "x", 2)], "id bigint, name string, extra int"), RECORD, NOW)
    with pytest.raises(ValueError, match="left out: name"):
        conform_rows(spark.createDataFrame([(1,)], "id bigint"), RECORD, NOW)


@pytest.mark.parametrize("rows_per_range", [None, 3])
def test_a_copy_with_a_null_where_none_may_be_fails(spark, rows_per_range):
    root, ledger = created(spark), Ledger(spark, fresh_path(spark, "ledger"), "run")
    rows = [(n, None if n == 7 else f"n{n}") for n in range(10)]
    source = spark.createDataFrame(rows, "id bigint, name string")
    with pytest.raises(PySparkException, match="column name must not be NULL"):
        copy_table(source, SPEC, NOW, root=root, rows_per_range=rows_per_range, ledger=ledger)
    assert open_table(spark, root, SPEC).count() == 0
    assert ledger.events().filter("op = 'error'").first()["message"].count("column name must not be NULL")
    whole = source.withColumn("name", F.coalesce("name", F.lit("seven")))
    result = copy_table(whole, SPEC, NOW, root=root, rows_per_range=rows_per_range, ledger=ledger)
    assert result.rows == 10 and open_table(spark, root, SPEC).filter("state = 'new'").count() == 10


def test_a_merge_is_held_to_the_record(spark):
    root = created(spark)
    copy_table(spark.range(5).select("id", F.lit("a").alias("name")), SPEC, NOW, root=root)
    merge_rows(spark.createDataFrame([(3, "b", "old"), (9, "c", "old")], "id bigint, name string, state string"),
               SPEC, root, run_ts=NOW)
    got = open_table(spark, root, SPEC).orderBy("id").collect()
    assert [(r["id"], r["name"], r["state"], r["seen"]) for r in got] == [
        (0, "a", "new", NOW), (1, "a", "new", NOW), (2, "a", "new", NOW), (3, "b", "old", NOW),
        (4, "a", "new", NOW), (9, "c", "old", NOW)]
    with pytest.raises(PySparkException, match="must not be NULL"):
        merge_rows(spark.createDataFrame([(3, None)], "id bigint, name string"), SPEC, root)
    assert open_table(spark, root, SPEC).filter("id = 3").first()["name"] == "b"


def test_rounds_follow_references():
    parents = {"items": {"orders", "products"}, "orders": {"users"}, "users": set(), "products": {"products"},
               "away": {"elsewhere"}, "b": {"a"}, "a": {"b"}, "z": {"a"}, "aa": {"z"}}
    rounds = creation_rounds(parents)
    assert rounds == [["away", "products", "users"], ["orders"], ["items"], ["a"], ["b", "z"], ["aa"]]
    place = {name: n for n, names in enumerate(rounds) for name in names}
    assert place.keys() == parents.keys() and creation_rounds({}) == []


def test_records_from_an_inventory(spark):
    columns = spark.createDataFrame([
        ("s", "shop", "orders", 2, "user_id", "int", "YES", None),
        ("s", "shop", "orders", 1, "id", "bigint", "NO", None),
        ("s", "shop", "orders", 3, "state", "varchar(9)", "NO", "open"),
        ("s", "shop", "users", 1, "id", "int", "NO", None),
    ], "server string, table_schema string, table_name string, ordinal_position int, column_name string, "
       "column_type string, is_nullable string, column_default string")
    keys = spark.createDataFrame(
        [("s", "shop", t, "PRIMARY", 1, "id") for t in ("orders", "users")],
        "server string, table_schema string, table_name string, constraint_name string, ordinal_position int, "
        "column_name string")
    references = spark.createDataFrame([
        ("s", "shop", "orders", "PRIMARY", 1, "id", None, None, None),
        ("s", "shop", "orders", "fk", 1, "user_id", "shop", "users", "id"),
    ], "server string, table_schema string, table_name string, constraint_name string, ordinal_position int, "
       "column_name string, referenced_table_schema string, referenced_table_name string, "
       "referenced_column_name string")
    assert table_records(columns).count() == 2
    root = fresh_path(spark, "root")
    made = ensure_catalog_tables(spark, columns, root, key_usage=keys, references=references).collect()
    assert {(r["table_name"], r["n_columns"], r["created"]) for r in made} == {
        ("orders", 3, True), ("users", 1, True)}
    orders = TableSpec("shop", "orders")
    assert read_record(spark, table_path(f"{root}/s", orders)) == TableRecord(
        (ColumnRule("id", "bigint", False), ColumnRule("user_id", "int"),
         ColumnRule("state", "string", False, "open")),
        ("id",), (Reference(("user_id",), "shop.users", ("id",)),))
    rows = spark.createDataFrame([(1, 2)], "id bigint, user_id int")
    copy_table(rows, TableSpec("shop", "orders", ("id",)), NOW, root=f"{root}/s")
    assert [tuple(r) for r in open_table(spark, f"{root}/s", orders).collect()] == [(1, 2, "open")]
