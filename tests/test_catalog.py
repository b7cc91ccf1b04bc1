from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.functions.types import spark_type
from tablesync.model import TableSpec
from tablesync.operators import catalog as C
from tablesync.operators.catalog import missing_objects
from tablesync.operators.validate import default_from_text
from tablesync.plans.structure import ensure_catalog_tables
from tablesync.session import fresh_path
from tablesync.sources import inventory
from tablesync.sources.versions import open_table

TYPES = {
    "int": "int", "INT(11)": "int", "int(10) unsigned": "bigint", "tinyint(1)": "boolean",
    "tinyint(4)": "int", "bigint": "bigint", "bigint(20) unsigned": "decimal(20,0)",
    "decimal(10,2)": "decimal(10,2)", "numeric(8, 3)": "decimal(8,3)",
    "decimal(65,30)": "string", "decimal(38,30)": "decimal(38,30)", "decimal": "decimal(10,0)",
    "decimal(12)": "decimal(12,0)", "decimal(10,2) unsigned": "decimal(10,2)", "double": "double",
    "float(7,4)": "float", "varchar(255)": "string", "longtext": "string", "json": "string",
    "enum('int','date')": "string", "timestamp": "timestamp_ntz", "datetime(6)": "timestamp_ntz",
    "date": "date", "time": "string", "blob": "binary", "longblob": "binary",
    "varbinary(16)": "binary", "year(4)": "int", "boolean": "boolean", "point": "string",
}


def test_types(spark):
    df = spark.createDataFrame([(t,) for t in TYPES], "t string")
    found = {r["t"]: r["s"] for r in df.select("t", spark_type(F.col("t")).alias("s")).collect()}
    assert found == TYPES


@pytest.fixture
def columns(spark):
    rows = [
        ("s", "shop", "users", 2, "e`mail", "varchar(255)", "YES", "auto_increment "),
        ("s", "shop", "users", 1, "id", "int", "NO", "auto_increment"),
        ("s", "shop", "users", 3, "tenant", "bigint", "NO", None),
        ("s", "blog", "log", 1, "at", "timestamp", "YES", ""),
    ]
    return spark.createDataFrame(
        rows, "server string, table_schema string, table_name string, ordinal_position int, "
        "column_name string, column_type string, is_nullable string, extra string"
    ).withColumns({c: F.lit(None).cast("string")
                   for c in ("column_default", "character_set_name", "collation_name")})


def test_tables_from_an_inventory(spark, columns):
    root = fresh_path(spark, "root")
    rows = ensure_catalog_tables(spark, columns, root).collect()
    assert sorted(map(tuple, rows)) == [
        ("s", "blog", "log", 1, True), ("s", "shop", "users", 3, True)]
    made = open_table(spark, f"{root}/s", TableSpec("shop", "users"))
    assert [(f.name, f.dataType.simpleString()) for f in made.schema] == [
        ("id", "int"), ("e`mail", "string"), ("tenant", "bigint")]
    assert not any(r["created"] for r in ensure_catalog_tables(spark, columns, root).collect())


def test_two_servers_keep_their_tables_apart(spark, columns):
    root = fresh_path(spark, "root")
    other = columns.filter("table_name = 'log'").withColumn("server", F.lit("t"))
    rows = ensure_catalog_tables(spark, columns.unionByName(other), root).collect()
    assert [(r["server"], r["table_name"]) for r in rows if r["table_name"] == "log"] == [
        ("s", "log"), ("t", "log")]


def test_objects_are_looked_for_at_a_server_of_another_name(spark):
    tables = lambda server, *names: spark.createDataFrame(
        [(server, "db", n) for n in names], "server string, table_schema string, table_name string")
    index = lambda server, *names: spark.createDataFrame(
        [(server, "db", "a", n) for n in names],
        "server string, table_schema string, table_name string, index_name string")
    found = missing_objects(tables("src", "a", "b"), index("src", "PRIMARY", "i", "j"),
                            tables("dst", "a"), index("dst", "i")).collect()
    assert [tuple(r) for r in found] == [
        ("table", "src", "db", "b", None), ("index", "src", "db", "a", "j")]


def test_keys_flags_and_orders(spark, columns):
    tables = spark.createDataFrame(
        [("s", "shop", "users", "BASE TABLE"), ("s", "blog", "log", "BASE TABLE"),
         ("s", "shop", "v", "VIEW"), ("s", "mysql", "user", "BASE TABLE"),
         ("s", "blog", "bare", "BASE TABLE")],
        "server string, table_schema string, table_name string, table_type string")
    keys = spark.createDataFrame(
        [("s", "shop", "users", "PRIMARY", 1, "tenant"), ("s", "shop", "users", "PRIMARY", 2, "id"),
         ("s", "blog", "log", "fk", 1, "at")],
        "server string, table_schema string, table_name string, constraint_name string, "
        "ordinal_position int, column_name string")
    base = C.base_tables(tables)
    assert {r["table_name"] for r in base.collect()} == {"users", "log", "bare"}
    first = {r["table_name"]: r["key_column"]
             for r in C.first_key_column(base, columns, keys).collect()}
    # The key names tenant first, the table has id first.
    assert first == {"users": "id", "log": "id", "bare": "id"}
    order = {r["table_name"]: r["order_columns"]
             for r in C.order_columns(base, columns, keys).collect()}
    assert order == {"users": ["tenant", "id"], "log": ["at"], "bare": ["1"]}
    auto = {r["column_name"]: r["is_auto_increment"]
            for r in C.catalog_columns(columns, base).collect()}
    assert auto == {"id": True, "e`mail": False, "tenant": False, "at": False}


def test_targets(spark):
    tables = spark.createDataFrame(
        [("s", "shop", "users", "BASE TABLE"), ("s", "shop", "v", "VIEW")],
        "server string, table_schema string, table_name string, table_type string")
    assert C.select_targets(tables, "shop").count() == 1
    assert C.select_targets(tables, "shop.users").count() == 1
    for bad in ("a.b.c", "shop.", ".users", ""):
        with pytest.raises(ValueError):
            C.select_targets(tables, bad)
    for missing in ("none", "shop.none", "shop.v"):
        with pytest.raises(LookupError):
            C.select_targets(tables, missing)


def test_defaults_from_text(spark):
    now = datetime(2024, 6, 1, 12)
    row = spark.range(1).select(
        default_from_text("CURRENT_TIMESTAMP", "timestamp_ntz", now),
        default_from_text("NULL", "string", now), default_from_text(None, "int", now),
        default_from_text("0", "boolean", now), default_from_text("9.50", "decimal(10,2)", now),
    ).first()
    assert tuple(map(str, row)) == ("2024-06-01 12:00:00", "None", "None", "False", "9.50")


def test_inventory_frames_name_what_the_operators_read():
    assert "authentication_string <> '' AS has_password" in inventory.frame_query("accounts")
    assert all("AS password" not in inventory.frame_query(f) for f in inventory.FRAMES)
    names = {f: [i.rsplit(" AS ", 1)[1] for i in items] for f, (_, items) in inventory.FRAMES.items()}
    assert set(C.TABLE[1:]) <= set(names["columns"]) and "extra" in names["columns"]
    assert len(names["grants_global"]) == 30 and len(names["grants_db"]) == 22
