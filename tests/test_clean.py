from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablesync.functions.dates import is_tracked
from tablesync.operators.clean import sanitize_report, sanitize_rows
from tablesync.operators.validate import (
    apply_defaults,
    enum_violations,
    null_violations,
    orphan_rows,
    set_null_delete,
    unique_violations,
    validate_rows,
)

NOW = datetime(2024, 6, 1, 12, 0, 0)

CASES = [
    # value, in a tracked column, in another column
    (None, None, None),
    ("", "", ""),
    ("0000-00-00", "2024-06-01 12:00:00", "1970-01-01 00:00:01"),
    ("0000-00-00 00:00:00.000000", "2024-06-01 12:00:00", "1970-01-01 00:00:01"),
    ("0000-00-00-note", "2024-06-01 12:00:00", "1970-01-01 00:00:01"),
    ("1000-01-01 00:00:00", "2024-06-01 12:00:00", "1970-01-01 00:00:01"),
    ("1000-01-01 00:00:00.5", "2024-06-01 12:00:00", "1970-01-01 00:00:01"),
    ("1000-01-01", "2024-06-01", "1970-01-01"),
    ("1000-01-01 12:00:00", "1000-01-01 12:00:00", "1000-01-01 12:00:00"),
    ("1000-01-02", "1000-01-02", "1000-01-02"),
    (" 0000-00-00", " 0000-00-00", " 0000-00-00"),
]


@pytest.mark.parametrize(
    "name, tracked",
    [
        ("created_at", True), ("CreatedAt", True), ("date_created_utc", True),
        ("creation_date", True), ("UPDATED_AT", True), ("modification_date", True),
        ("last_modified_by", True), ("recreated", True), ("modified", False),
        ("create_time", False), ("shipped_date", False), ("update_ts", False),
    ],
)
def test_column_names_that_are_tracked(name, tracked):
    assert is_tracked(name) is tracked


def test_text_rule_case_by_case(spark):
    rows = [(n, value, value, value) for n, (value, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, created_at string, last_modified string, other string")
    found = {r["n"]: r for r in sanitize_rows(df, NOW).collect()}
    for n, (_, tracked, plain) in enumerate(CASES):
        assert found[n]["created_at"] == found[n]["last_modified"] == tracked
        assert found[n]["other"] == plain


def test_types_keep_their_rule(spark):
    df = spark.createDataFrame(
        [
            (1, datetime(999, 12, 31), date(1, 1, 1), bytearray(b"0000-00-00"), 5.0),
            (2, datetime(1000, 1, 1), date(1000, 1, 1), bytearray("é".encode()), None),
            (3, None, None, None, 1.5),
        ],
        "id int, shipped timestamp_ntz, day date, note binary, amount double",
    )
    a, b, c = sanitize_rows(df, NOW, text_bytes=["note"]).orderBy("id").collect()
    assert (a.shipped, a.day, a.note) == (NOW, NOW.date(), "1970-01-01 00:00:01")
    assert (b.shipped, b.day, b.note) == (datetime(1000, 1, 1), date(1000, 1, 1), "é")
    assert (c.shipped, c.day, c.note) == (None, None, None)
    kept = sanitize_rows(df, NOW).orderBy("id").collect()
    assert bytes(kept[0].note) == b"0000-00-00"


def test_bytes_that_are_no_text_are_carried_over(spark):
    df = spark.createDataFrame([(bytearray(b"\xff\x00\xfe"),)], "blob binary")
    kept = sanitize_rows(df, NOW)
    assert kept.schema == df.schema and bytes(kept.first()[0]) == b"\xff\x00\xfe"
    text = sanitize_rows(df, NOW, text_bytes=["blob"]).select(F.col("blob").cast("binary")).first()[0]
    assert bytes(text) == b"\xff\x00\xfe"


def test_a_table_without_limits_breaks_none(spark):
    df = spark.createDataFrame([(1, True)], "id int, flag boolean")
    found = validate_rows(df, ["id"])
    assert found.columns == ["id", "column_name", "rule", "measure"] and found.collect() == []


def test_only_named_columns_are_cleaned(spark):
    df = spark.createDataFrame([("0000-00-00", "0000-00-00")], "a string, b string")
    assert sanitize_rows(df, NOW, columns=["b"]).first() == ("0000-00-00", "1970-01-01 00:00:01")


def test_cleaning_twice_changes_nothing_more(spark):
    df = spark.createDataFrame([(v,) for v, _, _ in CASES], "shipped_date string")
    once = sanitize_rows(df, NOW)
    assert sanitize_report(once, NOW, "t").count() == 0
    report = sanitize_report(df, NOW, "t").collect()
    assert sum(r["rows"] for r in report) == 6


def test_limits_count_bytes_and_only_positive_numbers(spark):
    df = spark.createDataFrame(
        [(1, "é" * 3, 1e15, None), (2, "abcde", 1.1e15, "é" * 3), (3, None, -1e16, "x"), (4, "", float("nan"), "")],
        "id int, a string, n double, b string",
    )
    found = {(r["id"], r["column_name"]): (r["rule"], r["measure"])
             for r in validate_rows(df, ["id"], max_bytes=5).collect()}
    assert found == {
        (1, "a"): ("too_long", 6.0), (2, "n"): ("too_large", 1.1e15), (2, "b"): ("too_long", 6.0)
    }


def test_domain_null_and_key_checks(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "z"), (2, None), (None, "a"), (None, "b")], "k int, v string"
    )
    assert [r["v"] for r in enum_violations(df, "v", ["a", "b"]).collect()] == ["z"]
    nulls = {r["column_name"]: r["nulls"] for r in null_violations(df, ["k", "v"]).collect()}
    assert nulls == {"k": 2, "v": 1}
    assert unique_violations(df, ["k"]).collect() == [(1, 2)]


def test_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (10,)], "pk int")
    assert [r["id"] for r in orphan_rows(child, "fk", parent, "pk").collect()] == [2]
    kept = {r["id"]: r["fk"] for r in set_null_delete(child, "fk", parent, "pk").collect()}
    assert kept == {1: 10, 2: None, 3: None}


def test_defaults_only_fill_absent_columns(spark):
    df = spark.createDataFrame([(None,)], "a string")
    row = apply_defaults(df, {"a": F.lit("x"), "b": F.lit(0)}).first()
    assert (row["a"], row["b"]) == (None, 0)
