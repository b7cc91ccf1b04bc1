import pytest

from tablesync.operators.reconcile import (
    count_check,
    count_in_range,
    progress_report,
    progress_totals,
)

COUNTS = "table_name string, total_records bigint"


@pytest.mark.parametrize(
    "src, dest, verdict, allowed",
    [
        (0, 0, "ok", 100), (100, 0, "ok", 100), (101, 0, "short", 100), (0, 101, "over", 100),
        (100_999, 100_899, "ok", 100), (101_000, 100_899, "ok", 101),
        (101_000, 100_898, "short", 101), (1_999_999, 1_998_000, "ok", 1999),
    ],
)
def test_tolerance(spark, src, dest, verdict, allowed):
    row = count_check(
        spark.createDataFrame([("t", src)], COUNTS), spark.createDataFrame([("t", dest)], COUNTS)
    ).first()
    assert (row["verdict"], row["tolerance"]) == (verdict, allowed)


def test_tolerance_is_a_parameter(spark):
    row = count_check(
        spark.createDataFrame([("t", 100)], COUNTS), spark.createDataFrame([("t", 99)], COUNTS),
        floor=0,
    ).first()
    assert row["verdict"] == "short"


def test_a_table_missing_at_the_destination_has_no_rows(spark):
    row = count_check(
        spark.createDataFrame([("t", 500)], COUNTS), spark.createDataFrame([], COUNTS)
    ).first()
    assert (row["dest_rows"], row["verdict"]) == (0, "short")


def test_range_is_taken_from_the_expected_count(spark):
    df = spark.createDataFrame(
        [(1000, 1100), (1000, 1101), (1000, 899), (200_000, 200_200)],
        "expected_rows bigint, actual_rows bigint")
    assert [r["in_range"] for r in count_in_range(df).collect()] == [True, False, False, True]


def test_report_and_totals(spark):
    src = spark.createDataFrame([("a", 10), ("b", 10), ("c", None), ("d", 0)], COUNTS)
    dst = spark.createDataFrame([("a", 10), ("b", 3)], COUNTS)
    report = progress_report(src, dst)
    rows = {r["table_name"]: (r["status"], r["percent"]) for r in report.collect()}
    assert rows == {"a": ("Completed", 100.0), "b": ("In Progress", 30.0),
                    "c": ("Error", 0.0), "d": ("Completed", 0.0)}
    total = progress_totals(report).first()
    assert tuple(total) == (2, 4, 50.0, 13, 20, 65.0)


def test_no_tables_is_zero_percent(spark):
    none = spark.createDataFrame([], COUNTS)
    assert tuple(progress_totals(progress_report(none, none)).first()) == (0, 0, 0.0, 0, 0, 0.0)
