from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.model import TableSpec
from tablesync.operators.ledger import ledger_state, ledger_summary
from tablesync.plans import commands
from tablesync.plans.copy import copy_table, copy_tables
from tablesync.plans.structure import ensure_tables
from tablesync.session import fresh_path, scratch_space
from tablesync.sources.ledger_store import Ledger
from tablesync.sources.versions import current_folders, open_table, remove_unused, table_path

NOW = datetime(2024, 6, 1, 12, 0, 0)
SPEC = TableSpec("shop", "orders", ("id",))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def source(spark):
    return spark.range(0, 100, 2).select(
        "id", F.concat(F.lit("n"), "id").alias("name"),
        F.when(F.col("id") % 10 == 0, "0000-00-00").otherwise("2024-01-01").alias("created_at"),
    )


@pytest.fixture
def clean(source):
    return rows_of(source.withColumn(
        "created_at", F.when(F.col("id") % 10 == 0, "2024-06-01 12:00:00")
        .otherwise("2024-01-01")))


def written(df, label="dest"):
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return (path,)


def test_copy_twice_is_copy_once(source, clean):
    first = copy_table(source, SPEC, NOW)
    second = copy_table(source, SPEC, NOW, first.locations, mode="full")
    third = copy_table(source, SPEC, NOW, second.locations, mode="resume")
    for result in (first, second, third):
        assert rows_of(result.destination) == clean
        assert result.verdict.first()["verdict"] == "ok"
        assert result.rows == 50


def test_full_repairs_holes_and_stale_rows(source, clean):
    stale = source.filter("id % 6 <> 0").withColumn("name", F.lit("old"))
    where = written(stale)
    assert rows_of(copy_table(source, SPEC, NOW, where, mode="full").destination) == clean


def test_resume_goes_on_after_the_last_key(source, clean):
    head = copy_table(source.filter("id < 60"), SPEC, NOW)
    result = copy_table(source, SPEC, NOW, head.locations, mode="resume")
    assert rows_of(result.destination) == clean
    assert len(result.locations) == 2
    # The destination's largest key is above its row count, and so is the source's.
    again = copy_table(source, SPEC, NOW, result.locations, mode="resume")
    assert rows_of(again.destination) == clean


def test_resume_leaves_holes_and_says_short(spark):
    source = spark.range(5000)
    holes = written(source.filter("id % 10 <> 0 AND id < 4000"))
    result = copy_table(source, SPEC, NOW, holes, mode="resume")
    assert result.rows == 4600
    assert result.verdict.first()["verdict"] == "short"


def test_destination_with_only_key_zero_is_kept(source):
    zero = written(source.filter("id = 0").withColumn("name", F.lit("kept")))
    result = copy_table(source, SPEC, NOW, zero, mode="resume")
    assert result.destination.filter("id = 0").first()["name"] == "kept"
    assert result.rows == 50


def test_empty_source_empties_the_destination(source):
    where = written(source)
    for mode in ("full", "resume"):
        result = copy_table(source.filter("id < 0"), SPEC, NOW, where, mode=mode)
        assert result.rows == 0
        assert result.destination.columns == source.columns


def test_a_table_without_keys_is_loaded_whole(source, clean):
    where = written(source.limit(3))
    result = copy_table(source, TableSpec("shop", "log"), NOW, where, mode="resume")
    assert rows_of(result.destination) == clean


def test_a_failed_copy_is_recorded_and_can_be_repeated(spark, source, clean):
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    half = copy_table(source.filter("id < 50"), SPEC, NOW)
    bad = source.withColumn("name", F.when(F.col("id") == 90, F.raise_error(F.lit("lost")))
                            .otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        copy_table(bad, SPEC, NOW, half.locations, mode="resume", ledger=ledger)
    state = ledger_state(ledger.events()).first()
    assert "lost" in state["error_message"] and not state["is_completed"]
    assert state["retry_count"] == 0

    result = copy_table(source, SPEC, NOW, half.locations, mode="resume", ledger=ledger)
    assert rows_of(result.destination) == clean
    state = ledger_state(ledger.events()).first()
    assert state["is_completed"] and state["error_message"] is None
    assert (state["retry_count"], state["last_id"], state["processed_rows"]) == (1, 98, 50)


def test_a_completed_table_is_skipped_within_its_run_only(spark, source):
    path = fresh_path(spark, "ledger")
    first = copy_table(source, SPEC, NOW, ledger=Ledger(spark, path, "one"))
    grown = source.unionByName(source.withColumn("id", F.col("id") + 1000))
    same = copy_table(grown, SPEC, NOW, first.locations, ledger=Ledger(spark, path, "one"))
    assert same.skipped and same.rows == 50 and same.locations == first.locations
    fresh = copy_table(grown, SPEC, NOW, first.locations, ledger=Ledger(spark, path, "two"))
    assert not fresh.skipped and fresh.rows == 100


def test_unknown_mode(source):
    with pytest.raises(ValueError):
        copy_table(source, SPEC, NOW, mode="merge")


def test_one_failing_table_does_not_stop_the_others(spark, source, clean):
    bad = source.withColumn("name", F.raise_error(F.lit("unreadable")).cast("string"))
    specs = [TableSpec("shop", n, ("id",)) for n in ("a", "b", "c")]
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    report, results = copy_tables(
        spark, dict(zip(specs, (source, bad, source))), NOW, workers=2, ledger=ledger
    )
    rows = {r["table_name"]: r for r in report.collect()}
    assert [rows[n]["status"] for n in "abc"] == ["COMPLETED", "FAILED", "COMPLETED"]
    assert [rows[n]["rows"] for n in "abc"] == [50, None, 50]
    assert [rows[n]["index"] for n in "abc"] == [1, 2, 3]
    assert "unreadable" in rows["b"]["error"]
    assert set(results) == {specs[0], specs[2]}
    summary = ledger_summary(ledger.events()).first()
    assert (summary["total_tables"], summary["completed_tables"], summary["error_count"]) == (3, 2, 1)
    again, _ = copy_tables(spark, {s: source for s in specs}, NOW, ledger=ledger)
    assert sorted(r["status"] for r in again.collect()) == ["COMPLETED", "SKIPPED", "SKIPPED"]


def test_creating_tables_again_changes_nothing(spark, source):
    root = fresh_path(spark, "root")
    sources = {TableSpec("s", "x"): source, TableSpec("t", "y"): source.select("id")}
    first = ensure_tables(spark, sources, root).collect()
    assert sorted(map(tuple, first)) == [("s", "x", 3, True), ("t", "y", 1, True)]
    second = ensure_tables(spark, sources, root).collect()
    assert not any(r["created"] for r in second)
    assert open_table(spark, root, TableSpec("s", "x")).schema.names == source.columns


def test_commands_from_structure_to_progress(spark, source, clean):
    sources = {TableSpec("shop", "a", ("id",)): source,
               TableSpec("shop", "b", ("id",)): source.select("id"),
               TableSpec("blog", "c", ("id",)): source}
    root = fresh_path(spark, "root")
    report, results = commands.full(spark, sources, root, NOW, target="shop")
    assert {r["table_name"] for r in report.collect()} == {"a", "b"}
    assert rows_of(results[TableSpec("shop", "a", ("id",))].destination) == clean
    done = {s: r.destination for s, r in results.items()}
    table, totals = commands.progress(sources, done)
    status = {r["table_name"]: r["status"] for r in table.collect()}
    assert status == {"shop.a": "Completed", "shop.b": "Completed", "blog.c": "In Progress"}
    row = totals.first()
    assert (row["completed_tables"], row["total_tables"], row["tables_percent"]) == (2, 3, 66.7)
    one, _ = commands.migrate(spark, sources, NOW, target="blog.c")
    assert [r["table_name"] for r in one.collect()] == ["c"]
    for target, error in (("a.b.c", ValueError), ("shop.zz", LookupError), ("none", LookupError)):
        with pytest.raises(error):
            commands.migrate(spark, sources, NOW, target=target)


def test_a_named_destination_is_filled_and_pointed_to(spark, source, clean):
    root = fresh_path(spark, "root")
    first = copy_table(source.filter("id < 60"), SPEC, NOW, root=root)
    assert all(f.startswith(f"{root}/shop/orders/") for f in first.locations)
    second = copy_table(source, SPEC, NOW, mode="resume", root=root)
    assert rows_of(open_table(spark, root, SPEC)) == clean
    assert second.locations[:1] == first.locations and len(second.locations) == 2
    third = copy_table(source.withColumn("name", F.lit("new")), SPEC, NOW, root=root)
    assert {r["name"] for r in open_table(spark, root, SPEC).collect()} == {"new"}
    path = table_path(root, SPEC)
    assert set(remove_unused(spark, path, second.locations)) == set(second.locations)
    assert remove_unused(spark, path, third.locations) == []
    assert open_table(spark, root, SPEC).count() == 50
    with pytest.raises(LookupError):
        open_table(spark, root, TableSpec("shop", "none"))


def test_scratch_is_removed(spark, source):
    with scratch_space(spark):
        path = fresh_path(spark, "scratch")
        source.write.parquet(path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


@pytest.mark.parametrize("mode", ["full", "resume"])
def test_only_the_missing_ranges_are_written_after_a_failure(spark, source, clean, mode):
    root, ledger = fresh_path(spark, "root"), Ledger(spark, fresh_path(spark, "ledger"), "run")
    if mode == "full":  # stale rows, one between the source's keys and one beyond them
        stale = source.filter("id % 6 = 0").unionByName(
            spark.createDataFrame([(33, "own", "x"), (500, "own", "x")], source.schema))
        clean = sorted([*clean, (33, "own", "x"), (500, "own", "x")])
        copy_table(stale, SPEC, NOW, root=root)
    bad = source.withColumn("name", F.when(F.col("id") == 70, F.raise_error(F.lit("lost")))
                            .otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        copy_table(bad, SPEC, NOW, mode=mode, ledger=ledger, root=root, rows_per_range=10)
    events = ledger.events().filter("op = 'progress'").orderBy("event_id").collect()
    assert len(events) == 3 and events[-1]["last_id"] == 58
    before = current_folders(spark, table_path(root, SPEC))
    assert len(before) == (1 if mode == "full" else 0)  # the old state, or none

    result = copy_table(source, SPEC, NOW, mode=mode, ledger=ledger, root=root, rows_per_range=10)
    assert rows_of(open_table(spark, root, SPEC)) == clean
    assert rows_of(result.destination) == clean
    kept = [e["message"] for e in events]
    assert list(result.locations)[:3] == kept and len(result.locations) == 5
    assert copy_table(source, SPEC, NOW, mode=mode, ledger=ledger, root=root).skipped


def test_ranges_of_a_composite_key_and_rows_without_one(spark):
    rows = [(n // 4, f"k{n % 4}", n) for n in range(20)] + [(None, "x", 99)]
    df = spark.createDataFrame(rows, "a int, b string, v int")
    result = copy_table(df, TableSpec("s", "t", ("a", "b")), NOW, root=fresh_path(spark, "r"),
                        rows_per_range=6)
    assert sorted(r["v"] for r in result.destination.collect()) == [*range(20), 99]
    assert len(result.locations) == 4


def test_bytes_and_wide_keys_come_through(spark):
    df = spark.range(300).select(
        (F.col("id").cast("decimal(20,0)") + F.lit(2**62).cast("decimal(20,0)")).cast("decimal(20,0)").alias("id"),
        F.unhex(F.sha2(F.col("id").cast("string"), 512)).alias("blob"))
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    result = copy_table(df, SPEC, NOW, ledger=ledger, root=fresh_path(spark, "root"))
    assert result.destination.schema["blob"].dataType.simpleString() == "binary"
    assert rows_of(result.destination) == rows_of(df)
    assert ledger_state(ledger.events()).first()["last_id"] == 2**62 + 299


def test_a_live_source_is_counted_after_the_copy(spark, source, monkeypatch):
    """The source grows while it is copied; the verdict compares with what it holds then."""
    path = fresh_path(spark, "live")
    spark.range(5000).write.parquet(path)
    seen = []

    class Growing:
        sparkSession = spark

        def __getattr__(self, name):
            if name == "count":
                seen.append(name)
                if len(seen) == 2:
                    spark.range(5000, 9000).write.mode("append").parquet(path)
            return getattr(spark.read.parquet(path), name)

    frame = Growing()
    monkeypatch.setattr("tablesync.plans.copy.sanitize_rows", lambda df, ts: spark.read.parquet(path))
    assert copy_table(frame, TableSpec("s", "t"), NOW).verdict.first()["verdict"] == "short"


def test_a_table_that_cannot_be_read_is_an_error(spark, source):
    good, bad = TableSpec("s", "good"), TableSpec("s", "bad")
    lost = source.withColumn("id", F.raise_error(F.lit("gone")).cast("bigint")).filter("id > 0")
    report, totals = commands.progress({good: source, bad: lost}, {good: source, bad: source})
    assert {r["table_name"]: r["status"] for r in report.collect()} == {
        "s.good": "Completed", "s.bad": "Error"}
    assert totals.first()["total_tables"] == 2


def test_full_fills_the_root(spark, source, clean):
    root = fresh_path(spark, "root")
    sources = {TableSpec("shop", "a", ("id",)): source}
    commands.full(spark, sources, root, NOW)
    assert rows_of(open_table(spark, root, TableSpec("shop", "a"))) == clean


def test_a_run_that_goes_on_counts_again(spark, source):
    sources = {TableSpec("shop", "a", ("id",)): source}
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    commands.migrate(spark, sources, NOW, ledger=ledger, root=fresh_path(spark, "root"))
    grown = {s: df.unionByName(df.withColumn("id", F.col("id") + 1000)) for s, df in sources.items()}
    report, _ = commands.migrate(spark, grown, NOW, ledger=ledger)
    assert [r["status"] for r in report.collect()] == ["SKIPPED"]
    assert ledger_state(ledger.events()).filter("table_key = 'shop.a'").first()["total_rows"] == 100
