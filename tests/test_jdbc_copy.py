"""The JDBC copy with reads, writes and statements caught before they leave Spark."""

import re
from datetime import datetime
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tablesync.model import TableSpec
from tablesync.operators.ledger import ledger_state
from tablesync.plans.jdbc_copy import Server, copy_all_between, copy_between, migrate_server
from tablesync.session import fresh_path
from tablesync.sources import inventory, jdbc
from tablesync.sources.ledger_store import Ledger

NOW = datetime(2024, 6, 1, 12, 0, 0)
SPEC = TableSpec("shop", "orders", ("id",))
COLUMNS = ["id", "created_at", "name"]


class Servers:
    """Tables by (address, quoted name); queries are answered by Spark itself."""

    def __init__(self, spark):
        self.spark, self.tables, self.types, self.log, self.fail = spark, {}, {}, [], None

    def put(self, url, rows, types="id bigint, created_at string, name string", table="`shop`.`orders`"):
        self.tables[url, table], self.types[table] = list(rows), types

    def frame(self, url, table):
        rows = self.tables[url, table]
        return self.spark.createDataFrame(rows, self.types[table.replace("__copy", "")])

    def answer(self, url, query):
        table = re.search(r"FROM (`.*`)\) t", query)[1]
        self.frame(url, table).createOrReplaceTempView("asked")
        text = query.replace(table, "asked").removesuffix(" t").strip("()")
        text = query[1:query.rindex(")")].replace(f"FROM {table}", "FROM asked").replace("AS CHAR)", "AS STRING)")
        return self.spark.sql(text)

    def read(self, spark, options):
        self.log.append(("read", options))
        return self.answer(options["url"], options["dbtable"])

    def read_ranges(self, spark, url, table, predicates, properties):
        self.log.append(("ranges", predicates))
        if self.fail == "read" and len([k for k, _ in self.log if k == "append"]) >= 2:
            raise RuntimeError("lost the source")
        rows = self.answer(url, table)
        return reduce(DataFrame.unionByName, [rows.filter(p) for p in predicates])

    def write(self, df, options, mode):
        done = [k for k, _ in self.log if k == "append"]
        rows = [tuple(r) for r in df.collect()]
        place = options["url"], options["dbtable"]
        if self.fail == "write" and len(done) >= 2:
            self.tables[place] += rows[1::2]  # some partitions had committed
            raise RuntimeError("lost the destination")
        self.log.append((mode, options))
        self.tables[place] += rows

    def execute(self, spark, url, statements):
        for text in statements:
            self.log.append(("execute", text))
            names = re.findall(r"`[^ ]*`", text)
            if text.startswith("DROP"):
                self.tables.pop((url, names[0]), None)
            elif text.startswith("CREATE"):
                self.tables[url, names[0]] = []
            else:
                self.tables[url, names[1]] = self.tables[url, names[0]]
                self.tables[url, names[0]] = self.tables.pop((url, names[2]))


@pytest.fixture
def servers(spark, monkeypatch):
    made = Servers(spark)
    for name, method in (("read_jdbc", made.read), ("read_jdbc_ranges", made.read_ranges),
                         ("write_jdbc", made.write), ("execute", made.execute)):
        monkeypatch.setattr(jdbc, name, method)
    return made


def copy(spark, mode, spec=SPEC, columns=COLUMNS, **options):
    return copy_between(spark, Server("jdbc:mysql:src", 4), Server("jdbc:mysql:dst", 2), spec, columns,
                        NOW, mode, ("created_at",) if "created_at" in columns else (),
                        rows_per_range=3, **options).first()


def found(servers, table="`shop`.`orders`"):
    return sorted(servers.tables["jdbc:mysql:dst", table])


def test_full_replaces_beside_and_swaps(spark, servers):
    servers.put("jdbc:mysql:src", [(n, "0000-00-00", f"n{n}") for n in range(0, 20, 2)])
    servers.put("jdbc:mysql:dst", [(0, "x", "old"), (2, "x", "old"), (99, "x", "gone")])
    assert copy(spark, "full")["verdict"] == "ok"
    rows = {r[0]: r[1:] for r in found(servers)}
    assert rows[0] == ("2024-06-01 12:00:00", "n0") and rows[99] == ("x", "gone") and len(rows) == 11
    reads = [o for kind, o in servers.log if kind == "read"]
    assert any(o.get("upperBound") == "19" for o in reads)
    assert all(o["useCursorFetch"] == "true" for o in reads)
    assert [len(p) for kind, p in servers.log if kind == "ranges"] == [4, 4]
    assert set(servers.tables) == {("jdbc:mysql:src", "`shop`.`orders`"), ("jdbc:mysql:dst", "`shop`.`orders`")}
    assert not any("truncate" in str(o) and o.get("truncate") == "true" for k, o in servers.log if k == "append")


def test_a_failed_load_leaves_the_live_table(spark, servers, monkeypatch):
    servers.put("jdbc:mysql:src", [(1, "a", "new")])
    servers.put("jdbc:mysql:dst", [(1, "x", "old")])
    monkeypatch.setattr(jdbc, "write_jdbc", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        copy(spark, "full")
    assert found(servers) == [(1, "x", "old")]


def test_an_empty_source_empties_the_destination(spark, servers):
    servers.put("jdbc:mysql:src", [])
    servers.put("jdbc:mysql:dst", [(1, "x", "old")])
    copy(spark, "full")
    assert found(servers) == []


@pytest.mark.parametrize("kind", ["read", "write"])
def test_resume_after_a_failure_in_the_middle(spark, servers, kind):
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    servers.put("jdbc:mysql:src", [(n, "2024-01-01", f"n{n}") for n in range(12)])
    servers.put("jdbc:mysql:dst", [])
    servers.fail = kind
    with pytest.raises(RuntimeError):
        copy(spark, "resume", ledger=ledger)
    half = found(servers)
    assert 6 <= len(half) < 12
    servers.fail = None
    before = len([k for k, _ in servers.log if k == "append"])
    assert copy(spark, "resume", ledger=ledger)["verdict"] == "ok"
    assert [r[0] for r in found(servers)] == list(range(12))
    # The two recorded ranges are not written again.
    assert len([k for k, _ in servers.log if k == "append"]) - before == 2
    assert ledger_state(ledger.events()).first()["is_completed"]


@pytest.mark.parametrize("types,keys,rows", [
    ("a bigint, b string, v int", ("a", "b"), [(n // 3, f"k'{n}", n) for n in range(10)]),
    ("id decimal(20,0), v int", ("id",), [(Decimal(2**63 + n * 7), n) for n in range(10)]),
    ("id string, v int", ("id",), [(f"o'hara {n}", n) for n in range(10)]),
])
def test_composite_unsigned_and_text_keys(spark, servers, types, keys, rows):
    spec, columns = TableSpec("shop", "t", keys), [c.split()[0] for c in types.split(", ")]
    servers.put("jdbc:mysql:src", rows, types, "`shop`.`t`")
    servers.put("jdbc:mysql:dst", rows[2:4], types, "`shop`.`t`")
    assert copy(spark, "resume", spec, columns)["verdict"] == "ok"
    assert found(servers, "`shop`.`t`") == sorted(rows)
    assert len([k for k, _ in servers.log if k == "append"]) == 4
    copy(spark, "full", spec, columns)
    assert found(servers, "`shop`.`t`") == sorted(rows)


def test_unknown_mode(spark, servers):
    with pytest.raises(ValueError):
        copy(spark, "resme")


def test_many_tables_side_by_side(spark, servers):
    for table in ("a", "b", "c"):
        servers.put("jdbc:mysql:src", [(n, "x", table) for n in range(5)], table=f"`shop`.`{table}`")
        servers.put("jdbc:mysql:dst", [], table=f"`shop`.`{table}`")
    del servers.tables["jdbc:mysql:src", "`shop`.`b`"]
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    tables = {TableSpec("shop", t, ("id",)): COLUMNS for t in "abc"}
    ask = lambda: {r["table_name"]: r["status"] for r in copy_all_between(
        spark, Server("jdbc:mysql:src"), Server("jdbc:mysql:dst"), tables, NOW, ledger, workers=1,
        mode="resume").collect()}
    assert ask() == {"shop.a": "ok", "shop.b": "FAILED", "shop.c": "ok"}
    assert ask() == {"shop.a": "SKIPPED", "shop.b": "FAILED", "shop.c": "SKIPPED"}


def test_a_whole_server_from_its_inventory(spark, servers, monkeypatch):
    frames = {
        "tables": [("source", "shop", "orders", "BASE TABLE"), ("source", "shop", "seen", "VIEW"),
                   ("source", "mysql", "user", "BASE TABLE")],
        "columns": [("source", "shop", "orders", n, c, t, "NO", None, "", None, None) for n, (c, t) in enumerate(
            [("id", "bigint"), ("created_at", "datetime"), ("name", "varchar(9)")], start=1)],
        "key_column_usage": [("source", "shop", "orders", "PRIMARY", 1, "id")],
    }
    kinds = {
        "tables": "server string, table_schema string, table_name string, table_type string",
        "columns": "server string, table_schema string, table_name string, ordinal_position int, "
                   "column_name string, column_type string, is_nullable string, column_default string, "
                   "extra string, character_set_name string, collation_name string",
        "key_column_usage": "server string, table_schema string, table_name string, "
                            "constraint_name string, ordinal_position int, column_name string",
    }
    monkeypatch.setattr(inventory, "read_frame",
                        lambda spark, kind, _: spark.createDataFrame(frames[kind], kinds[kind]))
    servers.put("jdbc:mysql:src", [(n, "0000-00-00", "x") for n in range(5)])
    servers.put("jdbc:mysql:dst", [])
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    report = migrate_server(spark, Server("jdbc:mysql:src"), Server("jdbc:mysql:dst"), NOW, ledger)
    assert [(r["table_name"], r["status"]) for r in report.collect()] == [("shop.orders", "ok")]
    assert found(servers)[0] == (0, "2024-06-01 12:00:00", "x")


def test_names_are_quoted():
    assert jdbc.table_name(TableSpec("a`b", "c")) == "`a``b`.`c`"
    assert jdbc.pushed_query("`s`.`t`", ["x`y"]) == "(SELECT `x``y` FROM `s`.`t`) t"
    assert jdbc.literal("it's \\") == "'it''s \\\\'"


def test_texts_are_compared_by_their_bytes(spark):
    """Ranges are planned in byte order; under a server's own order 'a' and 'B' could change places."""
    test = jdbc.key_range(["`k`"], ("B",), ("a",))
    assert test == ("((CAST(`k` AS BINARY) > CAST('B' AS BINARY))) AND "
                    "NOT ((CAST(`k` AS BINARY) > CAST('a' AS BINARY)))")
    df = spark.createDataFrame([("A",), ("B",), ("Z",), ("a",), ("b",), ("é",), (None,)], "k string")
    ranges = jdbc.range_predicates(["k"], [("B",), ("a",), ("é",)])
    assert [sorted(str(r["k"]) for r in df.filter(t).collect()) for t in ranges] == [
        ["A", "B", "None"], ["Z", "a"], ["b", "é"]]
    assert jdbc.key_range(["`k`"], (3,), None) == "((`k` > 3))"


def test_a_resumed_range_is_read_over_several_connections(spark, servers):
    ledger = Ledger(spark, fresh_path(spark, "ledger"), "run")
    servers.put("jdbc:mysql:src", [(n, "x", f"n{n}") for n in range(40)])
    servers.put("jdbc:mysql:dst", [(n, "x", "old") for n in range(0, 40, 4)])
    copy_between(spark, Server("jdbc:mysql:src", 4), Server("jdbc:mysql:dst", 2), SPEC, COLUMNS, NOW,
                 "resume", (), ledger, rows_per_range=16)
    assert [len(p) for kind, p in servers.log if kind == "ranges"] == [4, 4] * 2 + [2, 2]
    assert [r[0] for r in found(servers)] == list(range(40))
    rows = ledger.events().filter("op = 'progress'").orderBy("event_id").collect()
    # Ten were there; of every sixteen twelve are written, of the last eight six.
    assert [r["processed_rows"] for r in rows] == [22, 34, 40]


def test_a_table_with_references_keeps_its_name(spark, servers, monkeypatch):
    servers.put("jdbc:mysql:src", [(n, "x", f"n{n}") for n in range(5)])
    servers.put("jdbc:mysql:dst", [(0, "x", "old"), (9, "x", "gone")])
    said = []
    monkeypatch.setattr(jdbc, "execute", lambda spark, url, statements: (
        said.append(statements), "SET FOREIGN" not in statements[0] and servers.execute(spark, url, statements)))
    copy(spark, "full", referenced=True)
    assert not any("RENAME" in text for statements in said for text in statements)
    assert said[-1] == [
        "SET FOREIGN_KEY_CHECKS = 0", "START TRANSACTION", "DELETE FROM `shop`.`orders`",
        "INSERT INTO `shop`.`orders` (`id`, `created_at`, `name`) "
        "SELECT `id`, `created_at`, `name` FROM `shop`.`orders__copy`",
        "COMMIT", "SET FOREIGN_KEY_CHECKS = 1", "DROP TABLE `shop`.`orders__copy`"]
    beside = sorted(r[0] for r in servers.tables["jdbc:mysql:dst", "`shop`.`orders__copy`"])
    assert beside == [0, 1, 2, 3, 4, 9]


def test_a_question_is_asked_again(spark, servers, monkeypatch):
    servers.put("jdbc:mysql:src", [(1, "x", "y")])
    left = [2]

    def shaky(spark, options):
        if left[0]:
            left[0] -= 1
            raise RuntimeError("connection lost")
        return servers.read(spark, options)

    monkeypatch.setattr(jdbc, "read_jdbc", shaky)
    assert Server("jdbc:mysql:src", wait=0.01).count(spark, SPEC) == 1
    left[0] = 3
    with pytest.raises(RuntimeError):
        Server("jdbc:mysql:src", wait=0.01).count(spark, SPEC)


def test_keys_that_break_the_rules_are_copied_once(spark, servers):
    spec, columns, types = TableSpec("shop", "t", ("k",)), ["k", "v"], "k timestamp_ntz, v int"
    old = [(datetime(500, 1, 1), 1), (datetime(2020, 1, 1), 2)]
    servers.put("jdbc:mysql:src", old, types, "`shop`.`t`")
    servers.put("jdbc:mysql:dst", [], types, "`shop`.`t`")
    copy(spark, "resume", spec, columns)
    servers.put("jdbc:mysql:src", [*old, (datetime(2021, 1, 1), 3)], types, "`shop`.`t`")
    for mode in ("resume", "full", "full"):
        copy(spark, mode, spec, columns)
        assert [r[1] for r in found(servers, "`shop`.`t`")] == [1, 2, 3]
