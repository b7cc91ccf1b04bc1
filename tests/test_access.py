from pyspark.sql import functions as F

from tablesync.operators import access as U

GRANT = ("SELECT", "CREATE VIEW")


def wide(spark, flags, rows, scope=""):
    """Rows of (user, host, set of flags that are Y), all other flags N."""
    names = ", ".join(f"{f} string" for f in flags)
    scope_type = f"{scope} string, " if scope else ""
    data = [
        ("s", user, host, *(["d`b"] if scope else []), *["Y" if f in on else "N" for f in flags])
        for user, host, on in rows
    ]
    return spark.createDataFrame(data, f"server string, user string, host string, {scope_type}{names}")


def test_names_of_all_flags():
    names = [U.privilege_name(f) for f in U.granted_flags(U.GLOBAL_FLAGS)]
    assert len(U.GLOBAL_FLAGS) == 28 and len(names) == 24 and len(set(names)) == 24
    assert len(U.DATABASE_FLAGS) == 19 and len(U.granted_flags(U.DATABASE_FLAGS)) == 17
    assert {"SHOW DATABASES", "CREATE TEMPORARY TABLES", "REPLICATION SLAVE", "LOCK TABLES",
            "CREATE USER", "ALTER ROUTINE"} <= set(names)
    assert not {"GRANT", "SUPER", "SHUTDOWN", "REFERENCES"} & set(names)


def test_flags_to_statements(spark):
    grants = wide(spark, U.GLOBAL_FLAGS, [
        ("ann", "%", {"Select_priv", "Create_view_priv", "Grant_priv"}),
        ("bob", "localhost", {"Trigger_priv"}),
        ("only", "%", {"Grant_priv"}), ("super", "%", {"Super_priv", "Shutdown_priv"}),
        ("root", "%", {"Select_priv"}), ("", "%", {"Select_priv"}),
        ("mysql.sys", "%", {"Select_priv"}), ("o'neil", "%", {"Drop_priv"}),
    ])
    listed = U.global_privileges(grants)
    assert {r["user"]: r["privileges"] for r in listed.collect()}["ann"] == ["SELECT", "CREATE VIEW"]
    texts = {r["user"]: r["statement"] for r in U.grant_statements(listed).collect()}
    assert texts == {
        "ann": "GRANT SELECT, CREATE VIEW ON *.* TO 'ann'@'%' WITH GRANT OPTION",
        "bob": "GRANT TRIGGER ON *.* TO 'bob'@'localhost'",
        "o'neil": "GRANT DROP ON *.* TO 'o''neil'@'%'",
    }
    assert U.long_privileges(listed).count() == 4


def test_database_and_table_levels(spark):
    db = wide(spark, U.DATABASE_FLAGS, [("ann", "%", {"Event_priv", "References_priv"})], "db")
    text = U.grant_statements(U.database_privileges(db)).first()["statement"]
    assert text == "GRANT EVENT ON `d``b`.* TO 'ann'@'%'"
    sets = spark.createDataFrame(
        [("s", "ann", "%", "d", "t", " select ,\tInsert\n,Grant,CREATE VIEW", "Select"),
         ("s", "bob", "%", "d", "t", "", "Select"), ("s", "cid", "%", "d", "t", "Grant", "")],
        "server string, user string, host string, db string, table_name string, "
        "table_priv string, column_priv string")
    rows = U.grant_statements(U.table_privileges(sets)).collect()
    assert [r["statement"] for r in rows] == ["GRANT SELECT, INSERT ON `d`.`t` TO 'ann'@'%'"]


def test_accounts(spark):
    accounts = spark.createDataFrame(
        [("s", "ann", "%", "sha256_password", "ANY", None, 3), ("s", "root", "%", None, "", 0, 0),
         ("s", "mysql.backup", "%", "x", None, None, None), ("s", "", "%", None, None, 1, None),
         ("s", "ann", "localhost", None, None, 1, None), ("s", "mysql.sys", "%", "", "", 1, 1)],
        "server string, user string, host string, plugin string, ssl_type string, "
        "max_questions bigint, max_updates bigint",
    ).withColumns({c: F.lit(None).cast("bigint") for c in ("max_connections", "max_user_connections")})
    status = {(r["user"], r["host"]): r["status"] for r in U.portable_accounts(accounts).collect()}
    assert status == {("ann", "%"): "selected", ("root", "%"): "skipped",
                      ("mysql.backup", "%"): "skipped"}
    plugins = [r["dest_plugin"] for r in U.auth_plugin(accounts).collect()]
    assert plugins == ["sha256_password"] + ["mysql_native_password"] * 5
    limits = U.account_limits(accounts).collect()
    assert [(r["max_questions"], r["max_updates"], r["has_limits"], r["require_tls"])
            for r in limits[:2]] == [(0, 3, True, True), (0, 0, False, False)]


def test_summary_counts_rows_that_grant_nothing(spark):
    accounts = spark.createDataFrame(
        [("s", "ann", "%"), ("s", "root", "%"), ("s", "bob", "localhost")],
        "server string, user string, host string")
    none = wide(spark, U.DATABASE_FLAGS, [("ann", "%", set())], "db")
    grants = wide(spark, U.GLOBAL_FLAGS, [("ann", "%", {"Select_priv"}), ("bob", "localhost", {"File_priv"})])
    sets = spark.createDataFrame(
        [("s", "gone", "%", "d", "t", "Select", "")],
        "server string, user string, host string, db string, table_name string, "
        "table_priv string, column_priv string")
    assert tuple(U.access_summary(accounts, grants, none, sets).first()) == (2, 1, 1, 4, 2, 2)
    dangling = U.dangling_grants(U.all_statements(grants, none, sets), accounts)
    assert {r["user"] for r in dangling.collect()} == {"bob", "gone"}
