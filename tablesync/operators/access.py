"""Accounts and privileges as data: what would be carried over, and what would not.

Nothing here creates accounts or grants; the statements are text for audit.
Password hashes are never read, only whether there is one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.skew import join_on_key_set
from tablesync.session import stage

# Accounts of the server itself, hosts that are not portable, known plugins.
INTERNAL_USERS = ("mysql.sys", "mysql.session", "mysql.infoschema")
LOCAL_HOSTS = ("localhost",)
KNOWN_PLUGINS = ("mysql_native_password", "caching_sha2_password", "sha256_password")
DEFAULT_PLUGIN = "mysql_native_password"
LIMITS = ("max_questions", "max_updates", "max_connections", "max_user_connections")

# Privilege flag columns in the servers' own order.
GLOBAL_FLAGS = (
    "Select_priv", "Insert_priv", "Update_priv", "Delete_priv", "Create_priv", "Drop_priv",
    "Reload_priv", "Shutdown_priv", "Process_priv", "File_priv", "Grant_priv", "References_priv",
    "Index_priv", "Alter_priv", "Show_db_priv", "Super_priv", "Create_tmp_table_priv",
    "Lock_tables_priv", "Execute_priv", "Repl_slave_priv", "Repl_client_priv",
    "Create_view_priv", "Show_view_priv", "Create_routine_priv", "Alter_routine_priv",
    "Create_user_priv", "Event_priv", "Trigger_priv",
)
DATABASE_FLAGS = (
    "Select_priv", "Insert_priv", "Update_priv", "Delete_priv", "Create_priv", "Drop_priv",
    "Grant_priv", "References_priv", "Index_priv", "Alter_priv", "Create_tmp_table_priv",
    "Lock_tables_priv", "Create_view_priv", "Show_view_priv", "Create_routine_priv",
    "Alter_routine_priv", "Execute_priv", "Event_priv", "Trigger_priv",
)
# Flags that are read but never granted, and names that differ from the flag's.
NOT_GRANTED = ("Grant_priv", "Shutdown_priv", "References_priv", "Super_priv")
PRIVILEGE_NAMES = {
    "Show_db_priv": "SHOW DATABASES",
    "Create_tmp_table_priv": "CREATE TEMPORARY TABLES",
    "Repl_slave_priv": "REPLICATION SLAVE",
    "Repl_client_priv": "REPLICATION CLIENT",
}
TABLE_PRIVILEGES = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "INDEX", "ALTER")

ACCOUNT = ["server", "user", "host"]


def privilege_name(flag: str) -> str:
    """``Create_view_priv`` → ``CREATE VIEW``."""
    return PRIVILEGE_NAMES.get(flag, flag.removesuffix("_priv").replace("_", " ").upper())


def granted_flags(flags: tuple[str, ...]) -> list[str]:
    return [flag for flag in flags if flag not in NOT_GRANTED]


def portable_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts to carry over (``selected``) and those left out at the end (``skipped``)."""
    return accounts.filter(
        (F.col("user") != "")
        & ~F.col("user").isin(*INTERNAL_USERS)
        & ~F.col("host").isin(*LOCAL_HOSTS)
    ).withColumn(
        "status",
        F.when(
            (F.col("user") == "root") | F.col("user").startswith("mysql."), "skipped"
        ).otherwise("selected"),
    )


def auth_plugin(accounts: DataFrame) -> DataFrame:
    """The plugin an account gets: its own if known, else the default."""
    known = F.col("plugin").isin(*KNOWN_PLUGINS)
    return accounts.withColumn(
        "dest_plugin", F.when(known, F.col("plugin")).otherwise(DEFAULT_PLUGIN)
    )


def account_limits(accounts: DataFrame) -> DataFrame:
    """Resource limits with NULL as 0, whether any is set, and whether TLS is required."""
    limits = {c: F.coalesce(F.col(c), F.lit(0)) for c in LIMITS}
    return accounts.withColumns(limits).withColumns(
        {
            "has_limits": F.greatest(*LIMITS) > 0,
            "require_tls": F.coalesce(F.col("ssl_type") != "", F.lit(False)),
        }
    )


def _grantees(grants: DataFrame) -> DataFrame:
    return grants.filter((F.col("user") != "") & ~F.col("user").isin(*INTERNAL_USERS, "root"))


def _from_flags(grants: DataFrame, flags: tuple[str, ...], scope: list[str]) -> DataFrame:
    granted = granted_flags(flags)
    # One list of names beside one of flags, so the plan does not grow with the flags.
    names = F.array(*[F.lit(privilege_name(f)) for f in granted])
    given = F.zip_with(names, F.array(*[F.col(f) for f in granted]), lambda n, f: F.when(f == "Y", n))
    listed = F.array(F.filter(given, lambda name: name.isNotNull()))
    # Exploding the one list, or nothing, names every flag once; a filter would name it again.
    return _grantees(grants).select(
        *ACCOUNT,
        *scope,
        F.explode(F.filter(listed, lambda some: F.size(some) > 0)).alias("privileges"),
        (F.col("Grant_priv") == "Y").alias("with_grant_option"),
    )


def global_privileges(grants: DataFrame) -> DataFrame:
    """Server-wide privileges as a list per account; none, no row."""
    return _from_flags(grants, GLOBAL_FLAGS, [])


def database_privileges(grants: DataFrame) -> DataFrame:
    """Privileges on one database as a list per account."""
    return _from_flags(grants, DATABASE_FLAGS, ["db"])


def table_privileges(grants: DataFrame) -> DataFrame:
    """Privileges on one table from their comma-separated text."""
    blanks = F.lit(" \t\n\r\v\f")
    names = F.transform(F.split("table_priv", ","), lambda name: F.upper(F.btrim(name, blanks)))
    return (
        _grantees(grants)
        .select(
            *ACCOUNT,
            "db",
            "table_name",
            F.filter(names, lambda name: name.isin(*TABLE_PRIVILEGES)).alias("privileges"),
            F.lit(False).alias("with_grant_option"),
        )
        .filter(F.size("privileges") > 0)
    )


def long_privileges(listed: DataFrame) -> DataFrame:
    """One row per privilege of a list."""
    scope = [c for c in listed.columns if c != "privileges"]
    return listed.select(*scope, F.explode("privileges").alias("privilege"))


def _quoted(value: Column, quote: str) -> Column:
    return F.concat(F.lit(quote), F.replace(value, F.lit(quote), F.lit(quote * 2)), F.lit(quote))


def grant_statements(listed: DataFrame) -> DataFrame:
    """The GRANT statement of each privilege list, as text with quotes escaped."""
    if "table_name" in listed.columns:
        target = F.concat(_quoted(F.col("db"), "`"), F.lit("."), _quoted(F.col("table_name"), "`"))
    elif "db" in listed.columns:
        target = F.concat(_quoted(F.col("db"), "`"), F.lit(".*"))
    else:
        target = F.lit("*.*")
    option = F.when(F.col("with_grant_option"), " WITH GRANT OPTION").otherwise("")
    account = F.concat(_quoted(F.col("user"), "'"), F.lit("@"), _quoted(F.col("host"), "'"))
    text = F.concat(
        F.lit("GRANT "), F.concat_ws(", ", "privileges"), F.lit(" ON "), target,
        F.lit(" TO "), account, option,
    )
    return listed.select(*ACCOUNT, text.alias("statement"))


def all_statements(global_grants: DataFrame, db_grants: DataFrame, set_grants: DataFrame) -> DataFrame:
    """Statements of all three levels with their level."""
    levels = _levels(global_grants, db_grants, set_grants)
    parts = [
        grant_statements(listed).withColumn("level", F.lit(level))
        for level, listed in levels.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _levels(
    global_grants: DataFrame, db_grants: DataFrame, set_grants: DataFrame
) -> dict[str, DataFrame]:
    return {
        "global": global_privileges(global_grants),
        "database": database_privileges(db_grants),
        "table": table_privileges(set_grants),
    }


def _carried(accounts: DataFrame) -> DataFrame:
    return portable_accounts(accounts).filter("status = 'selected'").select(*ACCOUNT).distinct()


def dangling_grants(statements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Statements, or any rows with an account, for accounts that are not carried over."""
    return join_on_key_set(statements, _carried(accounts), ACCOUNT, "left_anti")


def dangling_statements(
    accounts: DataFrame, global_grants: DataFrame, db_grants: DataFrame, set_grants: DataFrame
) -> DataFrame:
    """The statements of all levels whose account is not carried over.

    Privilege rows of other accounts are dropped before any list or text is built.
    """
    carried = stage(_carried(accounts), "carried")
    rows = [join_on_key_set(g, carried, ACCOUNT, "left_anti", write_out=False)
            for g in (global_grants, db_grants, set_grants)]
    return all_statements(*rows)


def access_summary(
    accounts: DataFrame, global_grants: DataFrame, db_grants: DataFrame, set_grants: DataFrame
) -> DataFrame:
    """Accounts and privilege rows: total, carried over, skipped, failing.

    A privilege row fails when its statement names an account that is not
    carried over; a row that grants nothing counts as done.
    """
    users = portable_accounts(accounts).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col("status") == "selected").alias("migrated_users"),
        F.count_if(F.col("status") == "skipped").alias("skipped_users"),
    )
    rows = reduce(
        DataFrame.unionByName,
        [_grantees(g).select("user") for g in (global_grants, db_grants, set_grants)],
    ).agg(F.count(F.lit(1)).alias("total_privileges"))
    listed = reduce(
        DataFrame.unionByName,
        [rows.select(*ACCOUNT) for rows in _levels(global_grants, db_grants, set_grants).values()],
    )
    failing = dangling_grants(listed, accounts).agg(F.count(F.lit(1)).alias("error_privileges"))
    parts = users
    for part in (rows, failing):
        parts = parts.unionByName(part, allowMissingColumns=True)
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns]).select(
        "total_users",
        "migrated_users",
        "skipped_users",
        "total_privileges",
        (F.col("total_privileges") - F.col("error_privileges")).alias("migrated_privileges"),
        "error_privileges",
    )
