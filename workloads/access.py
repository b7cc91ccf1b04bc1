"""Account and privilege queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import access as U
from workloads.registry import query

INTERNAL = "('mysql.sys', 'mysql.session', 'mysql.infoschema')"

ACCOUNTS_SQL = f"""
SELECT *, CASE WHEN user = 'root' OR starts_with(user, 'mysql.') THEN 'skipped'
               ELSE 'selected' END AS status
FROM {{accounts}}
WHERE user <> '' AND user NOT IN {INTERNAL} AND host <> 'localhost'"""

# The privileges each level can grant, in order, by their flag.
GLOBAL = {
    "Select": "SELECT", "Insert": "INSERT", "Update": "UPDATE", "Delete": "DELETE",
    "Create": "CREATE", "Drop": "DROP", "Reload": "RELOAD", "Process": "PROCESS", "File": "FILE",
    "Index": "INDEX", "Alter": "ALTER", "Show_db": "SHOW DATABASES",
    "Create_tmp_table": "CREATE TEMPORARY TABLES", "Lock_tables": "LOCK TABLES",
    "Execute": "EXECUTE", "Repl_slave": "REPLICATION SLAVE", "Repl_client": "REPLICATION CLIENT",
    "Create_view": "CREATE VIEW", "Show_view": "SHOW VIEW", "Create_routine": "CREATE ROUTINE",
    "Alter_routine": "ALTER ROUTINE", "Create_user": "CREATE USER", "Event": "EVENT",
    "Trigger": "TRIGGER",
}
DATABASE = (
    "Select", "Insert", "Update", "Delete", "Create", "Drop", "Index", "Alter",
    "Create_tmp_table", "Lock_tables", "Create_view", "Show_view", "Create_routine",
    "Alter_routine", "Execute", "Event", "Trigger",
)


def listed_sql(grants: str, flags, scope: str) -> str:
    parts = ", ".join(f"CASE WHEN {f}_priv = 'Y' THEN '{GLOBAL[f]}' END" for f in flags)
    return f"""
SELECT * FROM (
  SELECT server, user, host, {scope} concat_ws(', ', {parts}) AS privileges,
         Grant_priv = 'Y' AS with_grant_option
  FROM {{{grants}}} WHERE user <> '' AND user NOT IN {INTERNAL} AND user <> 'root')
WHERE privileges <> ''"""


GLOBAL_SQL = listed_sql("grants_global", GLOBAL, "")
DATABASE_SQL = listed_sql("grants_db", DATABASE, "db,")
TABLE_SQL = f"""
SELECT server, user, host, db, table_name,
       array_to_string(names, ', ') AS privileges, false AS with_grant_option
FROM (SELECT *, list_filter(
        list_transform(string_split(table_priv, ','), lambda x: upper(trim(x))),
        lambda x: x IN ('SELECT', 'INSERT', 'UPDATE', 'DELETE', 'CREATE', 'DROP', 'INDEX', 'ALTER')
      ) AS names
      FROM {{grants_set}} WHERE user <> '' AND user NOT IN {INTERNAL} AND user <> 'root')
WHERE len(names) > 0"""

ACCOUNT_TEXT = "'''' || replace(user, '''', '''''') || '''@''' || host || ''''"
STATEMENTS_SQL = f"""
SELECT 'global' AS level, server, user, host,
       'GRANT ' || privileges || ' ON *.* TO ' || {ACCOUNT_TEXT}
         || CASE WHEN with_grant_option THEN ' WITH GRANT OPTION' ELSE '' END AS statement
FROM ({GLOBAL_SQL})
UNION ALL
SELECT 'database', server, user, host,
       'GRANT ' || privileges || ' ON `' || replace(db, '`', '``') || '`.* TO ' || {ACCOUNT_TEXT}
         || CASE WHEN with_grant_option THEN ' WITH GRANT OPTION' ELSE '' END
FROM ({DATABASE_SQL})
UNION ALL
SELECT 'table', server, user, host,
       'GRANT ' || privileges || ' ON `' || db || '`.`' || table_name || '` TO ' || {ACCOUNT_TEXT}
FROM ({TABLE_SQL})"""
DANGLING_SQL = f"""
SELECT * FROM ({STATEMENTS_SQL}) g
WHERE NOT EXISTS (SELECT 1 FROM ({ACCOUNTS_SQL}) a WHERE a.status = 'selected'
                  AND a.server = g.server AND a.user = g.user AND a.host = g.host)"""


def shown(listed):
    return listed.withColumn("privileges", F.concat_ws(", ", "privileges"))


@query("portable_accounts", ACCOUNTS_SQL)
def portable_accounts(i):
    return U.portable_accounts(i["accounts"])


@query("auth_plugin", """
SELECT server, user, host, plugin,
       CASE plugin WHEN 'caching_sha2_password' THEN plugin WHEN 'sha256_password' THEN plugin
                   ELSE 'mysql_native_password' END AS dest_plugin
FROM {accounts}""")
def auth_plugin(i):
    return U.auth_plugin(i["accounts"]).select("server", "user", "host", "plugin", "dest_plugin")


@query("account_limits", """
SELECT server, user, host, coalesce(max_questions, 0) AS max_questions,
       coalesce(max_updates, 0) AS max_updates, coalesce(max_connections, 0) AS max_connections,
       coalesce(max_user_connections, 0) AS max_user_connections,
       coalesce(max_questions, 0) > 0 OR coalesce(max_updates, 0) > 0
         OR coalesce(max_connections, 0) > 0 OR coalesce(max_user_connections, 0) > 0
         AS has_limits,
       coalesce(ssl_type, '') <> '' AS require_tls
FROM {accounts}""")
def account_limits(i):
    return U.account_limits(i["accounts"]).select(
        "server", "user", "host", *U.LIMITS, "has_limits", "require_tls"
    )


@query("global_privileges", GLOBAL_SQL)
def global_privileges(i):
    return shown(U.global_privileges(i["grants_global"]))


@query("global_privileges_long", f"""
SELECT server, user, host, with_grant_option, unnest(string_split(privileges, ', ')) AS privilege
FROM ({GLOBAL_SQL})""")
def global_privileges_long(i):
    return U.long_privileges(U.global_privileges(i["grants_global"]))


@query("database_privileges", DATABASE_SQL)
def database_privileges(i):
    return shown(U.database_privileges(i["grants_db"]))


@query("table_privileges", TABLE_SQL)
def table_privileges(i):
    return shown(U.table_privileges(i["grants_set"]))


def statements(i):
    return U.all_statements(i["grants_global"], i["grants_db"], i["grants_set"])


@query("grant_statements", STATEMENTS_SQL)
def grant_statements(i):
    return statements(i)


@query("dangling_grants", DANGLING_SQL)
def dangling_grants(i):
    return U.dangling_statements(
        i["accounts"], i["grants_global"], i["grants_db"], i["grants_set"]
    )


def grantee_count(grants: str) -> str:
    return f"""(SELECT count(*) FROM {{{grants}}}
         WHERE user <> '' AND user NOT IN {INTERNAL} AND user <> 'root')"""


PRIVILEGE_ROWS = " + ".join(
    grantee_count(g) for g in ("grants_global", "grants_db", "grants_set")
)


@query("access_summary", f"""
SELECT count(*) AS total_users, count(*) FILTER (status = 'selected') AS migrated_users,
       count(*) FILTER (status = 'skipped') AS skipped_users,
       {PRIVILEGE_ROWS} AS total_privileges,
       {PRIVILEGE_ROWS} - (SELECT count(*) FROM ({DANGLING_SQL})) AS migrated_privileges,
       (SELECT count(*) FROM ({DANGLING_SQL})) AS error_privileges
FROM ({ACCOUNTS_SQL})""")
def access_summary(i):
    return U.access_summary(
        i["accounts"], i["grants_global"], i["grants_db"], i["grants_set"]
    )
