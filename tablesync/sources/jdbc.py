"""Tables behind JDBC. Spark's own source does the work; this sets its options."""

from __future__ import annotations

import time
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tablesync.model import TableSpec


def quoted(name: str, quote: str = "`") -> str:
    """A name with quotes around it, those inside doubled."""
    return f"{quote}{name.replace(quote, quote * 2)}{quote}"


def table_name(spec: TableSpec, quote: str = "`") -> str:
    return f"{quoted(spec.schema, quote)}.{quoted(spec.name, quote)}"


def pushed_query(
    table: str, columns: list[str], text_columns: tuple[str, ...] = (), quote: str = "`"
) -> str:
    """A subquery with an explicit column list; ``table`` is quoted already.

    ``text_columns`` are cast to text by the server, so that zero dates arrive
    as they are stored instead of as NULL or an error.
    """
    name = lambda c: quoted(c, quote)
    items = [
        f"CAST({name(c)} AS CHAR) AS {name(c)}" if c in text_columns else name(c) for c in columns
    ]
    return f"(SELECT {', '.join(items)} FROM {table}) t"


def total_query(table: str) -> str:
    """A subquery in which the server counts, so that no row travels."""
    return f"(SELECT COUNT(*) AS total_records FROM {table}) t"


def mark_query(table: str, key: str, quote: str = "`") -> str:
    """A subquery in which the server finds the smallest and largest key."""
    name = quoted(key, quote)
    return f"(SELECT MIN({name}) AS low, MAX({name}) AS high FROM {table}) t"


def driver_options(url: str) -> dict[str, str]:
    """What a server's driver needs to fetch and write in batches at all."""
    if not url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return {}
    return {"useCursorFetch": "true", "rewriteBatchedStatements": "true"}


def read_options(
    url: str,
    table: str,
    fetch_size: int = 100_000,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **more: str,
) -> dict[str, str]:
    """Options of a (partitioned) read: strides over the key range, rows in batches."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size),
               "preferTimestampNTZ": "true", **driver_options(url), **more}
    if partition_column is not None and bounds is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1] + 1),
            "numPartitions": str(partitions),
        }
    return options


def write_options(
    url: str,
    table: str,
    batch_size: int = 100_000,
    truncate: bool = False,
    connections: int | None = None,
    column_types: str | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of a batched write over at most ``connections`` connections."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size),
               "truncate": str(truncate).lower(), **driver_options(url), **more}
    if connections:
        options["numPartitions"] = str(connections)
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def literal(value) -> str:
    """A key value as the server's SQL writes it."""
    if value is None:
        return "NULL"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "''")
    return f"'{text}'"


def compared(key: str, value) -> tuple[str, str]:
    """A key column and a value of it as they are compared.

    Texts are compared by their bytes: ranges are planned in that order, and a server's own order
    of texts may take different ones as equal.
    """
    if isinstance(value, str):
        return f"CAST({key} AS BINARY)", f"CAST({literal(value)} AS BINARY)"
    return key, literal(value)


def beyond(keys: list[str], last: tuple) -> str:
    """Whether a key lies after ``last``, compared column by column."""
    steps = []
    for n, (key, value) in enumerate(zip(keys, last)):
        same = [" = ".join(compared(k, v)) for k, v in zip(keys[:n], last[:n])]
        steps.append(" AND ".join([*same, " > ".join(compared(key, value))]))
    return " OR ".join(f"({step})" for step in steps)


def key_range(keys: list[str], after: tuple | None, upto: tuple | None) -> str:
    """The condition ``after < key <= upto``; without a lower end also rows without a key."""
    tests = []
    if after is not None:
        tests.append(f"({beyond(keys, after)})")
    if upto is not None:
        below = f"NOT ({beyond(keys, upto)})"
        nothing = " OR ".join(f"{k} IS NULL" for k in keys)
        tests.append(below if after is not None else f"({below} OR {nothing})")
    return " AND ".join(tests) or "1 = 1"


def range_predicates(keys: list[str], lasts: list[tuple]) -> list[str]:
    """One condition per batch, from the last keys of a batch plan in key order.

    Equal row counts per partition whatever the gaps in the key. The last range
    is open, so rows that arrive after the plan are read as well.
    """
    ends = [None, *lasts[:-1], None]
    return [key_range(keys, after, upto) for after, upto in zip(ends, ends[1:])] if lasts else ["1 = 1"]


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc_ranges(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str]
) -> DataFrame:
    """One partition and one query per predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()


def execute(spark: SparkSession, url: str, statements: list[str]) -> None:
    """Statements that no DataFrame stands for, over one connection of the driver."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        for statement in statements:
            running = connection.createStatement()
            running.execute(statement)
            running.close()
    finally:
        connection.close()


def patiently(call, attempts: int = 3, wait: float = 1.0):
    """What a call gives, tried again after a wait that doubles; the last error is raised.

    For single questions to a server from the driver, which no Spark task tries again.
    """
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(wait * 2 ** (attempt - 1))
