"""Tables below a root that the user names: folders, and a pointer to the current ones.

A new state of a table is written to folders of its own. Only then is a row
added that names them, so readers see the old state or the new one.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.model import TableSpec
from tablesync.session import remove_folder
from tablesync.sources.zones import folder_exists

FOLDER_NAME = re.compile("(data|range|merge)-[0-9a-f]{32}")
FORMER_SECONDS = 7 * 24 * 3600
POINTER = "version bigint, folders array<string>"


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.schema}/{spec.name}"


def new_folder(path: str, label: str = "data") -> str:
    """A folder of the table that nothing has been written to yet."""
    return f"{path}/{label}-{uuid.uuid4().hex}"


def _pointer(spark: SparkSession, path: str) -> tuple[int, tuple[str, ...]]:
    """The newest version. Only a folder that is not there means no table; a damaged one raises."""
    if not folder_exists(spark, f"{path}/current"):
        return 0, ()
    reader = spark.read.schema(POINTER).option("recursiveFileLookup", "true")
    row = reader.parquet(f"{path}/current").orderBy(F.desc("version")).first()
    return (row["version"], tuple(row["folders"])) if row else (0, ())


def current_folders(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The folders that make up the table now; none if there is no table."""
    return _pointer(spark, path)[1]


def publish(spark: SparkSession, path: str, folders: Sequence[str]) -> None:
    """Make ``folders`` the table. One writer at a time may publish a table."""
    version = _pointer(spark, path)[0] + 1
    row = spark.range(0, 1, 1, 1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.array(*[F.lit(folder) for folder in folders]).alias("folders"),
    )
    row.write.parquet(f"{path}/current/{uuid.uuid4().hex}")


def open_table(
    spark: SparkSession, root: str, spec: TableSpec, schema: T.StructType | None = None
) -> DataFrame:
    """The table as it is now; an error if there is none."""
    folders = current_folders(spark, table_path(root, spec))
    if not folders:
        raise LookupError(f"no table {spec.table_key} below {root}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders)


def remove_unused(spark: SparkSession, path: str, folders: Sequence[str]) -> list[str]:
    """Delete those of a table's former ``folders`` that it no longer uses; returns them."""
    used = set(current_folders(spark, path))
    gone = [f for f in folders if f not in used and f.startswith(f"{path}/")]
    for folder in gone:
        remove_folder(spark, folder)
    return gone


def _tail(folder: str) -> str:
    """A folder's name below its table, which no other folder has, however the root is spelled."""
    *_, above, name = folder.rstrip("/").split("/")
    return f"{above}/{name}" if "=" in name else name


def remove_former(
    spark: SparkSession, path: str, keep_seconds: float = FORMER_SECONDS, keep: Sequence[str] = ()
) -> list[str]:
    """Delete the folders of the table at ``path`` that no version needs any more; returns their names.

    What the pointer or ``keep`` names stays, as does whatever was written to in the last
    ``keep_seconds``: a reader may still be at a former version, and a copy may be
    about to publish. Only folders that ``new_folder`` has named are looked at.
    Without a readable pointer nothing is deleted.
    """
    current = current_folders(spark, path)
    if not current:
        return []
    used = {_tail(folder) for folder in (*current, *keep)}
    bases = used | {name.split("/")[0] for name in used}
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    before = (time.time() - keep_seconds) * 1000
    gone = []

    def look(parent, is_one) -> None:
        for status in system.listStatus(parent):
            below, name = status.getPath(), _tail(status.getPath().toString())
            if not status.isDirectory() or not is_one(below.getName()) or name in used:
                continue
            if name in bases:  # some of its parts are in use
                look(below, lambda part: "=" in part)
            elif status.getModificationTime() <= before:
                system.delete(below, True)
                gone.append(name)

    look(place, lambda name: FOLDER_NAME.fullmatch(name))
    return sorted(gone)
