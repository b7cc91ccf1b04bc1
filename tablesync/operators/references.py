"""What deletions do to tables that refer to each other, through any chain or cycle of references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.skew import join_on_key_set
from tablesync.operators.validate import missing_parents
from tablesync.session import stage

CASCADE, SET_NULL = "cascade", "set null"


@dataclass(frozen=True)
class Reference:
    """``child.fk`` refers to ``parent.pk``; ``action`` is what a deleted parent does to its children."""

    child: str
    fk: str
    parent: str
    pk: str
    action: str = CASCADE

    @property
    def target(self) -> tuple[str, str]:
        return self.parent, self.pk


def _values(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).dropna().distinct()


def dead_values(
    tables: Mapping[str, DataFrame], references: Sequence[Reference],
    deleted: Mapping[tuple[str, str], DataFrame] | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """For every referenced (table, column) the values that no surviving row has, as ``value``.

    Starts with references that lead nowhere and with ``deleted`` values. Each
    round looks only at what the last one added: children of those rows, and the
    values that other references know them by. A round reads of a table its
    references and the columns that others refer to. The rounds end when one adds nothing, after at
    most as many as the longest chain has links; a cycle adds no row twice.
    """
    targets = list(dict.fromkeys(r.target for r in references))
    dead: dict[tuple[str, str], list[DataFrame]] = {t: [] for t in targets}
    delta: dict[tuple[str, str], DataFrame] = {}
    for target in targets:
        table, column = target
        found = [
            missing_parents(tables[r.child], r.fk, tables[table], column).select(F.col(r.fk).alias("value"))
            for r in references if r.target == target
        ]
        if deleted and target in deleted:
            gone = deleted[target]
            found.append(gone.select(F.col(gone.columns[0]).alias("value")))
        delta[target] = stage(_values(found), "dead")
    delta = {t: values for t, values in delta.items() if not values.isEmpty()}
    while delta:
        for target, values in delta.items():
            dead[target].append(values)
        following: dict[tuple[str, str], list[DataFrame]] = {}
        for reference in references:
            if reference.action != CASCADE or reference.target not in delta:
                continue
            known_by = [column for table, column in targets if table == reference.child]
            if not known_by:
                continue
            keys = delta[reference.target].withColumnRenamed("value", reference.fk)
            narrow = tables[reference.child].select(*dict.fromkeys([reference.fk, *known_by]))
            gone = join_on_key_set(narrow, keys, [reference.fk], "left_semi", write_out=False)
            for column in known_by:
                following.setdefault((reference.child, column), []).append(
                    gone.select(F.col(column).alias("value"))
                )
        delta = {}
        for target, frames in following.items():
            values = _values(frames)
            for before in dead[target]:
                values = values.join(before, "value", "left_anti")
            values = stage(values, "dead")
            if not values.isEmpty():
                delta[target] = values
    empty = {t: tables[t[0]].select(F.col(t[1]).alias("value")).limit(0) for t in targets}
    return {t: _values(frames) if frames else empty[t] for t, frames in dead.items()}


def delete_through(
    tables: Mapping[str, DataFrame], references: Sequence[Reference],
    deleted: Mapping[tuple[str, str], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The rows of all tables that are left once deletions have gone through all references.

    A row goes if a cascading reference of its own leads to a row that is
    missing or goes, through however many tables, also back into its own. A reference that sets to
    NULL keeps its row and stops there. ``deleted`` gives, by (table, column), values of a referenced
    column whose rows are deleted. No reference (NULL) leads nowhere. Referenced columns
    hold each value once.
    """
    dead = {t: stage(values, "dead") for t, values in dead_values(tables, references, deleted).items()}
    left = dict(tables)
    for (table, column), values in dead.items():
        keys = values.withColumnRenamed("value", column)
        left[table] = join_on_key_set(left[table], keys, [column], "left_anti", write_out=False)
    for reference in references:
        keys = dead[reference.target].withColumnRenamed("value", reference.fk)
        child = left[reference.child]
        if reference.action == CASCADE:
            left[reference.child] = join_on_key_set(child, keys, [reference.fk], "left_anti", write_out=False)
        else:
            left[reference.child] = _without(child, reference.fk, keys)
    return left


def _without(child: DataFrame, fk: str, dead: DataFrame) -> DataFrame:
    """The child's rows, references to dead values set to NULL."""
    marked = dead.withColumn("_dead", F.lit(True))
    kept = F.when(F.col("_dead").isNull(), F.col(fk))
    return (
        join_on_key_set(child, marked, [fk], "left", write_out=False)
        .withColumn(fk, kept).select(*child.columns)
    )
