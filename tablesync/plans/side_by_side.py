"""Independent Spark jobs from several driver threads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def side_by_side(
    spark: SparkSession,
    job: Callable[[Item], Result],
    items: Iterable[Item],
    workers: int = 8,
    pool_name: Callable[[Item], str] = str,
) -> list[Result | Exception]:
    """Run ``job`` for each item, each in its own fair pool; an error becomes its result."""
    waiting = list(items)

    def run(item: Item) -> Result | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool_name(item))
        try:
            return job(item)
        except Exception as error:  # reported per item
            return error

    with ThreadPoolExecutor(max(1, min(workers, len(waiting)))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), waiting))
