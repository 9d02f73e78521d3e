"""Independent Spark jobs started from a few driver threads, as cross-validation in ``pyspark.ml`` does."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

PARALLELISM = 4


def side_by_side(spark: SparkSession, work: Callable, items: list, parallelism: int = PARALLELISM) -> list:
    """``work(item)`` for every item, results in order."""
    if parallelism <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)
