"""Disk use of jobs that store one large step after another."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside the block Spark deletes the shuffle files of a query when the query ends.

    For queries whose results are written to the shared folder: nothing reads their
    shuffles again, and a lost executor repeats at most the query that runs.
    """
    before = spark.conf.get(_KEY, None)
    spark.conf.set(_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_KEY) if before is None else spark.conf.set(_KEY, before)
