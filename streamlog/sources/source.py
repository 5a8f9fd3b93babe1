"""Sources: a subscription applied to a log, with or without commit context.

``log`` is a batch or streaming DataFrame with the record columns, see
``log.read``, ``log.read_stream`` and ``kafka``, or a ``table.LogTable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import context
from streamlog.operators import meta
from streamlog.sources import subs
from streamlog.sources.table import LogTable
from streamlog.workspace import measured


def kafka(
    spark: SparkSession, sub: subs.Subscription, bootstrap_servers: str, *,
    streaming: bool = False, read_committed: bool = False, reset: str = "earliest",
) -> DataFrame:
    """Records from brokers, shaped as in a log table; needs the kafka connector on Spark's class path."""
    options = subs.to_kafka_options(
        sub, bootstrap_servers, reset=reset, read_committed=read_committed
    )
    reader = spark.readStream if streaming else spark.read
    return records_of(reader.format("kafka").option("includeHeaders", True).options(**options).load())


def records_of(raw: DataFrame) -> DataFrame:
    """Rows of Spark's kafka source as ``model.RECORD``."""
    return raw.select(
        "topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.col("timestampType").alias("timestamp_type"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.col("headers").cast(model.HEADERS).alias("headers"),
    )


def plain(log: DataFrame, sub: subs.Subscription, **start) -> DataFrame:
    """Records of a subscription, without commit support."""
    return subs.select(log, sub, **start)


def committable(
    log: DataFrame, sub: subs.Subscription, group_id: str, *,
    metadata: Column | None = None, **start,
) -> DataFrame:
    """Records with the context needed to commit them."""
    return context.with_context(plain(log, sub, **start), group_id, metadata)


def shared_assignments(log: meta.Log, assignments: DataFrame) -> DataFrame:
    """One scan, of the folders that are assigned, serving many named assignments (assignment, topic, partition)."""
    named = measured(assignments.select("assignment", *model.TP), "assignments")
    if isinstance(log, LogTable):
        return log.of(named).join(named, model.TP)
    # One row per topic-partition comes to the driver, which lists their folders anyway.
    wanted = subs.assignment(*[(r["topic"], r["partition"]) for r in named.select(*model.TP).distinct().collect()])
    return subs.select(log, wanted).join(named, model.TP)


def committable_shared(
    log: meta.Log, assignments: DataFrame, group_id: str, metadata: Column | None = None
) -> DataFrame:
    return context.with_context(shared_assignments(log, assignments), group_id, metadata)


def for_group(
    log: meta.Log, committed: DataFrame, group_id: str, *, reset: str = "earliest"
) -> DataFrame:
    """What a new reader of ``group_id`` sees: records from its committed offsets on."""
    ends = meta.offset_range(log)
    latest = meta.latest_commits(committed.filter(F.col("group_id") == group_id))
    return subs.from_starts(log, subs.resolve_start(ends, latest, reset=reset))
