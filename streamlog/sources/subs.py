"""Subscriptions: which records of a log a reader wants.

A subscription is a small value. ``select`` turns it into predicates on a log
table, which prune partition directories and, for literal offsets, row groups.
``to_kafka_options`` turns the same value into options of Spark's kafka source,
which has no filter push-down for offsets.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.sources.table import LogTable
from streamlog.workspace import local_table

TopicPartition = tuple[str, int]


@dataclass(frozen=True)
class Topics:
    names: tuple[str, ...]


@dataclass(frozen=True)
class TopicPattern:
    pattern: str


@dataclass(frozen=True)
class Assignment:
    partitions: tuple[TopicPartition, ...]


@dataclass(frozen=True)
class AssignmentWithOffset:
    offsets: dict[TopicPartition, int] = field(hash=False)


@dataclass(frozen=True)
class AssignmentForTimes:
    """``times`` are text timestamps as in the log, or epoch milliseconds for kafka."""

    times: dict[TopicPartition, str | int] = field(hash=False)


Subscription = Topics | TopicPattern | Assignment | AssignmentWithOffset | AssignmentForTimes


def topics(*names: str) -> Topics:
    return Topics(tuple(names))


def topic_pattern(pattern: str) -> TopicPattern:
    return TopicPattern(pattern)


def assignment(*partitions: TopicPartition) -> Assignment:
    return Assignment(tuple(partitions))


def assignment_with_offset(offsets: dict[TopicPartition, int]) -> AssignmentWithOffset:
    return AssignmentWithOffset(dict(offsets))


def assignment_offsets_for_times(times: dict[TopicPartition, str | int]) -> AssignmentForTimes:
    return AssignmentForTimes(dict(times))


def _in_folders(partitions: Iterable[TopicPartition]) -> Column:
    """Literal topic-partitions; Spark lists only their folders, however many there are."""
    wanted = [F.struct(F.lit(topic), F.lit(partition)) for topic, partition in partitions]
    return F.struct(*model.TP).isin(wanted) if wanted else F.lit(False)


def _select_assigned(log: DataFrame, partitions: Iterable[TopicPartition]) -> DataFrame:
    return log.filter(_in_folders(partitions))


def _select_from_offsets(log: DataFrame, offsets: dict[TopicPartition, int]) -> DataFrame:
    """Folders and row groups are pruned by literals, records by a join with the starts."""
    if not offsets:
        return log.filter(F.lit(False))
    pruned = _select_assigned(log, offsets).filter(F.col("offset") >= min(offsets.values()))
    starts = _tp_table(log, tuple(offsets), _start=pa.array(list(offsets.values()), pa.int64()))
    return pruned.join(starts, model.TP).filter(F.col("offset") >= F.col("_start")).drop("_start")


def _tp_table(log: DataFrame | LogTable, partitions: tuple[TopicPartition, ...], **columns) -> DataFrame:
    topics_, numbers = [t for t, _ in partitions], [p for _, p in partitions]
    return local_table(
        log.spark if isinstance(log, LogTable) else log.sparkSession,
        {"topic": pa.array(topics_, pa.string()), "partition": pa.array(numbers, pa.int32()), **columns},
    )


def from_starts(log: DataFrame | LogTable, starts: DataFrame) -> DataFrame:
    """Records at or after ``starts(topic, partition, start)``; other tps are left out.

    A ``LogTable`` is cut at the start of each topic-partition, a DataFrame at the least one.
    The starts, one row per topic-partition of the log, come to the driver, which
    lists the folders of the log anyway: so the scan is pruned by literals.
    """
    if isinstance(log, LogTable):
        return log.from_starts(starts)
    rows = starts.select(*model.TP, "start").filter("start IS NOT NULL").collect()
    return _select_from_offsets(log, {(r["topic"], r["partition"]): r["start"] for r in rows})


def starts_for_times(log: DataFrame, times: DataFrame) -> DataFrame:
    """First offset with a timestamp at or after ``times(topic, partition, at)``.

    ``start`` is NULL for a topic-partition that has no such record; the offsets
    of its first record and its end come along. One scan, one hash aggregate.
    """
    hit = F.when(F.col("timestamp") >= F.col("at"), F.col("offset"))
    found = log.join(times, model.TP).groupBy(*model.TP).agg(
        F.min(hit).alias("start"),
        F.min("offset").alias("begin_offset"),
        (F.max("offset") + 1).alias("end_offset"),
    )
    return times.select(*model.TP).join(found, model.TP, "left")


def times_table(log: DataFrame | LogTable, times: dict[TopicPartition, str]) -> DataFrame:
    texts = pa.array([str(at) for at in times.values()], pa.string())
    table = _tp_table(log, tuple(times), at=texts)
    schema = model.LOG if isinstance(log, LogTable) else log.schema
    return table.withColumn("at", F.col("at").cast(schema["timestamp"].dataType))


def _select_from_table(
    log: LogTable, sub: Subscription, committed: DataFrame | None, reset: str
) -> DataFrame:
    """``select`` by the manifest: only files that hold wanted records are listed."""
    match sub:
        case Topics(names):
            return log.of_topics(F.col("topic").isin(*names))
        case TopicPattern(pattern):
            return log.of_topics(F.col("topic").rlike(f"^(?:{pattern})$"))
        case Assignment(partitions):
            return log.of(_tp_table(log, partitions))
        case AssignmentWithOffset(offsets):
            return log.from_starts(_tp_table(log, tuple(offsets), start=pa.array(list(offsets.values()), pa.int64())))
        case AssignmentForTimes(times):
            sought = log.starts_for_times(times_table(log, times))
            return log.from_starts(resolve_start(sought, committed, reset=reset, explicit="start"))
    raise TypeError(f"not a subscription: {sub!r}")


def select(
    log: DataFrame | LogTable,
    sub: Subscription,
    *,
    batch_log: DataFrame | None = None,
    committed: DataFrame | None = None,
    reset: str = "earliest",
) -> DataFrame:
    """The records of ``log`` that ``sub`` selects.

    A time-based subscription looks up start offsets in ``batch_log`` (the same
    log as a batch table; needed when ``log`` is a stream). From its start
    offset on, a topic-partition is read whole: this is no timestamp filter. A
    topic-partition without a match resumes as in ``resolve_start``.
    """
    if isinstance(log, LogTable):
        return _select_from_table(log, sub, committed, reset)
    match sub:
        case Topics(names):
            return log.filter(F.col("topic").isin(*names))
        case TopicPattern(pattern):
            # On a partition column this prunes directories, like ``isin``.
            return log.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
        case Assignment(partitions):
            return _select_assigned(log, partitions)
        case AssignmentWithOffset(offsets):
            return _select_from_offsets(log, offsets)
        case AssignmentForTimes(times):
            table = log if batch_log is None else batch_log
            assigned = _select_assigned(table, tuple(times))
            sought = starts_for_times(assigned, times_table(table, times))
            starts = resolve_start(sought, committed, reset=reset, explicit="start")
            return from_starts(_select_assigned(log, tuple(times)), starts)
    raise TypeError(f"not a subscription: {sub!r}")


def resolve_start(
    partitions: DataFrame,
    committed: DataFrame | None = None,
    *,
    reset: str = "earliest",
    explicit: str | None = None,
) -> DataFrame:
    """Where to start: an explicit offset, else the committed one, else the policy.

    ``partitions``: topic, partition, begin_offset, end_offset and, if named by
    ``explicit``, a nullable offset column. ``committed``: topic, partition,
    offset of one group. ``reset``: "earliest", "latest" or "none"; with "none" a
    topic-partition without an offset fails the query.
    """
    choices = []
    if explicit is not None:
        choices.append(F.col(explicit))
    if committed is not None:
        offsets = committed.select(*model.TP, F.col("offset").alias("_committed"))
        partitions = partitions.join(offsets, model.TP, "left")
        choices.append(F.col("_committed"))
    match reset:
        case "earliest":
            choices.append(F.coalesce(F.col("begin_offset"), F.lit(0)))
        case "latest":
            choices.append(F.coalesce(F.col("end_offset"), F.lit(0)))
        case "none":
            choices.append(
                F.raise_error(
                    F.concat(F.lit("no offset for "), "topic", F.lit("/"), "partition")
                ).cast("bigint")
            )
        case _:
            raise ValueError(f"unknown reset policy: {reset}")
    return partitions.select(*model.TP, F.coalesce(*choices).cast("bigint").alias("start"))


def to_kafka_options(
    sub: Subscription,
    bootstrap_servers: str,
    *,
    reset: str = "earliest",
    read_committed: bool = False,
) -> dict[str, str]:
    """Options for ``spark.read``/``readStream.format("kafka")``."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, "startingOffsets": reset}
    if read_committed:
        options["kafka.isolation.level"] = "read_committed"

    def nested(values: dict[TopicPartition, object]) -> dict[str, dict[str, object]]:
        by_topic: dict[str, dict[str, object]] = {}
        for (topic, partition), value in values.items():
            by_topic.setdefault(topic, {})[str(partition)] = value
        return by_topic

    def assign(partitions) -> str:
        by_topic: dict[str, list[int]] = {}
        for topic, partition in partitions:
            by_topic.setdefault(topic, []).append(partition)
        return json.dumps(by_topic)

    match sub:
        case Topics(names):
            options["subscribe"] = ",".join(names)
        case TopicPattern(pattern):
            options["subscribePattern"] = pattern
        case Assignment(partitions):
            options["assign"] = assign(partitions)
        case AssignmentWithOffset(offsets):
            options["assign"] = assign(offsets)
            options["startingOffsets"] = json.dumps(nested(offsets))
        case AssignmentForTimes(times):
            options["assign"] = assign(times)
            options["startingOffsetsByTimestamp"] = json.dumps(nested(times))
            # A time without a record must not fail the query; the end is what comes next there.
            options["startingOffsetsByTimestampStrategy"] = "latest"
            del options["startingOffsets"]
        case _:
            raise TypeError(f"not a subscription: {sub!r}")
    return options

