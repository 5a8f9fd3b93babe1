"""What is in a log, and how far groups have read it.

A log is a DataFrame of records, which has to be scanned, or a ``LogTable``, whose manifest
tells the same without reading a record and knows topic-partitions that are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlog import model
from streamlog.sources.table import LogTable
from streamlog.workspace import measured

Log = DataFrame | LogTable


def _partitions(log: Log) -> DataFrame:
    return log.partitions() if isinstance(log, LogTable) else log.select(*model.TP).distinct()


def list_topics(log: Log) -> DataFrame:
    """topic, partitions: sorted array."""
    found = _partitions(log)
    return found.groupBy("topic").agg(F.sort_array(F.collect_list("partition")).alias("partitions"))


def partitions_for(log: Log, topic: str) -> DataFrame:
    return _partitions(log).filter(F.col("topic") == topic)


def offset_range(log: Log) -> DataFrame:
    """begin_offset and end_offset of every topic-partition that has records, in a ``LogTable`` of all."""
    if isinstance(log, LogTable):
        return log.offset_range()
    return log.groupBy(*model.TP).agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def _ranges_of(log: Log, wanted: DataFrame) -> DataFrame:
    if isinstance(log, LogTable):
        return log.offset_range().join(wanted, model.TP, "left_semi")
    return offset_range(log.join(wanted, model.TP, "left_semi"))


def _for_requested(log: Log, requested: DataFrame, column: str, strict: bool) -> DataFrame:
    wanted = measured(requested.select(*model.TP).distinct())
    ranges = _ranges_of(log, wanted)
    value = F.col(column)
    if strict:
        missing = F.concat(F.lit("unknown topic-partition "), "topic", F.lit("/"), "partition")
        value = F.coalesce(value, F.raise_error(missing).cast("bigint"))
    else:
        value = F.coalesce(value, F.lit(0))
    return wanted.join(ranges, model.TP, "left").select(*model.TP, value.alias(column))


def beginning_offsets(log: Log, requested: DataFrame, *, strict: bool = False) -> DataFrame:
    """First available offset. ``strict`` fails on a topic-partition that the log does not know."""
    return _for_requested(log, requested, "begin_offset", strict)


def end_offsets(log: Log, requested: DataFrame, *, strict: bool = False) -> DataFrame:
    """Next offset to be written; 0 for an empty topic-partition."""
    return _for_requested(log, requested, "end_offset", strict)


def offsets_for_times(log: Log, times: DataFrame) -> DataFrame:
    """First record at or after ``times(topic, partition, at)``: offset and timestamp.

    A ``LogTable`` reads at most one file per time. Records of a DataFrame are all read.
    Both are NULL when there is none. A record is counted once, under the latest
    requested time it satisfies, however many times are asked of its
    topic-partition; earlier times then take the minimum over later ones.
    """
    if isinstance(log, LogTable):
        return log.offsets_for_times(times)
    wanted = times.select(*model.TP, "at").distinct()
    asked = measured(
        wanted.groupBy(*model.TP).agg(F.array_sort(F.collect_list("at")).alias("_ats"))
    )
    met = F.filter("_ats", lambda at: at <= F.col("timestamp"))
    firsts = (
        log.join(asked, model.TP)
        .select(*model.TP, "offset", "timestamp", F.try_element_at(met, F.lit(-1)).alias("at"))
        .filter(F.col("at").isNotNull())
        .groupBy(*model.TP, "at")
        .agg(F.min("offset").alias("_offset"), F.min_by("timestamp", "offset").alias("_timestamp"))
    )
    this_or_later = (
        Window.partitionBy(*model.TP)
        .orderBy(F.desc("at"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    hit = F.min(
        F.when(F.col("_offset").isNotNull(), F.struct("_offset", "_timestamp"))
    ).over(this_or_later)
    return (
        wanted.join(firsts, [*model.TP, "at"], "left")
        .withColumn("_hit", hit)
        .select(
            *model.TP,
            "at",
            F.col("_hit._offset").alias("offset"),
            F.col("_hit._timestamp").alias("timestamp"),
        )
    )


def latest_commits(commits: DataFrame) -> DataFrame:
    """Committed offset and metadata per group and topic-partition.

    ``commits``: group_id, topic, partition, offset, metadata, commit_seq.
    """
    return commits.groupBy(*model.GTP).agg(
        F.max_by("offset", "commit_seq").alias("offset"),
        F.max_by("metadata", "commit_seq").alias("metadata"),
    )


def committed_offsets(commits: DataFrame, group_id: str, requested: DataFrame) -> DataFrame:
    """Committed offsets of the requested topic-partitions; uncommitted ones are left out."""
    latest = latest_commits(commits.filter(F.col("group_id") == group_id))
    return latest.join(requested.select(*model.TP).distinct(), model.TP, "left_semi")


def positions(
    log: Log, requested: DataFrame, committed: DataFrame, sought: DataFrame, *,
    reset: str = "earliest",
) -> DataFrame:
    """Position of a reader: the offset it sought, else committed, else the policy."""
    from streamlog.sources import subs

    wanted = measured(requested.select(*model.TP).distinct())
    ranges = _ranges_of(log, wanted)
    known = wanted.join(ranges, model.TP, "left")
    asked = sought.select(*model.TP, F.col("offset").alias("sought"))
    joined = known.join(asked, model.TP, "left")
    return subs.resolve_start(joined, committed, reset=reset, explicit="sought").withColumnRenamed(
        "start", "position"
    )


def consumer_lag(log: Log, commits: DataFrame, groups: DataFrame) -> DataFrame:
    """Records still to read: end offset minus committed (or first) offset.

    ``groups``: group_id, topic, partition.
    """
    latest = latest_commits(commits).select(*model.GTP, F.col("offset").alias("committed_offset"))
    lag = F.col("end_offset") - F.coalesce("committed_offset", "begin_offset")
    return (
        groups.select(*model.GTP)
        .join(offset_range(log), model.TP)
        .join(latest, model.GTP, "left")
        .select(*model.GTP, "end_offset", "committed_offset", lag.alias("lag"))
    )
