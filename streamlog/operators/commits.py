"""Offset batches and commits.

Commit input ("committables") has the columns group_id, topic, partition, offset,
metadata, arrival_seq and batch_size. ``arrival_seq`` is a unique integer giving
the order in which one stream hands offsets over.

A batch row holds the offset to commit, which is the last processed one **plus
one**, and ``updates``, the committables it stands for; a batch's size is the sum
of its updates. Three different rules decide which offset counts:

- in a batch the last one handed over, even if lower (``offset_batch``),
- in the reader's own aggregation the highest, the earliest of equals
  (``aggregate_offsets``),
- in a transaction the highest (``txn.batch_offsets``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import ordered
from streamlog.operators import folds
from streamlog.workspace import materialize

STREAM = ["group_id"]


def _batch_columns() -> list[Column]:
    return [
        (F.max_by("offset", "arrival_seq") + 1).alias("offset"),
        F.max_by("metadata", "arrival_seq").alias("metadata"),
    ]


def with_batch_size(batches: DataFrame, keys: list[str] = []) -> DataFrame:
    """Add the size of the batch to each of its rows (one per topic-partition)."""
    return batches.withColumn("batch_size", F.sum("updates").over(Window.partitionBy(*keys)))


def offset_batch(committables: DataFrame) -> DataFrame:
    """All committables folded into one batch; the last offset of each partition wins."""
    return committables.groupBy(*model.GTP).agg(
        *_batch_columns(), F.sum("batch_size").alias("updates")
    )


def merge_batches(batches: DataFrame) -> DataFrame:
    """Merge batches in ``batch_seq`` order: later ones overwrite, updates add up."""
    return batches.groupBy(*model.GTP).agg(
        F.max_by("offset", "batch_seq").alias("offset"),
        F.max_by("metadata", "batch_seq").alias("metadata"),
        F.sum("updates").alias("updates"),
    )


def offsets(batches: DataFrame) -> DataFrame:
    """The processed offsets of a batch: what is committed minus one."""
    return batches.withColumn("offset", F.col("offset") - 1)


def filter_batch(batches: DataFrame, keep: Column) -> DataFrame:
    """Keep some topic-partitions; each then counts once for the size."""
    return batches.filter(keep).withColumn("updates", F.lit(1).cast("bigint"))


def next_observed(
    committables: DataFrame, *, chunk_bits: int = ordered.CHUNK_BITS
) -> DataFrame:
    """Defer each offset until a higher one of its topic-partition arrives.

    The row that raises the highest offset so far hands over the previous
    highest, so its arrival number becomes the position of that offset. Lower or
    equal arrivals change nothing, except that a batch (``batch_size`` above one)
    hands over on an equal offset as well; the last highest is never handed over.
    """
    # Of equal offsets the earliest arrival stays deferred, of equal batches the last.
    order = F.when(F.col("batch_size") > 1, F.col("arrival_seq")).otherwise(-F.col("arrival_seq"))
    deferred = F.struct("offset", order.alias("_order"), "metadata")
    seen = ordered.running_max(
        committables, model.GTP, "arrival_seq", deferred, name="_deferred", inclusive=False,
        bits=chunk_bits,
    )
    # A batch stands for the offsets below its own, so an equal one hands over too.
    same = (F.col("batch_size") > 1) & (F.col("offset") == F.col("_deferred.offset"))
    raises = (F.col("offset") > F.col("_deferred.offset")) | same
    return seen.filter(raises).select(
        *model.GTP,
        F.col("_deferred.offset").alias("offset"),
        F.col("_deferred.metadata").alias("metadata"),
        "arrival_seq",
        F.lit(1).cast("bigint").alias("batch_size"),  # filtered to one topic-partition
    )


def batch_flow(
    committables: DataFrame, max_batch: int, *, when: str = "first_observed",
    stream: list[str] = STREAM, single: bool = False, chunk_bits: int = ordered.CHUNK_BITS,
) -> DataFrame:
    """Close a batch whenever its size reaches ``max_batch``; the rest closes at the end.

    One row per (stream, batch, topic-partition). Committables may be batches
    themselves, and ``batch_size`` always counts. Input declared ``single`` has
    sizes of one only, which makes the batch number plain arithmetic; any other
    size then fails the query.
    """
    if when == "next_observed":
        # Stored, because numbering reads its input twice.
        committables = materialize(next_observed(committables, chunk_bits=chunk_bits), "next-observed")
    elif when != "first_observed":
        raise ValueError(f"unknown commit rule: {when}")
    if not single:
        # Only what numbers depend on goes through Python.
        rows = committables.select(*stream, "arrival_seq", "batch_size")
        numbers = folds.batch_numbers(
            rows, stream, "arrival_seq", "batch_size", max_batch, chunk_bits=chunk_bits
        )
        numbered = committables.join(numbers.drop("batch_size"), [*stream, "arrival_seq"])
    else:
        one = F.when(F.col("batch_size") == 1, 1).otherwise(F.raise_error(F.lit("not a single committable")).cast("int"))
        numbered = committables.withColumn("batch_size", one.cast("bigint"))
        numbered = ordered.row_number(numbered, stream, "arrival_seq", name="_rn", bits=chunk_bits)
        numbered = numbered.withColumn("batch", F.expr(f"(_rn - 1) div {max_batch}")).drop("_rn")
    keys = list(dict.fromkeys([*stream, "batch", *model.GTP]))
    return numbered.groupBy(*keys).agg(
        *_batch_columns(),
        F.sum("batch_size").alias("updates"),
        F.max("arrival_seq").alias("last_seq"),
    )


def flow(batches: DataFrame, *, stream: list[str] = STREAM) -> DataFrame:
    """One row per closed batch: its size and how many topic-partitions it covers."""
    return batches.groupBy(*stream, "batch").agg(
        F.sum("updates").alias("batch_size"),
        F.count(F.lit(1)).alias("partitions"),
        F.max("last_seq").alias("last_seq"),
    )


def commit_rows(batches: DataFrame) -> DataFrame:
    """Batches as rows of a committed-offsets table; ``last_seq`` orders commits."""
    return batches.select(*model.GTP, "offset", "metadata", F.col("last_seq").alias("commit_seq"))


def sink(batches: DataFrame, path: str) -> None:
    """Append the closed batches to a committed-offsets table."""
    commit_rows(batches).write.mode("append").parquet(path)


def aggregate_offsets(committables: DataFrame, keys: list[str] = model.TP) -> DataFrame:
    """Highest offset per topic-partition with the metadata of its earliest arrival."""
    rank = F.struct(F.col("offset"), -F.col("arrival_seq"))
    return committables.groupBy(*keys).agg(
        F.max("offset").alias("offset"), F.max_by("metadata", rank).alias("metadata")
    )


def only_assigned(commits: DataFrame, assigned: DataFrame) -> DataFrame:
    """Drop commits of topic-partitions that are not assigned now."""
    return commits.join(assigned.select(*model.TP), model.TP, "left_semi")


def refresh_due(progress: DataFrame, now: Column, interval: Column) -> DataFrame:
    """Overdue topic-partitions whose committed offset is the last requested one.

    ``progress``: topic, partition, requested, committed, last_commit.
    """
    overdue = F.col("last_commit") + interval < now
    return progress.filter(overdue & (F.col("committed") == F.col("requested"))).select(
        *model.TP, F.col("committed").alias("offset")
    )
