"""Exactly once: outputs and source offsets become visible together, or not at all."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog import model
from streamlog.functions import context, envelope
from streamlog.sources import subs
from streamlog.streaming.store import OutputLog
from streamlog.workspace import materialize, measured, query_id, scratch

# Fixed default: how often a transaction is committed.
COMMIT_INTERVAL = "100 milliseconds"


def stable_ends(log: DataFrame, transactions: DataFrame) -> DataFrame:
    """First offset of an undecided transaction, per topic-partition that has one."""
    decided = transactions.filter(F.col("status").isin("committed", "aborted")).select("txn_id")
    open_ = log.filter(F.col("txn_id").isNotNull()).join(decided, "txn_id", "left_anti")
    return open_.groupBy(*model.TP).agg(F.min("offset").alias("stable_end"))


def read_committed(log: DataFrame, transactions: DataFrame) -> DataFrame:
    """Records of committed transactions and records outside any transaction.

    ``transactions``: txn_id, status ("committed", "aborted"; anything else, or no
    row, is undecided). A topic-partition is read up to its first undecided
    record, so that nothing is passed over which commits later. A stream cannot
    go back to what it passed over, so it fails here: see ``committed.flow``.
    """
    if log.isStreaming:
        raise ValueError("a stream of committed records needs committed.flow, which keeps undecided records")
    ends = measured(stable_ends(log, transactions), "stable-ends")
    log = log.join(ends, model.TP, "left").filter("stable_end IS NULL OR offset < stable_end").drop("stable_end")
    # Records outside transactions take no part in the join: as NULL keys they
    # would all be sent to one task.
    committed = transactions.filter(F.col("status") == "committed").select("txn_id")
    outside = log.filter(F.col("txn_id").isNull())
    inside = log.filter(F.col("txn_id").isNotNull()).join(committed, "txn_id", "left_semi")
    return outside.unionByName(inside)


def source(
    log: DataFrame, sub: subs.Subscription, group_id: str, transactions: DataFrame | None = None, *,
    metadata: Column | None = None,
) -> DataFrame:
    """Committed records of a subscription with the context a transaction commits.

    A stream with transactions goes through ``committed.transactional_flow``.
    """
    records = subs.select(log, sub)
    if transactions is not None:
        records = read_committed(records, transactions)
    return context.with_context(records, group_id, metadata)


def batch_offsets(contexts: DataFrame) -> DataFrame:
    """Offsets of one transaction: the highest per topic-partition, plus one.

    All contexts of a transaction must come from one group, see
    ``require_single_group``.
    """
    return contexts.groupBy(*model.GTP).agg(
        (F.max("offset") + 1).alias("offset"), F.max_by("metadata", "offset").alias("metadata")
    )


def require_single_group(offsets: DataFrame) -> DataFrame:
    """Fail if the offsets (one row per topic-partition) name more than one group."""
    everything = Window.partitionBy()
    same = F.min("group_id").over(everything) == F.max("group_id").over(everything)
    checked = F.when(same, F.col("group_id")).otherwise(
        F.raise_error(F.lit("a transaction must not mix groups"))
    )
    return offsets.coalesce(1).withColumn("group_id", checked)


def claim_once(out: OutputLog, writer: str, checkpoint: str) -> Callable[[], dict]:
    """The query that owns ``checkpoint`` and the epoch it claims for ``writer``, at its first micro-batch."""

    @functools.cache
    def claimed() -> dict:
        owner = query_id(out.spark, checkpoint)
        return {"query_id": owner, "epoch": out.claim(writer, owner)}

    return claimed


def commit_batch(
    out: OutputLog, envelopes: DataFrame, writer: str, batch_id: int, *,
    partitions: int | None = None,
    before_publish: Callable[[int], None] | None = None,
    query_id: str | None = None,
    epoch: int = 0,
) -> DataFrame | None:
    """One transaction: stage the records, then publish them with the offsets.

    ``envelopes``: records and ctx. Records go out in source order. Returns the
    written records, or None if this batch was published before.
    """
    if out.is_published(writer, batch_id, query_id):
        return None
    with scratch(out.spark):
        # Records and offsets come from one evaluation, also if an executor is lost in between.
        envelopes = materialize(envelopes, "envelopes")
        sends = envelope.explode_records(
            envelopes,
            F.col("ctx.topic").alias("_src_topic"),
            F.col("ctx.partition").alias("_src_partition"),
            F.col("ctx.offset").alias("_src_offset"),
        )
        staged = out.stage(
            sends, writer, batch_id, ["_src_topic", "_src_partition", "_src_offset", "pos"],
            partitions=partitions, epoch=epoch,
        )
        if before_publish is not None:
            before_publish(batch_id)
        offsets = batch_offsets(envelopes.filter(F.col("ctx").isNotNull()).select("ctx.*"))
        out.publish(staged, require_single_group(offsets), writer, batch_id, query_id, epoch=epoch)
    return staged.records


def flow(
    envelopes: DataFrame, root: str, writer: str, checkpoint: str, *,
    trigger: dict | None = None,
    partitions: int | None = None,
    before_publish: Callable[[int], None] | None = None,
    on_results: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Run a streaming query of envelopes into an output log, exactly once.

    Spark's checkpoint decides what a micro-batch contains; its number names the
    transaction. A batch that failed before it was published is replayed under
    the same number and replaces what it had staged; one that was published is
    passed over. A writer belongs to one checkpoint: another one on the same writer
    fails, as its numbers say nothing about what is published. Each start claims
    the writer: an earlier start that still runs fails when it publishes.
    ``on_results`` gets the written records.
    """
    spark: SparkSession = envelopes.sparkSession
    out = OutputLog(spark, root)

    claimed = claim_once(out, writer, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = commit_batch(
            out, batch, writer, batch_id, partitions=partitions, before_publish=before_publish, **claimed()
        )
        if staged is not None and on_results is not None:
            on_results(staged, batch_id)

    return (
        envelopes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL}))
        .start()
    )


def sink(envelopes: DataFrame, root: str, writer: str, checkpoint: str, **options) -> StreamingQuery:
    """``flow`` without results."""
    return flow(envelopes, root, writer, checkpoint, **options)


def with_offset_context(pairs: DataFrame, ctx: str = "ctx") -> DataFrame:
    """Envelopes paired with a context column, in the shape ``flow`` takes."""
    return pairs.select("records", F.col(ctx).alias("ctx"))
