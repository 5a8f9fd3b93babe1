"""Delivery rules of streaming queries, as the order of writes in a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog import model
from streamlog.functions import envelope
from streamlog.streaming import txn
from streamlog.streaming.store import OutputLog
from streamlog.workspace import materialize, read_if_exists, scratch

Write = Callable[[DataFrame, int], None]

COMMITS = (
    "group_id string, topic string, partition int, offset bigint, metadata string, commit_seq bigint,"
    " query_id string, batch_id bigint"
)


def running_query(spark: SparkSession) -> str | None:
    """Id of the streaming query whose micro-batch runs now; it outlives restarts."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def append_records(path: str) -> Write:
    """Append output records to a log folder, partitioned by topic and partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").partitionBy(*model.TP).parquet(path)

    return write


def append_commits(path: str) -> Write:
    """Append the highest context of each topic-partition, plus one, as commit rows.

    ``commit_seq`` goes on from what earlier queries have stored, so that commits
    after a restart with another checkpoint are later ones.
    """
    first: dict[str | None, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = running_query(spark)
        if query not in first:
            others = read_if_exists(spark, path, COMMITS).filter(~F.col("query_id").eqNullSafe(F.lit(query)))
            first[query] = (others.agg(F.max("commit_seq")).first()[0] or -1) + 1
        (
            batch.filter(F.col("ctx").isNotNull())
            .select("ctx.*")
            .groupBy(*model.GTP)
            .agg((F.max("offset") + 1).alias("offset"), F.max_by("metadata", "offset").alias("metadata"))
            .withColumn("commit_seq", F.lit(first[query] + batch_id).cast("bigint"))
            .withColumn("query_id", F.lit(query).cast("string"))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .coalesce(1)
            .write.mode("append")
            .parquet(path)
        )

    return write


def _start(stream: DataFrame, write: Write, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def is_committed(path: str) -> Callable[[SparkSession, int], bool]:
    """Whether the commit table at ``path`` holds a micro-batch of the running query."""

    def check(spark: SparkSession, batch_id: int) -> bool:
        rows = read_if_exists(spark, path, COMMITS)
        mine = F.col("query_id").eqNullSafe(F.lit(running_query(spark)))
        return not rows.filter(mine & (F.col("batch_id") == batch_id)).isEmpty()

    return check


def at_most_once(
    stream: DataFrame, sink: Write, commit: Write, committed: Callable[[SparkSession, int], bool],
    checkpoint: str, *, trigger: dict | None = None,
) -> StreamingQuery:
    """Commit first, then hand the records to ``sink``.

    A micro-batch that is already committed is not handed on again, even if its
    records were lost.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if committed(batch.sparkSession, batch_id):
            return
        commit(batch, batch_id)
        sink(batch, batch_id)

    return _start(stream, write, checkpoint, trigger)


def at_least_once(
    envelopes: DataFrame, sink: Write, commit: Write, checkpoint: str, *, trigger: dict | None = None
) -> StreamingQuery:
    """Write the records of the envelopes, then commit their contexts.

    A failure in between replays the batch, so records may be written twice. The
    commits come from the envelopes, so empty ones are committed as well.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            # Records and commits come from one evaluation, also if an executor is lost in between.
            batch = materialize(batch, "envelopes")
            sink(envelope.explode_records(batch).drop("pos"), batch_id)
            commit(batch, batch_id)

    return _start(envelopes, write, checkpoint, trigger)


def multi_sink(
    stream: DataFrame, sinks: list[Write], commit: Write, checkpoint: str, *,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Several effects on the same records, one commit after all of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            batch = materialize(batch, "records")  # all sinks get the same records, also if an executor is lost
            for sink in sinks:
                sink(batch, batch_id)
            commit(batch, batch_id)

    return _start(stream, write, checkpoint, trigger)


def external_offsets(
    stream: DataFrame, update: Callable[[DataFrame, int], DataFrame], root: str, writer: str,
    group_id: str, checkpoint: str, *, trigger: dict | None = None,
    before_publish: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Store results and offsets in the same place, atomically.

    ``update`` turns a batch of records into result records (topic, partition,
    timestamp, key, value and an integer ``seq``). Start a new query from
    ``stored_offsets``.
    """
    out = OutputLog(stream.sparkSession, root)

    claimed = txn.claim_once(out, writer, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        query, epoch = claimed()["query_id"], claimed()["epoch"]
        if out.is_published(writer, batch_id, query):
            return
        reached = batch.groupBy(*model.TP).agg((F.max("offset") + 1).alias("offset"))
        reached = reached.select(
            F.lit(group_id).alias("group_id"), *model.TP, "offset",
            F.lit(model.NO_METADATA).alias("metadata"),
        )
        with scratch(out.spark):
            staged = out.stage(update(batch, batch_id), writer, batch_id, ["seq"], epoch=epoch)
            if before_publish is not None:
                before_publish(batch_id)
            out.publish(staged, reached, writer, batch_id, query, epoch=epoch)

    return _start(stream, write, checkpoint, trigger)


def stored_offsets(out: OutputLog, group_id: str) -> DataFrame:
    """Where to continue: one start offset per topic-partition."""
    mine = out.source_offsets().filter(F.col("group_id") == group_id)
    return mine.select(*model.TP, "offset")
