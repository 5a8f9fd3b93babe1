"""Commits of streaming queries up to the first offset that is not processed yet.

Micro-batches may bring the records of a topic-partition in any order. What was processed is kept
as intervals, and only the end of the interval that began at the start offset, the front, is
committed: a restart from there skips nothing. State is one row per interval, a single one
where records come in order, and each micro-batch writes it anew beside its commits; nothing that
it reads grows with the number of micro-batches.

Every record's context has to come through, also that of a record which is dropped on the way
(``envelope.pass_through``); the front waits at an offset that does not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlog import model
from streamlog.streaming.delivery import COMMITS, running_query
from streamlog.workspace import delete, list_names, list_numbers, materialize, scratch

#: Consecutive offsets whose runs one task finds.
CHUNK_BITS = 17
STATE = (
    "group_id string, topic string, partition int, `from` bigint, `to` bigint, metadata string, front boolean, commit_seq bigint"
)


def runs(contexts: DataFrame, *, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Contexts to intervals ``from``, ``to`` (exclusive) of consecutive offsets; ``metadata`` is that of the last one."""
    chunk = F.shiftright("offset", chunk_bits)
    order = Window.partitionBy(*model.GTP, "_chunk").orderBy("offset")
    before = F.lag("offset").over(order)
    starts = F.when(before.isNull() | (F.col("offset") > before + 1), 1).otherwise(0)
    numbered = contexts.withColumn("_chunk", chunk).withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(order))
    return numbered.groupBy(*model.GTP, "_chunk", "_run").agg(
        F.min("offset").alias("from"), (F.max("offset") + 1).alias("to"), F.max_by("metadata", "offset").alias("metadata")
    ).drop("_chunk", "_run")


def merge(intervals: DataFrame) -> DataFrame:
    """Intervals that overlap or touch become one; ``front`` if one of them is."""
    order = Window.partitionBy(*model.GTP).orderBy("from", "to")
    reached = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reached.isNull() | (F.col("from") > reached), 1).otherwise(0)
    numbered = intervals.withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(order))
    return numbered.groupBy(*model.GTP, "_run").agg(
        F.min("from").alias("from"), F.max("to").alias("to"), F.max_by("metadata", "to").alias("metadata"), F.bool_or("front").alias("front")
    ).drop("_run")


@dataclass(frozen=True)
class Frontier:
    """Commits of streaming queries in one folder.

    ``starts`` (topic, partition, start): where groups begin that have no commit yet; offset 0 for topic-partitions
    it does not name.
    """

    spark: SparkSession
    path: str
    starts: DataFrame | None = None

    def _at(self, kind: str, query: str | None, batch_id: int) -> str:
        return f"{self.path}/{kind}/query={query}/batch_id={batch_id}"

    def _newest(self, query: str) -> int | None:
        """The last micro-batch of a query whose state is whole."""
        numbers = list_numbers(self.spark, f"{self.path}/state/query={query}", "batch_id=")
        return next((n for n in reversed(numbers) if self._whole(query, n)), None)

    def _whole(self, query: str | None, batch_id: int) -> bool:
        return "_SUCCESS" in list_names(self.spark, self._at("state", query, batch_id))

    def is_committed(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a micro-batch of the running query is committed; looks at one folder."""
        return self._whole(running_query(spark), batch_id)

    def _state(self, query: str | None, batch_id: int) -> DataFrame:
        """What is processed before a micro-batch: by its query, or if it is the first one by others."""
        if batch_id and self._whole(query, batch_id - 1):
            return self.spark.read.schema(STATE).parquet(self._at("state", query, batch_id - 1))
        return self.state(skip=query)

    def state(self, skip: str | None = None) -> DataFrame:
        """The newest state over all queries: one row per interval, with the newest ``commit_seq``."""
        queries = [q.removeprefix("query=") for q in list_names(self.spark, f"{self.path}/state", "query=")]
        newest = [self._at("state", q, n) for q in queries if q != str(skip) and (n := self._newest(q)) is not None]
        if not newest:
            return self.spark.createDataFrame([], STATE)
        rows = self.spark.read.schema(STATE).parquet(*newest)
        last = rows.groupBy(*model.GTP).agg(F.max("commit_seq").alias("commit_seq"))
        # The furthest front counts; what other queries processed beyond it does as well.
        top = F.max(F.when(F.col("front"), F.col("to"))).over(Window.partitionBy(*model.GTP))
        merged = merge(rows.withColumn("front", F.col("front") & (F.col("to") == top)).drop("commit_seq"))
        return _above_front(merged).join(last, model.GTP).select("group_id", *model.TP, "from", "to", "metadata", "front", "commit_seq")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Commit the contexts (column ctx) of a micro-batch; a replay changes nothing."""
        query = running_query(self.spark)
        if self._whole(query, batch_id):
            return
        with scratch(self.spark):
            before = materialize(self._state(query, batch_id), "processed")
            new = materialize(runs(batch.filter("ctx IS NOT NULL").select("ctx.*")), "runs")
            unknown = new.select(*model.GTP).distinct().join(before.select(*model.GTP).distinct(), model.GTP, "left_anti")
            start = F.lit(0).cast("bigint")
            if self.starts is not None:
                unknown = unknown.join(self.starts.select(*model.TP, F.col("start").alias("_start")), model.TP, "left")
                start = F.coalesce("_start", start)
            seeds = unknown.select(
                *model.GTP, start.alias("from"), start.alias("to"), F.lit(None).cast("string").alias("metadata"), F.lit(True).alias("front")
            )
            known = before.drop("commit_seq").unionByName(seeds)
            merged = materialize(_above_front(merge(known.unionByName(new.withColumn("front", F.lit(False))))), "merged")
            fronts = known.filter("front").select(*model.GTP, F.col("to").alias("_was"))
            seq = F.lit((before.agg(F.max("commit_seq")).first()[0] or 0) + 1).cast("bigint")
            moved = merged.filter("front").join(fronts, model.GTP).filter(F.col("to") > F.col("_was")).select(
                *model.GTP, F.col("to").alias("offset"), "metadata", seq.alias("commit_seq"),
                F.lit(query).cast("string").alias("query_id"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            )
            moved.coalesce(1).write.mode("overwrite").parquet(self._at("commits", query, batch_id))
            # Written last: it tells that the micro-batch is committed.
            merged.withColumn("commit_seq", seq).coalesce(1).write.mode("overwrite").parquet(self._at("state", query, batch_id))
        for old in list_numbers(self.spark, f"{self.path}/state/query={query}", "batch_id="):
            if old < batch_id - 1:
                delete(self.spark, self._at("state", query, old))

    def commits(self) -> DataFrame:
        """All commits, as ``meta.latest_commits`` takes them."""
        empty = self.spark.createDataFrame([], COMMITS)
        if not list_names(self.spark, f"{self.path}/commits", "query="):
            return empty
        return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits").select(*empty.columns)

    def fronts(self) -> DataFrame:
        """Committed offset and metadata per group and topic-partition, from the newest state alone."""
        return self.state().filter("front").select(*model.GTP, F.col("to").alias("offset"), "metadata")


def _above_front(merged: DataFrame) -> DataFrame:
    """The front as an empty interval, and what lies beyond it."""
    front = F.max(F.when(F.col("front"), F.col("to"))).over(Window.partitionBy(*model.GTP))
    kept = merged.withColumn("_front", front).filter(F.col("front") | (F.col("to") > F.col("_front")))
    return kept.withColumn("from", F.when(F.col("front"), F.col("to")).otherwise(F.col("from"))).drop("_front")
