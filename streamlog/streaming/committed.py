"""Committed records of a stream, in the order of each topic-partition.

Records from the first undecided one of a topic-partition on have to wait. They are
stored once, in the micro-batch that brought them, and read again when a decision
releases them. What a micro-batch carries on is narrow: a row per waiting transaction and
topic-partition, and a row per stored run of waiting records. So its cost follows the new
records, the released ones and the number of transactions that are open.

Decisions may come as a stream of their own. A micro-batch then also runs when there
are only decisions, and they are kept for records that arrive after them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamlog import model
from streamlog.streaming import txn
from streamlog.streaming.store import OutputLog
from streamlog.workspace import (
    delete, has_files, list_names, list_numbers, materialize, query_id, read_if_exists, scratch,
)

Transactions = DataFrame | Callable[[], DataFrame]
DECIDED = ("committed", "aborted")


class _State:
    """Folders of one streaming query."""

    def __init__(self, spark: SparkSession, root: str, rows: T.StructType):
        self.spark, self.root, self.rows = spark, root, rows
        tp = [rows[c] for c in model.TP]
        span = [T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]
        #: Transactions with records that wait; status is NULL while undecided.
        self.txns = T.StructType([rows["txn_id"], *tp, *span, T.StructField("status", T.StringType())])
        #: Runs of waiting records: the micro-batch that stored them, up to which offset earlier ones released them,
        #: and up to which this one releases.
        self.runs = T.StructType(
            [T.StructField("held_in", T.LongType()), *tp, *span, *(T.StructField(c, T.LongType()) for c in ("released_to", "limit"))]
        )
        self.ends = T.StructType([*tp, T.StructField("stable_end", T.LongType())])
        self.decisions = T.StructType([rows["txn_id"], T.StructField("status", T.StringType())])

    def path(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/batch_id={batch_id}"

    def read(self, kind: str, batch_id: int, schema: T.StructType) -> DataFrame:
        return read_if_exists(self.spark, self.path(kind, batch_id), schema)

    def write(self, df: DataFrame, kind: str, batch_id: int, schema: T.StructType) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(kind, batch_id))
        return self.spark.read.schema(schema).parquet(self.path(kind, batch_id))

    def numbers(self, kind: str) -> list[int]:
        return list_numbers(self.spark, f"{self.root}/{kind}", "batch_id=")

    def decided(self) -> DataFrame:
        paths = [p for n in self.numbers("decisions") if has_files(self.spark, p := self.path("decisions", n))]
        if not paths:
            return self.spark.createDataFrame([], self.decisions)
        return self.spark.read.schema(self.decisions).parquet(*paths)


def _merged(before: DataFrame, opened: DataFrame, decided: DataFrame) -> DataFrame:
    """Waiting transactions with those of new records; what is undecided takes its status from ``decided``."""
    merged = before.unionByName(opened).groupBy("txn_id", *model.TP).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("status").alias("_known")
    )
    found = decided.filter(F.col("status").isin(*DECIDED)).groupBy("txn_id").agg(F.max("status").alias("_found"))
    return merged.join(found, "txn_id", "left").withColumn("status", F.coalesce("_known", "_found")).drop("_known", "_found")


def _step(state: _State, new: DataFrame, decided: DataFrame, batch_id: int) -> set[int]:
    """Decide what the micro-batch releases; ``ready`` is written last. Returns which runs are still needed."""
    columns = state.rows.fieldNames()
    opened = new.filter("txn_id IS NOT NULL").groupBy("txn_id", *model.TP).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.lit(None).cast("string").alias("status")
    )
    old_ends = state.read("ends", batch_id - 1, state.ends)
    before = state.read("txns", batch_id - 1, state.txns).join(old_ends, model.TP, "left")
    waited = before.filter("status IS NULL OR last >= stable_end").drop("stable_end")
    txns = state.write(_merged(waited, opened, decided), "txns", batch_id, state.txns)
    first_open = txns.filter("status IS NULL").groupBy(*model.TP).agg(F.min("first").alias("stable_end"))
    ends = state.write(first_open, "ends", batch_id, state.ends)

    held = new.join(ends, model.TP).filter("offset >= stable_end").select(*columns)
    held = held.repartition(*model.TP, F.shiftright("offset", 17)).sortWithinPartitions(*model.TP, "offset")
    stored = state.write(held, "waiting", batch_id, state.rows).groupBy(*model.TP).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.min("offset").alias("released_to")
    )
    carried = state.read("runs", batch_id - 1, state.runs).withColumn("released_to", F.greatest("released_to", "limit"))
    runs = carried.filter("released_to <= last").drop("limit").unionByName(
        stored.withColumn("held_in", F.lit(batch_id).cast("bigint"))
    )
    limit = F.least(F.coalesce("stable_end", F.col("last") + 1), F.col("last") + 1)
    runs = runs.join(ends, model.TP, "left").withColumn("limit", limit)
    runs = state.write(runs.select(*state.runs.fieldNames()), "runs", batch_id, state.runs)
    hit = F.col("limit") > F.col("released_to")
    # One row per micro-batch whose records wait comes to the driver.
    held_in = runs.groupBy("held_in").agg(
        F.min(F.when(hit, F.col("released_to"))).alias("low"), F.max(F.when(hit, F.col("limit"))).alias("high"),
        F.bool_or(F.greatest("released_to", "limit") <= F.col("last")).alias("waits"),
    ).collect()

    released = new.join(ends, model.TP, "left").filter("stable_end IS NULL OR offset < stable_end").select(*columns)
    for row in held_in:
        if row["low"] is not None:
            run = state.read("waiting", row["held_in"], state.rows).filter(F.col("offset").between(row["low"], row["high"] - 1))
            mine = runs.filter(hit & (F.col("held_in") == row["held_in"])).select(*model.TP, "released_to", "limit")
            released = released.unionByName(
                run.join(mine, model.TP).filter("offset >= released_to AND offset < limit").select(*columns)
            )
    committed = txns.filter("status = 'committed'").select("txn_id", *model.TP)
    outside = released.filter("txn_id IS NULL")  # no join: NULL keys would all be one task's
    inside = released.filter("txn_id IS NOT NULL").join(committed, ["txn_id", *model.TP], "left_semi")
    state.write(outside.unionByName(inside).select(*columns), "ready", batch_id, state.rows)
    return {row["held_in"] for row in held_in if row["waits"]}


def _forget(state: _State, batch_id: int, needed: set[int], recall: int | None) -> None:
    """Delete what no later micro-batch and no replay of this one reads."""
    last = {"txns": batch_id - 2, "ends": batch_id - 2, "runs": batch_id - 2, "ready": batch_id - 2, "waiting": batch_id}
    if recall is not None:
        last["decisions"] = batch_id - recall
    for kind, oldest in last.items():
        for n in state.numbers(kind):
            if n <= oldest and not (kind == "waiting" and n in needed):
                delete(state.spark, state.path(kind, n))


def flow(
    log: DataFrame, transactions: Transactions, sink: Callable[[DataFrame, int], None],
    pending: str, checkpoint: str, *, trigger: dict | None = None, recall: int | None = None,
) -> StreamingQuery:
    """Hand the committed records of a stream to ``sink``, as ``txn.read_committed`` does for a table.

    ``log`` has a column txn_id. ``transactions`` (txn_id, status) is a stream of
    decisions, or a function that gives their present table, which is asked in each
    micro-batch. A topic-partition is released up to its first undecided record. What
    a micro-batch releases is stored before ``sink`` runs, so a replay hands on the
    same records under the same number. A decision of a stream is remembered for
    ``recall`` micro-batches (None: always) for records that come after it; it is final.
    """
    spark: SparkSession = log.sparkSession
    asked = callable(transactions)
    both = log if asked else log.withColumn("_status", F.lit(None).cast("string")).unionByName(
        transactions.select(F.col("txn_id").cast(log.schema["txn_id"].dataType), F.col("status").alias("_status"))
        .filter(F.col("_status").isNotNull()),
        allowMissingColumns=True,
    )

    @functools.cache
    def state() -> _State:
        return _State(spark, f"{pending}/query={query_id(spark, checkpoint)}", log.schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = state()
        if "_SUCCESS" not in list_names(spark, own.path("ready", batch_id)):
            with scratch(spark):
                stored = materialize(batch, "arrived")
                if asked:
                    new, decided = stored, transactions().select("txn_id", "status")
                else:
                    new = stored.filter("_status IS NULL").select(*log.columns)
                    made = stored.filter("_status IS NOT NULL").select("txn_id", F.col("_status").alias("status"))
                    own.write(made, "decisions", batch_id, own.decisions)
                    decided = own.decided()
                needed = _step(own, new, decided, batch_id)
            _forget(own, batch_id, needed, recall)
        sink(spark.read.schema(log.schema).parquet(own.path("ready", batch_id)), batch_id)

    return (
        both.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": txn.COMMIT_INTERVAL}))
        .start()
    )


def transactional_flow(
    log: DataFrame, transactions: Transactions, process: Callable[[DataFrame], DataFrame],
    root: str, writer: str, checkpoint: str, *,
    trigger: dict | None = None, recall: int | None = None, partitions: int | None = None,
    before_publish: Callable[[int], None] | None = None,
    on_results: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Read committed records, process them, and write them exactly once.

    ``process`` turns committed records into envelopes (records, ctx), as
    ``txn.source`` and an envelope column do for a table. What one micro-batch
    releases is one transaction of the output log at ``root``.
    """
    spark = log.sparkSession
    out = OutputLog(spark, root)

    claimed = txn.claim_once(out, writer, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        staged = txn.commit_batch(
            out, process(batch), writer, batch_id, partitions=partitions, before_publish=before_publish, **claimed()
        )
        if staged is not None and on_results is not None:
            on_results(staged, batch_id)

    return flow(log, transactions, sink, f"{root}/pending/{writer}", checkpoint, trigger=trigger, recall=recall)
