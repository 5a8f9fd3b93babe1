"""Record logs derived from the given tables.

Each log is built once per application and input folder, and written to the
shared folder as a log table; queries scan that table with pruning.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import partitioner
from streamlog.sources import log
from streamlog.sources.table import LogTable, partition_table
from streamlog.workspace import new_dir

PARTITIONS = 4
_paths: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = new_dir(spark, name)
        build(path)
        _paths[key] = path
    return _paths[key]


def _plain_fields(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_type", F.lit(0)).withColumn(
        "headers", F.array().cast(model.HEADERS)
    )


def keyed_events(
    spark: SparkSession, sf_dir: str, partitions: int = PARTITIONS
) -> DataFrame:
    """``events`` as records that have no offset yet."""
    events = table(spark, sf_dir, "events")
    keyed = events.select(
        F.concat(F.lit("ev-"), "event_type").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.col("ts").alias("timestamp"),
        F.col("props").alias("value"),
        F.col("event_id").alias("arrival_seq"),
    )
    return keyed.withColumn("partition", partitioner.partition_for_key(F.col("key"), partitions))


def build_event_log(
    spark: SparkSession, sf_dir: str, path: str, partitions: int = PARTITIONS
) -> None:
    records = log.append_offsets_sorted(
        _plain_fields(keyed_events(spark, sf_dir, partitions)), order_by=["timestamp", "arrival_seq"]
    )
    log.write(records.select(*model.LOG.fieldNames()), path)


def event_log_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "event-log", lambda p: build_event_log(spark, sf_dir, p))


def event_log_of(spark: SparkSession, sf_dir: str, partitions: int) -> DataFrame:
    """The event log with another number of partitions per topic."""
    path = _once(
        spark, sf_dir, f"event-log-{partitions}",
        lambda p: build_event_log(spark, sf_dir, p, partitions),
    )
    return log.read(spark, path)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.read(spark, event_log_path(spark, sf_dir))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a log: a topic per status, keyed by customer."""

    def build(path: str) -> None:
        orders = table(spark, sf_dir, "orders")
        keyed = orders.select(
            F.concat(F.lit("ord-"), F.lower("o_orderstatus")).alias("topic"),
            F.col("o_custkey").cast("string").alias("key"),
            F.col("o_orderdate").alias("timestamp"),
            F.to_json(F.struct("o_orderkey", "o_orderpriority")).alias("value"),
            F.col("o_orderkey").alias("arrival_seq"),
        )
        placed = keyed.withColumn(
            "partition", partitioner.partition_for_key(F.col("key"), PARTITIONS)
        )
        records = log.append_offsets_sorted(
            _plain_fields(placed), order_by=["timestamp", "arrival_seq"]
        )
        log.write(records.select(*model.LOG.fieldNames()), path)

    return log.read(spark, _once(spark, sf_dir, "order-log", build))


def conversation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations``: each conversation is a partition, its turns are offsets."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.lit("conversations").alias("topic"),
        F.col("conv_id").cast("int").alias("partition"),
        F.col("turn").alias("offset"),
        F.col("role").alias("key"),
        F.col("text").alias("value"),
    )


def jittered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with timestamps that do not follow the offsets."""
    back = F.make_dt_interval(hours=(F.col("arrival_seq") % 7 * 3).cast("int"))
    return event_log(spark, sf_dir).withColumn("timestamp", F.col("timestamp") - back)


def k_of(value: str = "value"):
    """The number in the JSON value of an event."""
    return F.get_json_object(value, "$.k").cast("bigint")


def committables(spark: SparkSession, sf_dir: str, *groups: str) -> DataFrame:
    """Every record of the event log handed over for commit.

    Arrival runs backwards within blocks of eight events, so that the last offset
    of a batch is often not the highest. Groups take turns.
    """
    groups = groups or ("g1",)
    n = len(groups)
    seq = F.col("arrival_seq")
    observed = F.expr("(arrival_seq div 8) * 8 + 7 - arrival_seq % 8")
    records = event_log(spark, sf_dir).select(*model.TP, "offset", "timestamp", "arrival_seq")
    parts = F.posexplode(F.array(*[F.lit(g) for g in groups])).alias("_i", "group_id")
    return records.select("*", parts).select(
        "group_id", *model.TP, "offset", "timestamp",
        F.concat(F.lit("m"), seq.cast("string")).alias("metadata"),
        (observed * n + F.col("_i")).alias("arrival_seq"),
        F.lit(1).cast("bigint").alias("batch_size"),
    )


def ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).groupBy(*model.TP).agg(
        (F.max("offset") + 1).alias("end_offset")
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits of group g1 per topic-partition, none in the last partition."""
    end = F.col("end_offset")
    steps = F.array(
        F.struct((F.floor(end / 4)).alias("offset"), F.lit("early").alias("metadata"), F.lit(1).alias("commit_seq")),
        F.struct((F.floor(end / 2)).alias("offset"), F.lit("late").alias("metadata"), F.lit(2).alias("commit_seq")),
    )
    return (
        ends(spark, sf_dir)
        .filter(F.col("partition") < PARTITIONS - 1)
        .select(F.lit("g1").alias("group_id"), *model.TP, F.inline(steps))
    )


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(*model.TP).distinct()


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four epochs in which two members swap partitions; a third joins for the last."""
    e = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("epoch")
    members = F.when(F.col("epoch") == 3, 3).otherwise(2)
    member = F.concat(F.lit("m"), ((F.col("partition") + F.col("epoch")) % members).cast("string"))
    return partitions(spark, sf_dir).select(*model.TP, e).withColumn("member", member)


def transactional_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The event log with transaction ids, and the table of transactions."""
    txn = F.expr("arrival_seq div 100")
    records = event_log(spark, sf_dir).withColumn("txn_id", F.when(txn % 5 != 4, txn))
    status = F.when(F.col("txn_id") % 7 == 3, "aborted").otherwise("committed")
    transactions = (
        records.filter(F.col("txn_id").isNotNull()).select("txn_id").distinct().withColumn("status", status)
    )
    return records, transactions


def polls(spark: SparkSession, sf_dir: str, records: DataFrame | None = None) -> DataFrame:
    """Records with the poll that fetched them; poll 7 of one partition jumps back."""
    records = event_log(spark, sf_dir) if records is None else records
    rewound = (
        (F.col("topic") == "ev-click") & (F.col("partition") == 0) & (F.col("poll_batch") == 7)
    )
    return records.withColumn("poll_batch", F.expr("arrival_seq div 500")).withColumn(
        "offset", F.when(rewound, F.col("offset") - 300).otherwise(F.col("offset"))
    )


def requested(polls: DataFrame) -> DataFrame:
    """Every fourth poll asks to commit what it has read; not in the last partition."""
    return (
        polls.filter((F.col("partition") < PARTITIONS - 1) & (F.col("poll_batch") % 4 == 2))
        .groupBy(*model.TP, "poll_batch").agg((F.max("offset") + 1).alias("offset"))
    )


def acknowledged(polls: DataFrame) -> DataFrame:
    """The requests, committed one poll later."""
    return requested(polls).withColumn("poll_batch", F.col("poll_batch") + 1)


STREAM = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string, arrival_seq bigint"
APPENDS = 4


def ordered_stream_path(spark: SparkSession, sf_dir: str) -> str:
    """The event log as a folder filled by successive appends in arrival order.

    The file source reads files by modification time, and an append keeps a
    topic-partition in one file, so a stream over this folder gets each
    topic-partition in order wherever micro-batches are cut. There are ``APPENDS``
    of them, whatever the size. The last one holds a tick per topic-partition, a
    day after the last event.
    """

    def build(path: str) -> None:
        records = event_log(spark, sf_dir).select(*model.TP, "offset", "timestamp", "value", "arrival_seq")
        last, latest = records.agg(F.max("arrival_seq"), F.max("timestamp")).first()
        step = last // APPENDS + 1
        for i in range(APPENDS):
            part = records.filter(
                (F.col("arrival_seq") >= i * step) & (F.col("arrival_seq") < (i + 1) * step)
            )
            part.repartition(*model.TP).write.mode("append").parquet(path)
        ticks = partitions(spark, sf_dir).select(
            *model.TP,
            F.lit(None).cast("bigint").alias("offset"),
            F.lit(latest + datetime.timedelta(days=1)).cast("timestamp_ntz").alias("timestamp"),
            F.lit(None).cast("string").alias("value"),
            F.lit(last + 1).cast("bigint").alias("arrival_seq"),
        )
        ticks.write.mode("append").parquet(path)

    return _once(spark, sf_dir, "ordered-stream", build)


def ordered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ordered_stream_path(spark, sf_dir)
    return spark.readStream.schema(STREAM).option("maxBytesPerTrigger", 8 << 30).parquet(path)


TXN_STREAM = "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, value string, txn_id bigint"
DECISIONS = "txn_id bigint, status string"


def late_decision(txn_id: str = "txn_id"):
    """Transactions that are decided only after all records have arrived."""
    return (F.col(txn_id) % 11 == 7) & (F.col(txn_id) > 20)


def transactional_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The transactional log as a stream in arrival order, and the stream of its decisions.

    Decisions arrive in one file more than there are appends of records: those of
    ``late_decision`` come last, when no records arrive any more.
    """

    def build(path: str) -> None:
        records, transactions = transactional_log(spark, sf_dir)
        last = records.agg(F.max("arrival_seq")).first()[0]
        step = last // APPENDS + 1
        columns = [*model.TP, "offset", "timestamp", "key", "value", "txn_id"]
        for i in range(APPENDS):
            own = F.expr(f"arrival_seq div {step}") == i
            records.filter(own).select(*columns).repartition(*model.TP).write.mode("append").parquet(f"{path}/records")
        late = late_decision()
        for i in range(APPENDS + 1):
            when = F.expr(f"txn_id * 100 div {step}") == i
            part = transactions.filter(late if i == APPENDS else when & ~late)
            part.select("txn_id", "status").coalesce(1).write.mode("append").parquet(f"{path}/decisions")

    path = _once(spark, sf_dir, "transactional-stream", build)
    files = len(spark.read.schema(TXN_STREAM).parquet(f"{path}/records").inputFiles())
    records = spark.readStream.schema(TXN_STREAM).option("maxFilesPerTrigger", max(1, files // APPENDS)).parquet(f"{path}/records")
    decisions = spark.readStream.schema(DECISIONS).option("maxFilesPerTrigger", 1).parquet(f"{path}/decisions")
    return records, decisions


def _log_table(
    spark: SparkSession, sf_dir: str, name: str, records: Callable[[], DataFrame], declared: dict[str, int] | None = None
) -> LogTable:
    """Records as a log table that grew by ``APPENDS`` appends, in the order of offsets."""

    def build(path: str) -> None:
        made, all_records = LogTable(spark, path), records()
        step = (all_records.agg(F.max("offset")).first()[0] or 0) // APPENDS + 1
        if declared:
            made.declare(partition_table(spark, declared), "declared")
        for i in range(APPENDS):
            made.append(all_records.filter(F.expr(f"offset div {step}") == i), str(i))

    return LogTable(spark, _once(spark, sf_dir, name, build))


def event_table(spark: SparkSession, sf_dir: str) -> LogTable:
    """The event log as a log table."""
    return _log_table(spark, sf_dir, "event-table", lambda: event_log(spark, sf_dir))


def jittered_table(spark: SparkSession, sf_dir: str) -> LogTable:
    return _log_table(spark, sf_dir, "jittered-table", lambda: jittered_log(spark, sf_dir))


def retained_table(spark: SparkSession, sf_dir: str) -> LogTable:
    """The event log after retention removed the first days of January."""
    late = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    return _log_table(spark, sf_dir, "retained-table", lambda: event_log(spark, sf_dir).filter(F.col("timestamp") >= late))


def declared_table(spark: SparkSession, sf_dir: str) -> LogTable:
    """The event log with two more partitions of a topic, and a topic, that hold no record yet."""
    declared = {"ev-signup": PARTITIONS + 2, "ev-silent": 2}
    return _log_table(spark, sf_dir, "declared-table", lambda: event_log(spark, sf_dir), declared)


def run_dir(spark: SparkSession, name: str) -> str:
    return new_dir(spark, name)
