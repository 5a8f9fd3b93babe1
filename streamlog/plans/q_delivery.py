"""Queries: sinks and delivery rules, run as streams over the event log.

Each query runs a stream to its end, where stated with a failure on the way, and
returns what the sink holds afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog import model
from streamlog.functions import envelope
from streamlog.operators import meta
from streamlog.plans import fixtures as fx
from streamlog.plans.oracle_log import TP, TXN, on_log
from streamlog.plans.q_sources import EVERYTHING, event_stream
from streamlog.plans.registry import query
from streamlog.sources import log, source, subs
from streamlog.sources.table import LogTable
from streamlog.streaming import committed, control, delivery, sink, txn
from streamlog.streaming.frontier import Frontier
from streamlog.streaming.store import OutputLog

AVAILABLE = {"availableNow": True}


class Outage(RuntimeError):
    pass


def fail_once(batch_id: int) -> Callable[[int], None]:
    """A hook that fails the first time it sees ``batch_id`` (or the only batch)."""
    failed: list[int] = []

    def hook(current: int) -> None:
        if current == batch_id and not failed:
            failed.append(current)
            raise Outage(f"batch {current}")

    return hook


def run_through(start: Callable[[], StreamingQuery]) -> None:
    """Run a stream to the end, starting it again after an injected outage."""
    for _ in range(3):
        try:
            control.run_to_end(start())
            return
        except StreamingQueryException as failure:
            if "Outage" not in str(failure):
                raise
    raise RuntimeError("stream did not recover")


def slices(spark: SparkSession, sf: str) -> DataFrame:
    """The event log as a stream of about four micro-batches."""
    files = len(fx.event_log(spark, sf).inputFiles())
    path = fx.event_log_path(spark, sf)
    return log.read_stream(spark, path, maxFilesPerTrigger=max(1, files // 4))


def copy(value: Column | None = None) -> Column:
    """One record per input record, to a copy of its topic and the same partition."""
    return envelope.record(
        F.concat(F.lit("copy-"), F.col("topic")),
        F.col("value") if value is None else value,
        key=F.col("key"), partition=F.col("partition"), timestamp=F.col("timestamp"),
    )


def copies(stream: DataFrame, group: str = "g1") -> DataFrame:
    pairs = source.committable(stream, EVERYTHING, group)
    return pairs.withColumn("records", envelope.single(copy())).select("records", "ctx")


COPIED = on_log(f"""SELECT 'copy-' || topic AS topic, "partition", "key", value FROM log""")
PER_PARTITION = on_log(
    f"""SELECT 'copy-' || topic AS topic, "partition", count(*) AS records, count(*) AS distinct_offsets,
      max("offset") AS last_offset, sum(kn)::BIGINT AS total FROM log GROUP BY topic, "partition" """
)


def per_partition(records: DataFrame) -> DataFrame:
    return records.groupBy(*model.TP).agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("offset").alias("distinct_offsets"),
        F.max("offset").alias("last_offset"),
        F.sum(fx.k_of()).alias("total"),
    )


@query(
    "a05_at_most_once",
    on_log(f"""SELECT {TP}, count(*) AS sent, true AS some_lost, true AS most_received, 1::BIGINT AS most_copies,
      max("offset") + 1 AS committed FROM log GROUP BY {TP}"""),
)
def _(spark, sf):
    """The sink fails once after the commit: that micro-batch is lost, nothing else is, and nothing is doubled."""
    root = fx.run_dir(spark, "a05")
    outage = fail_once(1)
    append = delivery.append_records(f"{root}/data")
    front = Frontier(spark, f"{root}/commits")

    def fragile(batch, batch_id):
        outage(batch_id)
        append(batch.select(*model.TP, "offset", "value"), batch_id)

    records, _ = fx.transactional_stream(spark, sf)
    stream = source.committable(records, EVERYTHING, "g1")
    run_through(
        lambda: delivery.at_most_once(stream, fragile, front.write, front.is_committed, f"{root}/checkpoint", trigger=AVAILABLE)
    )
    got = spark.read.parquet(f"{root}/data").groupBy(*model.TP, "offset").agg(F.count(F.lit(1)).alias("n"))
    received = got.groupBy(*model.TP).agg(F.sum("n").alias("received"), F.max("n").alias("most_copies"))
    done = front.fronts().select(*model.TP, F.col("offset").alias("committed"))
    sent = fx.event_log(spark, sf).groupBy(*model.TP).agg(F.count(F.lit(1)).alias("sent"))
    everywhere = Window.partitionBy(F.lit(1))  # one row per topic-partition
    lost = F.sum(F.col("sent") - F.coalesce("received", F.lit(0))).over(everywhere)
    return sent.join(received, model.TP, "left").join(done, model.TP, "left").select(
        *model.TP, "sent", (lost > 0).alias("some_lost"), (lost * 2 < F.sum("sent").over(everywhere)).alias("most_received"),
        "most_copies", "committed",
    )


@query("b01_plain_sink", on_log(f'SELECT {TP}, "offset", "key", value FROM log'))
def _(spark, sf):
    """The sink's folder is a log with the offsets of the source, as each topic-partition comes in order."""
    root = fx.run_dir(spark, "b01")
    records, _ = fx.transactional_stream(spark, sf)
    table = LogTable(spark, f"{root}/log")
    stream = records.withColumnRenamed("offset", "seq").drop("txn_id", "partition")
    control.run_to_end(sink.plain(stream, table, f"{root}/checkpoint", ["seq"], partitions=fx.PARTITIONS, trigger=AVAILABLE))
    return table.records().select(*model.TP, "offset", "key", "value")


def committable_sink(spark, sf, envelopes, outage=None):
    """Produce, then commit; returns the sink's records and commits."""
    root = fx.run_dir(spark, "b11")
    front = Frontier(spark, f"{root}/commits")

    def commit(batch, batch_id):
        if outage is not None:
            outage(batch_id)
        front.write(batch, batch_id)

    run_through(
        lambda: delivery.at_least_once(
            envelopes, delivery.append_records(f"{root}/data"), commit, f"{root}/checkpoint"
        )
    )
    return spark.read.parquet(f"{root}/data"), front.commits()


@query(
    "b11_committable_sink",
    on_log(f"""SELECT {TP}, count(*) AS sent, true AS complete, max("offset") + 1 AS committed FROM log GROUP BY {TP}"""),
)
def _(spark, sf):
    """Fails once between produce and commit: records may be doubled, never lost."""
    data, committed = committable_sink(spark, sf, copies(slices(spark, sf)), fail_once(1))
    got = data.groupBy(F.expr("substring(topic, 6)").alias("topic"), "partition").agg(
        F.count(F.lit(1)).alias("received")
    )
    sent = fx.event_log(spark, sf).groupBy(*model.TP).agg(F.count(F.lit(1)).alias("sent"))
    done = committed.groupBy(*model.TP).agg(F.max("offset").alias("committed"))
    return sent.join(got, model.TP).join(done, model.TP).select(
        *model.TP, "sent", (F.col("received") >= F.col("sent")).alias("complete"), "committed"
    )


@query("b11_committable_sink_records", COPIED)
def _(spark, sf):
    data, _ = committable_sink(spark, sf, copies(slices(spark, sf)))
    return data.select(*model.TP, "key", "value")


@query(
    "b12_committable_sink_context",
    on_log(f"""SELECT 'g1' AS group_id, {TP}, max("offset") + 1 AS "offset", arg_max("key", "offset") AS metadata FROM log GROUP BY {TP}"""),
)
def _(spark, sf):
    """Every tenth number produces nothing; its offset is committed all the same."""
    pairs = source.committable(event_stream(spark, sf), EVERYTHING, "g1", metadata=F.col("key"))
    out = envelope.route([(fx.k_of() % 10 == 0, envelope.pass_through())], envelope.single(copy()))
    _, committed = committable_sink(spark, sf, txn.with_offset_context(pairs.withColumn("records", out)))
    return meta.latest_commits(committed)


def run_transaction(spark, sf, envelopes, *, outage=None, on_results=None):
    root = fx.run_dir(spark, "txn")
    run_through(
        lambda: txn.flow(
            envelopes, root, "w", f"{root}/checkpoint", trigger=AVAILABLE,
            before_publish=outage, on_results=on_results,
        )
    )
    return OutputLog(spark, root)


@query("b17_transactional_sink", PER_PARTITION)
def _(spark, sf):
    root = fx.run_dir(spark, "b17")
    control.run_to_end(
        txn.sink(copies(slices(spark, sf)), root, "w", f"{root}/checkpoint", trigger=AVAILABLE)
    )
    return per_partition(OutputLog(spark, root).records())


@query(
    "b18_transactional_sink_context",
    on_log(f"""SELECT 'g1' AS group_id, {TP}, max("offset") + 1 AS "offset", arg_max("key", "offset") AS metadata FROM log GROUP BY {TP}"""),
)
def _(spark, sf):
    pairs = source.committable(event_stream(spark, sf), EVERYTHING, "g1", metadata=F.col("key"))
    shaped = txn.with_offset_context(pairs.withColumn("records", envelope.single(copy())))
    return run_transaction(spark, sf, shaped).source_offsets()


@query("b19_transactional_flow", COPIED)
def _(spark, sf):
    """The results of the flow, as they were emitted batch by batch."""
    path = fx.run_dir(spark, "b19")
    run_transaction(
        spark, sf, copies(slices(spark, sf)),
        on_results=lambda placed, _: placed.write.mode("append").parquet(path),
    )
    return spark.read.parquet(path).select(*model.TP, "key", "value")


@query("b20_transactional_flow_context", PER_PARTITION)
def _(spark, sf):
    pairs = source.committable(slices(spark, sf), EVERYTHING, "g1")
    shaped = txn.with_offset_context(pairs.withColumn("records", envelope.single(copy())))
    return per_partition(run_transaction(spark, sf, shaped).records())


@query("g01_exactly_once", COPIED)
def _(spark, sf):
    return run_transaction(spark, sf, copies(slices(spark, sf))).records().select(*model.TP, "key", "value")


@query("g02_abort_and_replay", PER_PARTITION)
def _(spark, sf):
    """Fails once after staging the second transaction; nothing is lost or doubled."""
    out = run_transaction(spark, sf, copies(slices(spark, sf)), outage=fail_once(1))
    return per_partition(out.records())


@query(
    "g03_filtered_in_transaction",
    on_log(f"""SELECT 'records' AS what, 'copy-' || topic AS topic, "partition", count(*) AS n FROM log WHERE kn % 10 <> 0 GROUP BY ALL
      UNION ALL SELECT 'committed', topic, "partition", max("offset") + 1 FROM log GROUP BY ALL"""),
)
def _(spark, sf):
    pairs = source.committable(slices(spark, sf), EVERYTHING, "g1")
    out = envelope.route([(fx.k_of() % 10 == 0, envelope.pass_through())], envelope.single(copy()))
    log_ = run_transaction(spark, sf, pairs.withColumn("records", out).select("records", "ctx"), outage=fail_once(0))
    written = log_.records().groupBy(*model.TP).agg(F.count(F.lit(1)).alias("n"))
    committed = log_.source_offsets().select(*model.TP, F.col("offset").alias("n"))
    return written.select(F.lit("records").alias("what"), "*").unionByName(
        committed.select(F.lit("committed").alias("what"), "*")
    )


@query("g04_several_streams_one_group", PER_PARTITION)
def _(spark, sf):
    """Two transactional streams of one group share the partitions and the output log."""
    root = fx.run_dir(spark, "g04")
    queries = []
    for member in (0, 1):
        mine = slices(spark, sf).filter(F.col("partition") % 2 == member)
        queries.append(
            txn.flow(copies(mine), root, f"m{member}", f"{root}/checkpoint-{member}", trigger=AVAILABLE)
        )
    for running in queries:
        control.run_to_end(running)
    return per_partition(OutputLog(spark, root).records())


@query("g05_external_offsets", PER_PARTITION)
def _(spark, sf):
    """Results and offsets in one store; each start continues from the stored offsets."""
    root = fx.run_dir(spark, "g05")
    out = OutputLog(spark, root)

    def update(batch, _):
        return batch.select(
            F.concat(F.lit("copy-"), "topic").alias("topic"), "partition", "timestamp", "key", "value",
            F.col("offset").alias("seq"),
        )

    def start(name, topics, outage=None):
        stored = delivery.stored_offsets(out, "g5")
        stream = source.plain(event_stream(spark, sf), subs.topic_pattern(topics))
        begin = stored.select(*model.TP, F.col("offset").alias("start"))
        rest = (
            stream.join(begin, model.TP, "left")
            .filter(F.col("start").isNull() | (F.col("offset") >= F.col("start")))
            .drop("start")
        )
        return delivery.external_offsets(
            rest, update, root, name, "g5", f"{root}/checkpoint-{name}", before_publish=outage
        )

    control.run_to_end(start("first", "ev-(click|view)"))
    outage = fail_once(0)
    run_through(lambda: start("second", ".*", outage))
    control.run_to_end(start("third", ".*"))
    return per_partition(out.records())


@query("g06_drain", PER_PARTITION)
def _(spark, sf):
    """A running query is drained: what was read is written and committed, then it stops."""
    root = fx.run_dir(spark, "g06")
    running = txn.flow(
        copies(slices(spark, sf)), root, "w", f"{root}/checkpoint", trigger={"processingTime": "0 seconds"}
    )
    control.drain(running)
    return per_partition(OutputLog(spark, root).records())


@query(
    "g01_transactional_read_process_write",
    on_log(f"""SELECT 'copy-' || topic AS topic, "partition", row_number() OVER (PARTITION BY {TP} ORDER BY "offset") - 1 AS "offset",
      "key", value FROM txn_log WHERE txn_id IS NULL OR txn_id % 7 <> 3""", TXN),
)
def _(spark, sf):
    """Read committed records, copy them exactly once and in order; some decisions come last, and one micro-batch fails."""
    root = fx.run_dir(spark, "g01")
    records, decisions = fx.transactional_stream(spark, sf)
    outage = fail_once(2)

    def process(committed_: DataFrame) -> DataFrame:
        pairs = txn.source(committed_, EVERYTHING, "g1")
        return pairs.withColumn("records", envelope.single(copy())).select("records", "ctx")

    run_through(
        lambda: committed.transactional_flow(
            records, decisions, process, root, "w", f"{root}/checkpoint", trigger=AVAILABLE, before_publish=outage
        )
    )
    return OutputLog(spark, root).records().select(*model.TP, "offset", "key", "value")
