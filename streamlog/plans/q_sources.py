"""Queries: sources and subscriptions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import context
from streamlog.operators import meta
from streamlog.plans import fixtures as fx
from streamlog.plans.oracle_log import (
    COMMITS, ENDS, JITTERED, ORDER_LOG, TP, TXN, on_log,
)
from streamlog.plans.registry import query
from streamlog.sources import log, partitioned, source, subs
from streamlog.streaming import committed, txn

PLAIN = [*model.TP, "offset", "timestamp", "key", "value"]
PLAIN_SQL = f'{TP}, "offset", "timestamp", "key", value'
EVERYTHING = subs.topic_pattern(".*")


def ctx_columns() -> list:
    return ["ctx.group_id", F.col("ctx.offset").alias("ctx_offset"), "ctx.metadata"]



def stream_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end of its input and return what it wrote."""
    spark = stream.sparkSession
    path = fx.run_dir(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/data")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.read_stream(spark, fx.event_log_path(spark, sf_dir))


@query("a01_plain_source", on_log(f"SELECT {PLAIN_SQL} FROM log WHERE topic IN ('ev-click', 'ev-view')"))
def _(spark, sf):
    return source.plain(fx.event_log(spark, sf), subs.topics("ev-click", "ev-view")).select(*PLAIN)


@query("a01_plain_source_stream", on_log(f"SELECT {PLAIN_SQL} FROM log WHERE topic IN ('ev-click', 'ev-view')"))
def _(spark, sf):
    records = source.plain(event_stream(spark, sf), subs.topics("ev-click", "ev-view"))
    return stream_to_table(records.select(*PLAIN), "a01")


@query("a01_plain_source_orders", f"WITH {ORDER_LOG} SELECT {PLAIN_SQL} FROM olog")
def _(spark, sf):
    return source.plain(fx.order_log(spark, sf), subs.topic_pattern("ord-.")).select(*PLAIN)


@query(
    "a02_committable_source",
    on_log(f"SELECT {PLAIN_SQL}, 'g1' AS group_id, \"offset\" AS ctx_offset, '' AS metadata FROM log WHERE topic = 'ev-click'"),
)
def _(spark, sf):
    records = source.committable(fx.event_log(spark, sf), subs.topics("ev-click"), "g1")
    return records.select(*PLAIN, *ctx_columns())


@query(
    "a02_committable_source_stream",
    on_log(f"SELECT {PLAIN_SQL}, 'g1' AS group_id, \"offset\" AS ctx_offset, '' AS metadata FROM log WHERE topic = 'ev-click'"),
)
def _(spark, sf):
    records = source.committable(event_stream(spark, sf), subs.topics("ev-click"), "g1")
    return stream_to_table(records.select(*PLAIN, *ctx_columns()), "a02")


@query(
    "a03_commit_with_metadata",
    on_log(f"SELECT {TP}, 'g1' AS group_id, \"offset\" AS ctx_offset, 'at-' || arrival_seq AS metadata FROM log"),
)
def _(spark, sf):
    text = F.concat(F.lit("at-"), F.col("arrival_seq").cast("string"))
    records = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1", metadata=text)
    return records.select(*model.TP, *ctx_columns())


@query(
    "a04_source_with_offset_context",
    on_log(f"SELECT upper(value) AS value, {TP}, 'g1' AS group_id, \"offset\" AS ctx_offset, '' AS metadata FROM log"),
)
def _(spark, sf):
    pairs = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1")
    mapped = context.map_data(pairs, F.upper("value").alias("value"))
    return mapped.select("value", "ctx.topic", "ctx.partition", *ctx_columns())


@query(
    "a06_plain_partitioned",
    on_log(f"""SELECT {TP}, count(*) AS records, min("timestamp") AS first_ts, max("timestamp") AS last_ts,
      arg_min(value, "offset") AS first_value, arg_max(value, "offset") AS last_value FROM log GROUP BY ALL"""),
)
def _(spark, sf):
    return partitioned.summarise(
        fx.event_log(spark, sf),
        F.count(F.lit(1)).alias("records"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.min_by("value", "offset").alias("first_value"),
        F.max_by("value", "offset").alias("last_value"),
    )


@query(
    "a06_plain_partitioned_numbered",
    on_log(f"""SELECT {TP}, "offset", row_number() OVER (PARTITION BY {TP} ORDER BY "offset") AS position FROM log"""),
)
def _(spark, sf):
    return partitioned.numbered(fx.event_log(spark, sf)).select(*model.TP, "offset", "position")


@query(
    "a06_plain_partitioned_user_code",
    on_log(f"""SELECT {TP}, "offset", length(value)::BIGINT AS n_chars FROM log"""),
)
def _(spark, sf):
    def user_code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            assert frame["offset"].is_monotonic_increasing
            yield frame[["topic", "partition", "offset"]].assign(n_chars=frame["value"].str.len())

    records = fx.event_log(spark, sf).select(*model.TP, "offset", "value")
    return partitioned.apply_per_partition(
        records, user_code, "topic string, partition int, offset bigint, n_chars bigint"
    )


EXTERNAL_SQL = f"""FROM log LEFT JOIN ends USING ({TP})
  WHERE "offset" >= CASE WHEN "partition" < 3 THEN end_offset // 3 ELSE 0 END"""


def external_store(spark, sf):
    """Offsets kept outside the log: a third of each partition but the last."""
    return (
        fx.ends(spark, sf)
        .filter(F.col("partition") < fx.PARTITIONS - 1)
        .select(*model.TP, F.floor(F.col("end_offset") / 3).alias("offset"))
    )


@query("a07_manual_offset_source", on_log(f'SELECT {TP}, "offset", "key", value {EXTERNAL_SQL}', ENDS))
def _(spark, sf):
    records = partitioned.from_offset_table(fx.event_table(spark, sf), external_store(spark, sf))
    return records.select(*model.TP, "offset", "key", "value")


@query(
    "a08_committable_manual_offset_source",
    on_log(f"""SELECT {TP}, 'g2' AS group_id, "offset" AS ctx_offset, '' AS metadata {EXTERNAL_SQL}""", ENDS),
)
def _(spark, sf):
    records = partitioned.committable_from_offset_table(
        fx.event_table(spark, sf), external_store(spark, sf), "g2"
    )
    return records.select(*model.TP, *ctx_columns())


@query(
    "a09_committable_partitioned",
    on_log(f"""SELECT {TP}, row_number() OVER (PARTITION BY {TP} ORDER BY "offset") AS position,
      'g1' AS group_id, "offset" AS ctx_offset, '' AS metadata FROM log"""),
)
def _(spark, sf):
    records = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1")
    return partitioned.numbered(records).select(*model.TP, "position", *ctx_columns())


@query(
    "a10_metadata_partitioned",
    on_log(f"""SELECT {TP}, count(*) AS records, 'g1' AS group_id, max("offset") AS ctx_offset,
      arg_max("key", "offset") AS metadata FROM log GROUP BY {TP}"""),
)
def _(spark, sf):
    records = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1", metadata=F.col("key"))
    return partitioned.summarise(
        records, F.count(F.lit(1)).alias("records"), F.max_by("ctx", "offset").alias("ctx")
    ).select(*model.TP, "records", *ctx_columns())


def named_assignments(spark, sf):
    """Two readers over the even and odd partitions, and one over all clicks."""
    name = F.when(F.col("partition") % 2 == 0, "even").otherwise("odd")
    names = F.when(F.col("topic") == "ev-click", F.array(name, F.lit("clicks"))).otherwise(F.array(name))
    return fx.partitions(spark, sf).select(*model.TP, F.explode(names).alias("assignment"))


NAMED = f"""named AS (SELECT DISTINCT {TP}, CASE WHEN "partition" % 2 = 0 THEN 'even' ELSE 'odd' END AS assignment FROM log
  UNION ALL SELECT DISTINCT {TP}, 'clicks' FROM log WHERE topic = 'ev-click')"""


@query("a11_shared_assignments", on_log(f'SELECT assignment, {TP}, "offset", "key" FROM log JOIN named USING ({TP})', NAMED))
def _(spark, sf):
    records = source.shared_assignments(fx.event_table(spark, sf), named_assignments(spark, sf))
    return records.select("assignment", *model.TP, "offset", "key")


@query(
    "a12_committable_shared",
    on_log(f"""SELECT assignment, {TP}, 'shared' AS group_id, "offset" AS ctx_offset, '' AS metadata
      FROM log JOIN named USING ({TP})""", NAMED),
)
def _(spark, sf):
    records = source.committable_shared(
        fx.event_table(spark, sf), named_assignments(spark, sf), "shared"
    )
    return records.select("assignment", *model.TP, *ctx_columns())


COMMITTED_TXN = "txn_id IS NULL OR txn_id % 7 <> 3"


@query(
    "a13_transactional_source",
    on_log(f"""SELECT {TP}, "offset", value, 'txg' AS group_id, "offset" AS ctx_offset, '' AS metadata
      FROM txn_log WHERE topic LIKE 'ev-%' AND ({COMMITTED_TXN})""", TXN),
)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    read = txn.source(records, subs.topic_pattern("ev-.*"), "txg", transactions)
    return read.select(*model.TP, "offset", "value", *ctx_columns())


@query(
    "a14_transactional_with_context",
    on_log(f"""SELECT length(value)::INTEGER AS n_chars, {TP}, 'txg' AS group_id, "offset" AS ctx_offset,
      "key" AS metadata FROM txn_log WHERE {COMMITTED_TXN}""", TXN),
)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    read = txn.source(records, EVERYTHING, "txg", transactions, metadata=F.col("key"))
    mapped = context.map_data(read, F.length("value").alias("n_chars"))
    return mapped.select("n_chars", "ctx.topic", "ctx.partition", *ctx_columns())


@query(
    "a15_transactional_partitioned",
    on_log(f"""SELECT {TP}, count(*) AS records, min("offset") AS first_offset, max("offset") AS last_offset
      FROM txn_log WHERE {COMMITTED_TXN} GROUP BY ALL""", TXN),
)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    return partitioned.summarise(
        txn.source(records, EVERYTHING, "txg", transactions),
        F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def committed_stream(spark: SparkSession, sf: str, read) -> DataFrame:
    """What ``read`` makes of the committed records of a stream, micro-batch by micro-batch."""
    path = fx.run_dir(spark, "committed")
    records, decisions = fx.transactional_stream(spark, sf)

    def sink(batch: DataFrame, batch_id: int) -> None:
        read(batch).write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    query = committed.flow(
        records, decisions, sink, f"{path}/pending", f"{path}/checkpoint", trigger={"availableNow": True}
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/data").drop("batch_id")


@query(
    "a13_transactional_source_stream",
    on_log(f"""SELECT {TP}, "offset", value, 'txg' AS group_id, "offset" AS ctx_offset, '' AS metadata
      FROM txn_log WHERE topic LIKE 'ev-%' AND ({COMMITTED_TXN})""", TXN),
)
def _(spark, sf):
    def read(batch):
        pairs = txn.source(batch, subs.topic_pattern("ev-.*"), "txg")
        return pairs.select(*model.TP, "offset", "value", *ctx_columns())

    return committed_stream(spark, sf, read)


@query(
    "a15_transactional_partitioned_stream",
    on_log(f"""SELECT {TP}, count(*) AS records, min("offset") AS first_offset, max("offset") AS last_offset
      FROM txn_log WHERE {COMMITTED_TXN} GROUP BY ALL""", TXN),
)
def _(spark, sf):
    """Sub-streams of a micro-batch are summed up, then those of all micro-batches."""
    def read(batch):
        return partitioned.summarise(
            txn.source(batch, EVERYTHING, "txg"),
            F.count(F.lit(1)).alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"),
        )

    return partitioned.summarise(
        committed_stream(spark, sf, read), F.sum("n").alias("records"),
        F.min("low").alias("first_offset"), F.max("high").alias("last_offset"),
    )


@query("a16_read_committed", on_log(f'SELECT {TP}, "offset", coalesce(txn_id, -1) AS txn_id FROM txn_log WHERE {COMMITTED_TXN}', TXN))
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    txn_id = F.coalesce("txn_id", F.lit(-1)).alias("txn_id")
    return txn.read_committed(records, transactions).select(*model.TP, "offset", txn_id)


OPEN_TXN = f"""stops AS (SELECT {TP}, min("offset") AS stop FROM txn_log WHERE txn_id % 11 = 7 AND txn_id > 20 GROUP BY ALL)"""


@query(
    "a16_read_committed_open",
    on_log(f"""SELECT l.topic, l."partition", l."offset", coalesce(txn_id, -1) AS txn_id
      FROM txn_log l LEFT JOIN stops s ON l.topic = s.topic AND l."partition" = s."partition"
      WHERE ({COMMITTED_TXN}) AND (stop IS NULL OR l."offset" < stop)""", TXN, OPEN_TXN),
)
def _(spark, sf):
    """Some later transactions are still open: no topic-partition is read past its first one."""
    records, transactions = fx.transactional_log(spark, sf)
    decided = transactions.filter(~((F.col("txn_id") % 11 == 7) & (F.col("txn_id") > 20)))
    txn_id = F.coalesce("txn_id", F.lit(-1)).alias("txn_id")
    return txn.read_committed(records, decided).select(*model.TP, "offset", txn_id)


@query("a17_topics", on_log(f"SELECT {PLAIN_SQL} FROM log WHERE topic IN ('ev-error', 'ev-signup')"))
def _(spark, sf):
    return subs.select(fx.event_log(spark, sf), subs.topics("ev-error", "ev-signup")).select(*PLAIN)


@query("a18_topic_pattern", on_log(f"SELECT {PLAIN_SQL} FROM log WHERE regexp_full_match(topic, 'ev-[a-z]*i[a-z]*')"))
def _(spark, sf):
    return subs.select(fx.event_log(spark, sf), subs.topic_pattern("ev-[a-z]*i[a-z]*")).select(*PLAIN)


@query("a18_topic_pattern_stream", on_log(f"SELECT {PLAIN_SQL} FROM log WHERE regexp_full_match(topic, 'ev-(click|view)')"))
def _(spark, sf):
    records = subs.select(event_stream(spark, sf), subs.topic_pattern("ev-(click|view)"))
    return stream_to_table(records.select(*PLAIN), "a18")


CHOSEN = (("ev-click", 0), ("ev-click", 2), ("ev-view", 1))
IS_CHOSEN = f"({TP}) IN (('ev-click', 0), ('ev-click', 2), ('ev-view', 1))"


@query("a19_assignment", on_log(f"SELECT {PLAIN_SQL} FROM log WHERE {IS_CHOSEN}"))
def _(spark, sf):
    return subs.select(fx.event_log(spark, sf), subs.assignment(*CHOSEN)).select(*PLAIN)


FROM_OFFSETS = {("ev-click", 0): 100, ("ev-click", 2): 0, ("ev-view", 1): 250, ("ev-view", 3): 10_000_000}
FROM_OFFSETS_SQL = f"""SELECT {PLAIN_SQL} FROM log WHERE (topic = 'ev-click' AND "partition" = 0 AND "offset" >= 100)
  OR (topic = 'ev-click' AND "partition" = 2) OR (topic = 'ev-view' AND "partition" = 1 AND "offset" >= 250)
  OR (topic = 'ev-view' AND "partition" = 3 AND "offset" >= 10000000)"""


@query("a20_assignment_with_offset", on_log(FROM_OFFSETS_SQL))
def _(spark, sf):
    sub = subs.assignment_with_offset(FROM_OFFSETS)
    return subs.select(fx.event_table(spark, sf), sub).select(*PLAIN)


@query("a20_assignment_with_offset_stream", on_log(FROM_OFFSETS_SQL))
def _(spark, sf):
    sub = subs.assignment_with_offset(FROM_OFFSETS)
    return stream_to_table(subs.select(event_stream(spark, sf), sub).select(*PLAIN), "a20")


FROM_TIMES = {
    ("ev-click", 0): "2024-01-20 00:00:00",
    ("ev-click", 2): "2024-01-05 12:00:00",
    ("ev-view", 1): "2030-01-01 00:00:00",  # nothing that late: falls back to the commit
    ("ev-view", 3): "2030-01-01 00:00:00",  # no commit either: the reset policy
}
FROM_TIMES_SQL = on_log(
    f"""SELECT {PLAIN_SQL} FROM jittered JOIN (
      SELECT {TP}, coalesce(min(CASE WHEN "timestamp" >= t0 THEN "offset" END),
        any_value(committed), 0) AS start FROM jittered
      JOIN (VALUES ('ev-click', 0, TIMESTAMP '2024-01-20'), ('ev-click', 2, TIMESTAMP '2024-01-05 12:00:00'),
        ('ev-view', 1, TIMESTAMP '2030-01-01'), ('ev-view', 3, TIMESTAMP '2030-01-01'))
        AS times(topic, "partition", t0) USING ({TP})
      LEFT JOIN (SELECT {TP}, "offset" AS committed FROM commits WHERE commit_seq = 2) USING ({TP})
      GROUP BY ALL) USING ({TP}) WHERE "offset" >= start""",
    JITTERED, COMMITS,
)


@query("a21_offsets_for_times", FROM_TIMES_SQL)
def _(spark, sf):
    committed = meta.latest_commits(fx.commits(spark, sf))
    sub = subs.assignment_offsets_for_times(FROM_TIMES)
    return subs.select(fx.jittered_table(spark, sf), sub, committed=committed).select(*PLAIN)


def _resolve_sql(fallback: str) -> str:
    return on_log(
        f"""SELECT {TP}, coalesce(explicit, committed, {fallback}) AS start FROM ends
        LEFT JOIN (SELECT {TP}, end_offset - 10 AS explicit FROM ends WHERE topic = 'ev-view') USING ({TP})
        LEFT JOIN (SELECT {TP}, "offset" AS committed FROM commits WHERE commit_seq = 2) USING ({TP})""",
        COMMITS,
    )


def _resolved(spark, sf, reset):
    ranges = meta.offset_range(fx.event_table(spark, sf))
    explicit = F.when(F.col("topic") == "ev-view", F.col("end_offset") - 10)
    return subs.resolve_start(
        ranges.withColumn("wanted", explicit),
        meta.latest_commits(fx.commits(spark, sf)), reset=reset, explicit="wanted",
    )


@query("a22_resolve_start_earliest", _resolve_sql("0"))
def _(spark, sf):
    return _resolved(spark, sf, "earliest")


@query("a22_resolve_start_latest", _resolve_sql("end_offset"))
def _(spark, sf):
    return _resolved(spark, sf, "latest")


def _group_sql(group: str) -> str:
    return on_log(
        f"""SELECT {TP}, "offset", value FROM log LEFT JOIN (SELECT {TP}, "offset" AS committed FROM commits
        WHERE commit_seq = 2 AND group_id = '{group}') USING ({TP}) WHERE "offset" >= coalesce(committed, 0)""",
        COMMITS,
    )


@query("a23_resume_group", _group_sql("g1"))
def _(spark, sf):
    records = source.for_group(fx.event_table(spark, sf), fx.commits(spark, sf), "g1")
    return records.select(*model.TP, "offset", "value")


@query("a23_resume_other_group", _group_sql("g9"))
def _(spark, sf):
    records = source.for_group(fx.event_log(spark, sf), fx.commits(spark, sf), "g9")
    return records.select(*model.TP, "offset", "value")
