"""Queries: offset batches and commits."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import context
from streamlog.operators import commits, meta
from streamlog.plans import fixtures as fx
from streamlog.plans.oracle_log import (
    ASSIGNMENTS, COMMITTABLES, COMMITTABLES2, TP, on_log,
)
from streamlog.plans.q_sources import EVERYTHING, stream_to_table
from streamlog.plans.registry import query
from streamlog.sources import source
from streamlog.streaming import collect, txn

GTP = f"group_id, {TP}"
MAX_BATCH = 1000

BATCH = f"""SELECT {GTP}, arg_max("offset", arrival_seq) + 1 AS "offset",
  arg_max(metadata, arrival_seq) AS metadata, count(*) AS updates FROM committables GROUP BY {GTP}"""

FLOW = f"""flow AS (SELECT {GTP}, batch, arg_max("offset", arrival_seq) + 1 AS "offset",
    arg_max(metadata, arrival_seq) AS metadata, count(*) AS updates, max(arrival_seq) AS last_seq
  FROM (SELECT *, (row_number() OVER (PARTITION BY group_id ORDER BY arrival_seq) - 1) // {MAX_BATCH} AS batch
    FROM committables) GROUP BY {GTP}, batch)"""

NEXT = f"""next_observed AS (SELECT {GTP}, "offset", metadata,
    lead(arrival_seq) OVER (PARTITION BY {GTP} ORDER BY arrival_seq) AS emit_seq
  FROM (SELECT *, max("offset") OVER (PARTITION BY {GTP} ORDER BY arrival_seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM committables)
  WHERE highest IS NULL OR "offset" > highest)"""

NEXT_COMMITTABLES = (
    COMMITTABLES.replace("committables AS", "all_committables AS")
    + ","
    + NEXT.replace("FROM committables", "FROM all_committables")
    + f""",
committables AS (SELECT {GTP}, "offset", metadata, emit_seq AS arrival_seq FROM next_observed WHERE emit_seq IS NOT NULL)"""
)


def first_batch(spark, sf, *groups):
    return commits.offset_batch(fx.committables(spark, sf, *groups))


@query("c01_offset_batch", on_log(f"SELECT *, (SELECT count(*) FROM committables) AS batch_size FROM ({BATCH})", COMMITTABLES))
def _(spark, sf):
    return commits.with_batch_size(first_batch(spark, sf))


def flow_g1(spark, sf):
    return commits.batch_flow(fx.committables(spark, sf), MAX_BATCH, single=True)


@query(
    "c02_merge_batches",
    on_log(f"""SELECT {GTP}, arg_max("offset", batch) AS "offset", arg_max(metadata, batch) AS metadata,
      sum(updates)::BIGINT AS updates FROM flow GROUP BY {GTP}""", COMMITTABLES, FLOW),
)
def _(spark, sf):
    return commits.merge_batches(flow_g1(spark, sf).withColumn("batch_seq", F.col("batch")))


@query("c03_batch_offsets", on_log(f'SELECT {GTP}, "offset" - 1 AS "offset" FROM ({BATCH})', COMMITTABLES))
def _(spark, sf):
    return commits.offsets(first_batch(spark, sf)).select(*model.GTP, "offset")


@query(
    "c04_filter_batch",
    on_log(f"""SELECT * REPLACE (1::BIGINT AS updates), count(*) OVER () AS batch_size FROM ({BATCH})
      WHERE topic IN ('ev-click', 'ev-view')""", COMMITTABLES),
)
def _(spark, sf):
    kept = commits.filter_batch(first_batch(spark, sf), F.col("topic").isin("ev-click", "ev-view"))
    return commits.with_batch_size(kept)


@query("c05_batch_flow", on_log("SELECT * FROM flow", COMMITTABLES, FLOW))
def _(spark, sf):
    return flow_g1(spark, sf)


# Chunks of 64 rows, so that the given tables cross many chunk edges.
SMALL_CHUNKS = 6


@query("c05_batch_flow_small_chunks", on_log("SELECT * FROM flow", COMMITTABLES, FLOW))
def _(spark, sf):
    return commits.batch_flow(fx.committables(spark, sf), MAX_BATCH, single=True, chunk_bits=SMALL_CHUNKS)


SIZED = """sized AS (SELECT *, 1 + arrival_seq % 3 AS size,
  row_number() OVER (PARTITION BY topic ORDER BY arrival_seq) AS rn FROM committables)"""

SIZED_FLOW = on_log(
    f"""SELECT {GTP}, batch, arg_max("offset", arrival_seq) + 1 AS "offset",
      arg_max(metadata, arrival_seq) AS metadata, sum(size)::BIGINT AS updates, max(arrival_seq) AS last_seq
    FROM sized JOIN fold USING (topic, rn) GROUP BY {GTP}, batch""",
    COMMITTABLES, SIZED,
    """fold AS (SELECT topic, rn, 0::BIGINT AS batch, size AS held FROM sized WHERE rn = 1
      UNION ALL SELECT s.topic, s.rn, CASE WHEN f.held >= 100 THEN f.batch + 1 ELSE f.batch END,
        CASE WHEN f.held >= 100 THEN s.size ELSE f.held + s.size END
      FROM fold f JOIN sized s ON s.topic = f.topic AND s.rn = f.rn + 1)""",
    recursive=True,
)


def sized_committables(spark, sf):
    return fx.committables(spark, sf).withColumn("batch_size", 1 + F.col("arrival_seq") % 3)


@query("c05_batch_flow_sized", SIZED_FLOW)
def _(spark, sf):
    return commits.batch_flow(sized_committables(spark, sf), 100, stream=["topic"])


@query("c05_batch_flow_sized_small_chunks", SIZED_FLOW)
def _(spark, sf):
    return commits.batch_flow(sized_committables(spark, sf), 100, stream=["topic"], chunk_bits=SMALL_CHUNKS)


def commit_stream(spark, sf):
    """Committables as a stream, ticks included."""
    return fx.ordered_stream(spark, sf).select(
        F.lit("g1").alias("group_id"), *model.TP, "offset",
        F.concat(F.lit("m"), F.col("arrival_seq").cast("string")).alias("metadata"),
        "arrival_seq", "timestamp", F.lit(1).cast("bigint").alias("batch_size"),
    )


STREAM_KEY = ["group_id", *model.TP]
IN_ORDER = f"""committables AS (SELECT 'g1' AS group_id, {TP}, "offset", "timestamp", 'm' || arrival_seq AS metadata,
  arrival_seq, row_number() OVER (PARTITION BY {TP} ORDER BY arrival_seq) AS rn FROM log)"""

# Per topic-partition: collect up to n records, or until a timer of one day runs out.
# started/held describe the state after a record; expired = whole intervals since started.
DAY = 86_400_000_000


def timed_fold(n: int) -> str:
    expired = f'((epoch_us(c."timestamp") - f.started) // {DAY})'
    batch_now = f"(f.batch + CASE WHEN {expired} > 0 AND f.held > 0 THEN 1 ELSE 0 END)"
    held_now = f"(CASE WHEN {expired} > 0 THEN 0 ELSE f.held END + 1)"
    return f"""fold AS (
  SELECT {TP}, rn, 0::BIGINT AS batch, 1::BIGINT AS held, epoch_us("timestamp") AS started, 0::BIGINT AS in_batch
  FROM committables WHERE rn = 1
  UNION ALL
  SELECT c.topic, c."partition", c.rn,
    {batch_now} + CASE WHEN {held_now} >= {n} THEN 1 ELSE 0 END,
    CASE WHEN {held_now} >= {n} THEN 0 ELSE {held_now} END,
    CASE WHEN {held_now} >= {n} THEN epoch_us(c."timestamp") ELSE f.started + {expired} * {DAY} END,
    {batch_now}
  FROM fold f JOIN committables c ON c.topic = f.topic AND c."partition" = f."partition" AND c.rn = f.rn + 1),
closed AS (SELECT c.*, in_batch, count(*) OVER (PARTITION BY c.topic, c."partition", in_batch) AS size
  FROM fold f JOIN committables c USING ({TP}, rn))"""


@query(
    "c05_batch_flow_stream",
    on_log(f"""SELECT {GTP}, batch, max("offset") + 1 AS "offset", arg_max(metadata, "offset") AS metadata,
      count(*) AS updates, max(arrival_seq) AS last_seq, 'size' AS closed_by
      FROM (SELECT *, (rn - 1) // 50 AS batch FROM committables) GROUP BY {GTP}, batch HAVING count(*) = 50""",
      IN_ORDER),
)
def _(spark, sf):
    """Only full batches: a stream without an interval keeps its open batch."""
    batches = collect.commit_batches(commit_stream(spark, sf), 50, stream=STREAM_KEY)
    return stream_to_table(batches, "c05")


@query(
    "c06_batch_flow_interval",
    on_log(f"""SELECT {GTP}, in_batch AS batch, max("offset") + 1 AS "offset", arg_max(metadata, "offset") AS metadata,
      count(*) AS updates, max(arrival_seq) AS last_seq,
      CASE WHEN count(*) >= 20 THEN 'size' ELSE 'interval' END AS closed_by FROM closed GROUP BY {GTP}, in_batch""",
      IN_ORDER, timed_fold(20), recursive=True),
)
def _(spark, sf):
    batches = collect.commit_batches(
        commit_stream(spark, sf), 20, datetime.timedelta(days=1), stream=STREAM_KEY
    )
    return stream_to_table(batches, "c06")


@query(
    "c07_flow",
    on_log("""SELECT group_id, batch, sum(updates)::BIGINT AS batch_size, count(*) AS partitions,
      max(last_seq) AS last_seq FROM flow GROUP BY group_id, batch""", COMMITTABLES, FLOW),
)
def _(spark, sf):
    return commits.flow(flow_g1(spark, sf))


@query(
    "c08_commit_sink",
    on_log(f"""SELECT {GTP}, arg_max("offset", last_seq) AS "offset", arg_max(metadata, last_seq) AS metadata
      FROM flow GROUP BY {GTP}""", COMMITTABLES, FLOW),
)
def _(spark, sf):
    path = fx.run_dir(spark, "c08")
    commits.sink(flow_g1(spark, sf), path)
    return meta.latest_commits(spark.read.parquet(path))


@query(
    "c09_flow_with_context",
    on_log(f"""SELECT {GTP}, batch, max("offset") + 1 AS "offset", arg_max("key", "offset") AS metadata,
      count(*) AS updates, max(arrival_seq) AS last_seq FROM (SELECT *, 'g1' AS group_id,
        (row_number() OVER (ORDER BY arrival_seq) - 1) // {MAX_BATCH} AS batch FROM log) GROUP BY {GTP}, batch"""),
)
def _(spark, sf):
    pairs = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1", metadata=F.col("key"))
    return commits.batch_flow(context.committables(pairs, seq="arrival_seq"), MAX_BATCH, single=True)


@query("c10_offset_first_observed", on_log("SELECT * FROM flow WHERE group_id = 'g1'", COMMITTABLES, FLOW.replace(str(MAX_BATCH), "250")))
def _(spark, sf):
    return commits.batch_flow(fx.committables(spark, sf), 250, when="first_observed", single=True)


@query(
    "c11_next_observed",
    on_log(f'SELECT {GTP}, "offset", metadata, emit_seq AS arrival_seq FROM next_observed WHERE emit_seq IS NOT NULL', COMMITTABLES, NEXT),
)
def _(spark, sf):
    return commits.next_observed(fx.committables(spark, sf)).drop("batch_size")


@query(
    "c11_next_observed_sized",
    on_log(f"""SELECT {GTP}, lag("offset") OVER w AS "offset", lag(metadata) OVER w AS metadata, arrival_seq, 1::BIGINT AS batch_size
      FROM (SELECT * FROM (SELECT *, max("offset") OVER (PARTITION BY {GTP} ORDER BY arrival_seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM (SELECT * REPLACE ("offset" // 3 AS "offset") FROM committables))
        WHERE highest IS NULL OR "offset" >= highest)
      WINDOW w AS (PARTITION BY {GTP} ORDER BY arrival_seq) QUALIFY lag("offset") OVER w IS NOT NULL""", COMMITTABLES),
)
def _(spark, sf):
    """Batches of size 3 as input: an equal offset hands over, too."""
    batches = fx.committables(spark, sf).withColumn("offset", F.expr("`offset` div 3"))
    sized = batches.withColumn("batch_size", F.lit(3).cast("bigint"))
    return commits.next_observed(sized, chunk_bits=SMALL_CHUNKS)


@query("c11_next_observed_small_chunks",
    on_log(f'SELECT {GTP}, "offset", metadata, emit_seq AS arrival_seq FROM next_observed WHERE emit_seq IS NOT NULL', COMMITTABLES, NEXT))
def _(spark, sf):
    return commits.next_observed(fx.committables(spark, sf), chunk_bits=SMALL_CHUNKS).drop("batch_size")


@query("c11_next_observed_flow", on_log("SELECT * FROM flow", NEXT_COMMITTABLES, FLOW))
def _(spark, sf):
    return commits.batch_flow(fx.committables(spark, sf), MAX_BATCH, when="next_observed", single=True)


@query(
    "c11_next_observed_stream",
    on_log(f"""SELECT {GTP}, batch, max("offset") + 1 AS "offset", arg_max(metadata, "offset") AS metadata,
      count(*) AS updates, max(emit_seq) AS last_seq, 'size' AS closed_by
      FROM (SELECT *, lead(arrival_seq) OVER (PARTITION BY {TP} ORDER BY arrival_seq) AS emit_seq,
        (rn - 1) // 50 AS batch FROM committables) WHERE emit_seq IS NOT NULL
      GROUP BY {GTP}, batch HAVING count(*) = 50""", IN_ORDER),
)
def _(spark, sf):
    batches = collect.commit_batches(
        commit_stream(spark, sf), 50, stream=STREAM_KEY, when="next_observed"
    )
    return stream_to_table(batches, "c11")


@query(
    "c13_aggregate_offsets",
    on_log(f"""SELECT {TP}, "offset", metadata FROM (SELECT *, row_number() OVER (PARTITION BY {TP}
      ORDER BY "offset" DESC, arrival_seq) AS rn FROM committables) WHERE rn = 1""", COMMITTABLES2),
)
def _(spark, sf):
    return commits.aggregate_offsets(fx.committables(spark, sf, "g1", "g2"))


@query(
    "c14_only_assigned",
    on_log(f"""SELECT {GTP}, "offset", metadata FROM ({BATCH}) SEMI JOIN (SELECT * FROM assignments
      WHERE epoch = 1 AND member = 'm0') USING ({TP})""", COMMITTABLES, ASSIGNMENTS),
)
def _(spark, sf):
    assigned = fx.assignments(spark, sf).filter("epoch = 1 AND member = 'm0'")
    return commits.only_assigned(first_batch(spark, sf), assigned).select(
        *model.GTP, "offset", "metadata"
    )


@query(
    "c15_refresh_due",
    on_log(f"""SELECT {TP}, "offset" FROM (SELECT {TP}, max("offset") // 2 AS "offset",
        CASE WHEN "partition" = 1 THEN max("offset") ELSE max("offset") // 2 END AS requested,
        max("timestamp") AS last_commit FROM log GROUP BY topic, "partition")
      WHERE "offset" = requested AND last_commit + INTERVAL 30 MINUTE < TIMESTAMP '2024-01-31 00:00:00'"""),
)
def _(spark, sf):
    half = F.floor(F.max("offset") / 2)
    progress = fx.event_log(spark, sf).groupBy(*model.TP).agg(
        half.alias("committed"),
        F.when(F.col("partition") == 1, F.max("offset")).otherwise(half).alias("requested"),
        F.max("timestamp").alias("last_commit"),
    )
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return commits.refresh_due(progress, now, F.expr("interval 30 minutes"))


@query("c17_two_groups", on_log(f"SELECT *, (SELECT count(*) FROM committables) AS batch_size FROM ({BATCH})", COMMITTABLES2))
def _(spark, sf):
    return commits.with_batch_size(first_batch(spark, sf, "g1", "g2"))


@query(
    "c18_last_committer_wins",
    on_log(f"""SELECT {GTP}, arg_max("offset", m) AS "offset", arg_max(metadata, m) AS metadata, sum(n)::BIGINT AS updates
      FROM (SELECT 'shared' AS group_id, {TP}, CASE WHEN group_id = 'g1' THEN 2 ELSE 1 END AS m,
        arg_max(CASE WHEN group_id = 'g1' THEN "offset" // 2 ELSE "offset" END, arrival_seq) + 1 AS "offset",
        arg_max(metadata, arrival_seq) AS metadata, count(*) AS n
        FROM committables GROUP BY ALL) GROUP BY {GTP}""",
      COMMITTABLES2),
)
def _(spark, sf):
    """Two readers of one group; the one that lags behind commits last and wins."""
    both = fx.committables(spark, sf, "g1", "g2")
    slow = F.col("group_id") == "g1"

    def batch(df, order):
        shared = df.withColumn("group_id", F.lit("shared"))
        return commits.offset_batch(shared).withColumn("batch_seq", F.lit(order))

    behind = both.filter(slow).withColumn("offset", F.floor(F.col("offset") / 2))
    return commits.merge_batches(batch(both.filter(~slow), 1).unionByName(batch(behind, 2)))


@query(
    "c19_transaction_offsets",
    on_log(f"""SELECT {GTP}, max("offset") + 1 AS "offset", arg_max(metadata, "offset") AS metadata
      FROM committables GROUP BY {GTP}""", COMMITTABLES),
)
def _(spark, sf):
    return txn.require_single_group(txn.batch_offsets(fx.committables(spark, sf)))
