"""Queries: log metadata, progress, rewind protection and delivery checks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from streamlog import model
from streamlog.operators import meta, metrics, progress, protect, rebalance, verify
from streamlog.plans import fixtures as fx
from streamlog.plans.oracle_log import (
    ASSIGNMENTS, COMMITS, ENDS, JITTERED, POLLS, REQUESTED, TP, TXN, on_log,
)
from streamlog.plans.registry import query
from streamlog.sources import partitioned
from streamlog.streaming import txn

GTP = f"group_id, {TP}"


@query("d01_list_topics", on_log("""SELECT topic, string_agg("partition"::VARCHAR, ',' ORDER BY "partition") AS partitions
  FROM (SELECT DISTINCT topic, "partition" FROM log) GROUP BY topic"""))
def _(spark, sf):
    listed = meta.list_topics(fx.event_table(spark, sf))
    return listed.select("topic", F.array_join(F.col("partitions").cast("array<string>"), ",").alias("partitions"))


@query("d01_list_topics_declared", on_log("""SELECT topic, string_agg("partition"::VARCHAR, ',' ORDER BY "partition") AS partitions
  FROM (SELECT topic, "partition" FROM log UNION SELECT 'ev-signup', p FROM (VALUES (4), (5)) AS v(p)
    UNION SELECT 'ev-silent', p FROM (VALUES (0), (1)) AS v(p)) GROUP BY topic"""))
def _(spark, sf):
    """Topic-partitions that hold no record are listed too."""
    listed = meta.list_topics(fx.declared_table(spark, sf))
    return listed.select("topic", F.array_join(F.col("partitions").cast("array<string>"), ",").alias("partitions"))


@query("d02_partitions_for", on_log(f"SELECT DISTINCT {TP} FROM log WHERE topic = 'ev-click'"))
def _(spark, sf):
    return meta.partitions_for(fx.event_table(spark, sf), "ev-click")


RETAINED = """retained AS (SELECT * FROM log WHERE "timestamp" >= TIMESTAMP '2024-01-03')"""


def asked(spark, sf):
    """All topic-partitions and one that does not exist in each topic."""
    known = fx.partitions(spark, sf)
    return known.unionByName(
        known.select("topic", F.lit(99).alias("partition")).distinct()
    )


ASKED = f"asked AS (SELECT DISTINCT {TP} FROM log UNION SELECT DISTINCT topic, 99 FROM log)"


@query("d03_beginning_offsets", on_log(f"""SELECT {TP}, coalesce(min("offset"), 0) AS begin_offset FROM asked
  LEFT JOIN retained USING ({TP}) GROUP BY ALL""", RETAINED, ASKED))
def _(spark, sf):
    return meta.beginning_offsets(fx.retained_table(spark, sf), asked(spark, sf))


@query("d04_end_offsets", on_log(f"""SELECT {TP}, coalesce(max("offset") + 1, 0) AS end_offset FROM asked
  LEFT JOIN log USING ({TP}) GROUP BY ALL""", ASKED))
def _(spark, sf):
    return meta.end_offsets(fx.event_table(spark, sf), asked(spark, sf))


@query("d04_end_offsets_declared", on_log(f"""SELECT {TP}, max("offset") + 1 AS end_offset FROM log GROUP BY ALL
  UNION ALL SELECT 'ev-signup', p, 0 FROM (VALUES (4), (5)) AS v(p) UNION ALL SELECT 'ev-silent', p, 0 FROM (VALUES (0), (1)) AS v(p)"""))
def _(spark, sf):
    """An empty topic-partition is known, and ends at 0."""
    table = fx.declared_table(spark, sf)
    return meta.end_offsets(table, table.partitions(), strict=True)


@query("d07_strict_lookup", on_log(f'SELECT {TP}, max("offset") + 1 AS end_offset FROM log GROUP BY ALL'))
def _(spark, sf):
    """Every requested topic-partition is known; an unknown one would fail the query."""
    return meta.end_offsets(fx.event_table(spark, sf), fx.partitions(spark, sf), strict=True)


TIMES = """times AS (SELECT *, t0::TIMESTAMP AS "at" FROM (SELECT DISTINCT topic, "partition" FROM log),
  (VALUES ('2024-01-01 00:00:00'), ('2024-01-10 06:00:00'), ('2024-01-25 00:00:00'), ('2030-01-01 00:00:00')) AS v(t0))"""


@query(
    "d05_offsets_for_times",
    on_log(f"""SELECT {TP}, "at", coalesce(min("offset") FILTER ("timestamp" >= "at"), -1) AS "offset",
      coalesce(arg_min("timestamp", "offset") FILTER ("timestamp" >= "at"), TIMESTAMP '1970-01-01') AS "timestamp"
      FROM times JOIN jittered USING ({TP}) GROUP BY {TP}, "at" """, JITTERED, TIMES),
)
def _(spark, sf):
    times = ["2024-01-01 00:00:00", "2024-01-10 06:00:00", "2024-01-25 00:00:00", "2030-01-01 00:00:00"]
    at = F.explode(F.array(*[F.lit(t).cast("timestamp_ntz") for t in times])).alias("at")
    wanted = fx.partitions(spark, sf).select(*model.TP, at)
    found = meta.offsets_for_times(fx.jittered_table(spark, sf), wanted)
    never = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return found.select(
        *model.TP, "at",
        F.coalesce("offset", F.lit(-1)).alias("offset"),
        F.coalesce("timestamp", never).alias("timestamp"),
    )


@query("d06_committed_offsets", on_log(f"""SELECT {GTP}, "offset", metadata FROM commits WHERE commit_seq = 2""", COMMITS))
def _(spark, sf):
    return meta.committed_offsets(fx.commits(spark, sf), "g1", asked(spark, sf))


@query(
    "d08_positions",
    on_log(f"""SELECT {TP}, CASE WHEN topic = 'ev-view' THEN 5 ELSE coalesce(c."offset", e.end_offset) END AS position
      FROM ends e LEFT JOIN (SELECT * FROM commits WHERE commit_seq = 2) c USING ({TP})""", COMMITS),
)
def _(spark, sf):
    records = fx.event_table(spark, sf)
    sought = fx.partitions(spark, sf).filter("topic = 'ev-view'").withColumn("offset", F.lit(5))
    committed = meta.latest_commits(fx.commits(spark, sf))
    return meta.positions(records, fx.partitions(spark, sf), committed, sought, reset="latest")


@query(
    "d09_consumer_lag",
    on_log(f"""SELECT 'g1' AS group_id, {TP}, end_offset, coalesce(c."offset", -1) AS committed_offset,
      end_offset - coalesce(c."offset", 0) AS lag FROM ends
      LEFT JOIN (SELECT * FROM commits WHERE commit_seq = 2) c USING ({TP})""", COMMITS),
)
def _(spark, sf):
    groups = fx.partitions(spark, sf).select(F.lit("g1").alias("group_id"), *model.TP)
    lag = meta.consumer_lag(fx.event_table(spark, sf), fx.commits(spark, sf), groups)
    return lag.withColumn("committed_offset", F.coalesce("committed_offset", F.lit(-1)))


MINE = "epoch = 1 AND member = 'm1'"


@query(
    "d10_received",
    on_log(f"""SELECT poll_batch, {TP}, arg_max("offset", arrival_seq) AS "offset", arg_max("timestamp", arrival_seq) AS "timestamp"
      FROM polls SEMI JOIN (SELECT {TP} FROM assignments WHERE {MINE}) USING ({TP}) GROUP BY poll_batch, {TP}""", POLLS, ASSIGNMENTS),
)
def _(spark, sf):
    assigned = fx.assignments(spark, sf).filter(MINE)
    return progress.received(fx.polls(spark, sf), assigned)


def progress_events(spark, sf):
    """Per record: requested when read, committed every third time; epochs assign and revoke."""
    kind = F.when(F.col("arrival_seq") % 3 == 0, "committed").otherwise("requested")
    # One topic-partition is revoked at its record 200 and assigned again at record 210.
    kind = (
        F.when((F.col("partition") == 1) & (F.col("offset") == 100), "revoke")
        .when((F.col("partition") == 1) & (F.col("offset") == 110), "assign")
        .when(F.col("offset") == 0, "assign")
        .otherwise(kind)
    )
    return fx.event_log(spark, sf).select(F.col("arrival_seq").alias("seq"), kind.alias("kind"), *model.TP, "offset")


PROGRESS = f"""progress AS (SELECT arrival_seq AS seq, CASE WHEN "partition" = 1 AND "offset" = 100 THEN 'revoke'
  WHEN "partition" = 1 AND "offset" = 110 THEN 'assign' WHEN "offset" = 0 THEN 'assign'
  WHEN arrival_seq % 3 = 0 THEN 'committed' ELSE 'requested' END AS kind, {TP}, "offset" FROM log)"""


@query("d11_progress_commits", on_log(f"""SELECT {TP}, kind, arg_max("offset", seq) AS "offset" FROM progress
  WHERE kind IN ('requested', 'committed') GROUP BY {TP}, kind""", PROGRESS))
def _(spark, sf):
    return progress.commits(progress_events(spark, sf))


@query(
    "d12_progress_state",
    on_log(f"""SELECT {TP}, coalesce(arg_max("offset", seq) FILTER (kind = 'requested'), arg_min("offset", seq) FILTER (kind = 'assign')) AS requested,
      coalesce(arg_max("offset", seq) FILTER (kind = 'committed'), arg_min("offset", seq) FILTER (kind = 'assign')) AS committed,
      bool_or(kind = 'assign') AS assigned
      FROM progress LEFT JOIN (SELECT {TP}, max(seq) AS revoked FROM progress WHERE kind = 'revoke' GROUP BY ALL) USING ({TP})
      WHERE revoked IS NULL OR seq > revoked GROUP BY {TP}""", PROGRESS),
)
def _(spark, sf):
    return progress.state_at(progress_events(spark, sf))


SUMMARY = f"""summary AS (SELECT poll_batch, {TP}, arg_min("offset", arrival_seq) AS fo, arg_max("offset", arrival_seq) AS lo,
  arg_min("timestamp", arrival_seq) AS ft, arg_max("timestamp", arrival_seq) AS lt FROM {{0}} GROUP BY poll_batch, {TP})"""

AS_OF = """judged AS (SELECT s.*, a."offset" AS req FROM summary s ASOF LEFT JOIN asked a
  ON s.topic = a.topic AND s."partition" = a."partition" AND s.poll_batch > a.poll_batch)"""
UNSAFE = f"""{AS_OF},
unsafe AS (SELECT poll_batch, {TP}, req AS requested FROM judged WHERE least(fo, lo) < req - 50)"""


@query(
    "d13_reset_filter",
    on_log(f"""SELECT {TP}, "offset", arrival_seq, poll_batch FROM polls ANTI JOIN unsafe USING (poll_batch, {TP})""",
      POLLS, REQUESTED, SUMMARY.format("polls"), UNSAFE),
)
def _(spark, sf):
    polls = fx.polls(spark, sf)
    safe = protect.reset_filter(polls, fx.requested(polls), offset_threshold=50)
    return safe.select(*model.TP, "offset", "arrival_seq", "poll_batch")


JITTERED_POLLS = (
    JITTERED + ", " + POLLS.replace("FROM log", "FROM jittered").strip()
)
# The state is the last timestamp of the last safe poll.
SAFE_FOLD = f"""{AS_OF},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {TP} ORDER BY poll_batch) AS rn FROM judged),
fold AS (SELECT {TP}, rn, poll_batch, req IS NULL OR least(fo, lo) >= req - 50 AS safe,
    CASE WHEN req IS NULL OR least(fo, lo) >= req - 50 THEN lt END AS state FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.topic, r."partition", r.rn, r.poll_batch,
    r.req IS NULL OR (least(fo, lo) >= req - 50 AND (state IS NULL OR least(ft, lt) >= state - INTERVAL 12 HOUR)),
    CASE WHEN r.req IS NULL OR (least(fo, lo) >= req - 50 AND (state IS NULL OR least(ft, lt) >= state - INTERVAL 12 HOUR))
      THEN lt ELSE state END
  FROM fold JOIN ranked r ON r.topic = fold.topic AND r."partition" = fold."partition" AND r.rn = fold.rn + 1)"""


TIME_RESET = on_log(
    f"""SELECT {TP}, poll_batch, safe FROM fold""", JITTERED_POLLS, REQUESTED, SUMMARY.format("polls"), SAFE_FOLD, recursive=True
)


def time_reset(spark, sf, **chunks):
    records = fx.polls(spark, sf, fx.jittered_log(spark, sf))
    judged = protect.judge_polls(
        records, fx.requested(records), offset_threshold=50, time_threshold=datetime.timedelta(hours=12), **chunks
    )
    return judged.select(*model.TP, "poll_batch", "safe")


@query("d14_time_reset_filter", TIME_RESET)
def _(spark, sf):
    return time_reset(spark, sf)


@query("d14_time_reset_filter_small_chunks", TIME_RESET)
def _(spark, sf):
    return time_reset(spark, sf, chunk_bits=2, group_bits=1)


@query(
    "d15_seeks",
    on_log("""SELECT u.topic, u."partition", u.poll_batch, c."offset" AS seek_offset, requested - c."offset" > 50 AS far_behind
      FROM unsafe u ASOF LEFT JOIN acked c ON u.topic = c.topic AND u."partition" = c."partition" AND u.poll_batch > c.poll_batch""",
      POLLS, REQUESTED, SUMMARY.format("polls"), UNSAFE),
)
def _(spark, sf):
    polls = fx.polls(spark, sf)
    return protect.seeks(polls, fx.requested(polls), fx.acknowledged(polls), offset_threshold=50)


@query(
    "d16_in_flight",
    on_log(f"""SELECT {TP}, end_offset - 1 AS "offset" FROM ends WHERE NOT "partition" IN (0, 2)""", ENDS),
)
def _(spark, sf):
    done = F.when(F.col("partition") % 2 == 0, F.col("end_offset") - 1).otherwise(F.col("end_offset") - 2)
    committed = fx.ends(spark, sf).select(*model.TP, done.alias("offset"))
    return progress.in_flight(fx.event_log(spark, sf), committed)


@query(
    "d17_rebalance_events",
    on_log(f"""SELECT epoch, member, {TP}, 'assigned' AS event FROM assignments a
        ANTI JOIN (SELECT (epoch + 1)::INTEGER AS epoch, member, {TP} FROM assignments) USING (epoch, member, {TP})
      UNION ALL SELECT epoch, member, {TP}, 'revoked' FROM (SELECT (epoch + 1)::INTEGER AS epoch, member, {TP} FROM assignments)
        ANTI JOIN assignments USING (epoch, member, {TP}) WHERE epoch <= 3""", ASSIGNMENTS),
)
def _(spark, sf):
    return rebalance.events(fx.assignments(spark, sf))


@query(
    "d19_drop_revoked",
    on_log(f"""SELECT {TP}, "offset" FROM log WHERE NOT ("partition" = 1 OR ("partition" = 3 AND topic <> 'ev-view'))"""),
)
def _(spark, sf):
    parts = fx.partitions(spark, sf)
    revoked = parts.filter("partition % 2 = 1")
    assigned = parts.filter("partition = 3 AND topic = 'ev-view'")
    kept = rebalance.drop_revoked(fx.event_log(spark, sf), revoked, assigned)
    return kept.select(*model.TP, "offset")


@query(
    "d20_resume_points",
    on_log(f"""SELECT {TP}, min("offset") AS resume_offset FROM log WHERE NOT (kn <= 90 OR "partition" = 2) GROUP BY ALL"""),
)
def _(spark, sf):
    records = fx.event_log(spark, sf)
    done = records.filter((fx.k_of() <= 90) | (F.col("partition") == 2))
    return partitioned.resume_points(records, done)


GAPS = on_log(f"""SELECT {TP}, "offset", next_offset, next_offset - "offset" - 1 AS missing FROM (
      SELECT *, lead("offset") OVER (PARTITION BY {TP} ORDER BY "offset") AS next_offset FROM txn_log
        WHERE txn_id IS NULL OR txn_id % 7 <> 3) WHERE next_offset - "offset" > 1""", TXN)


@query("d21_gaps", GAPS)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    return verify.gaps(txn.read_committed(records, transactions))


@query("d21_gaps_small_chunks", GAPS)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    return verify.gaps(txn.read_committed(records, transactions), chunk_bits=4)


METRICS = """samples AS (SELECT 'orders-' || lower(o_orderstatus) AS metric, 'counter' AS kind, o_orderkey AS at_, o_custkey AS v FROM orders
  UNION ALL SELECT 'priority-' || substr(o_orderpriority, 1, 1), 'gauge', o_orderkey, o_custkey FROM orders)"""


def samples(spark, sf):
    orders = fx.table(spark, sf, "orders")
    rest = [F.col("o_orderkey").alias("at"), F.col("o_custkey").alias("value")]
    counters = F.concat(F.lit("orders-"), F.lower("o_orderstatus")).alias("metric")
    gauges = F.concat(F.lit("priority-"), F.substring("o_orderpriority", 1, 1)).alias("metric")
    return orders.select(counters, F.lit("counter").alias("kind"), *rest).unionByName(
        orders.select(gauges, F.lit("gauge").alias("kind"), *rest)
    )


@query(
    "d23_metrics",
    f"""WITH {METRICS} SELECT metric, kind, count(*) AS samples, CASE WHEN kind = 'counter'
      THEN arg_max(v, at_) - arg_min(v, at_) ELSE arg_max(v, at_) END AS value FROM samples GROUP BY metric, kind""",
)
def _(spark, sf):
    return metrics.summarise(samples(spark, sf))


@query(
    "d23_metrics_mean",
    f"""WITH {METRICS} SELECT metric, kind, count(*) AS samples, CASE WHEN kind = 'counter'
      THEN (arg_max(v, at_) - arg_min(v, at_))::DOUBLE ELSE round(avg(v), 6) END AS value FROM samples GROUP BY metric, kind""",
)
def _(spark, sf):
    summary = metrics.summarise(samples(spark, sf), gauge="mean")
    return summary.withColumn("value", F.round("value", 6))


# -- verification ------------------------------------------------------------


def delivered_twice(spark, sf):
    """A log in which every 50th event was appended a second time."""
    records = fx.event_log(spark, sf).select(
        *model.TP, "offset", "arrival_seq", F.concat(F.lit("v"), F.col("arrival_seq").cast("string")).alias("value")
    )
    again = (
        records.filter(F.col("arrival_seq") % 50 == 0)
        .join(fx.ends(spark, sf), model.TP)
        .withColumn("offset", F.col("offset") + F.col("end_offset"))
        .drop("end_offset")
    )
    return records.unionByName(again)


@query("v01_duplicates", "SELECT 'v' || event_id AS value, 2::BIGINT AS copies FROM events WHERE event_id % 50 = 0")
def _(spark, sf):
    return verify.duplicates(delivered_twice(spark, sf))


@query(
    "v02_missing_blocks",
    """SELECT min(v) AS first, max(v) AS last, count(*) AS size,
      string_agg(v::VARCHAR, ',' ORDER BY v) FILTER (v < first10 + 10) AS first_ten
    FROM (SELECT v, run, min(v) OVER (PARTITION BY run) AS first10 FROM (
      SELECT event_id AS v, event_id - row_number() OVER (ORDER BY event_id) AS run
      FROM events WHERE event_id // 40 % 9 = 2 OR event_id % 31 = 7)) GROUP BY run""",
)
def _(spark, sf):
    ids = fx.table(spark, sf, "events").select(F.col("event_id").alias("v"))
    lost = F.expr("v div 40 % 9 = 2 OR v % 31 = 7")
    blocks = verify.missing_blocks(ids, ids.filter(~lost))
    return blocks.withColumn("first_ten", F.array_join(F.col("first_ten").cast("array<string>"), ","))


@query(
    "v03_partition_sequence",
    """SELECT 'conversations' AS topic, conv_id::INTEGER AS "partition", count(*) AS records, 0::BIGINT AS mismatches
      FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    return verify.partition_sequence(fx.conversation_log(spark, sf), F.col("offset"))


@query(
    "v03_partition_sequence_broken",
    on_log(f"""SELECT {TP}, count(*) AS records, count(*) FILTER (wrong) AS mismatches FROM (SELECT *,
      "offset" <> row_number() OVER (PARTITION BY {TP} ORDER BY "offset") - 1 AS wrong FROM txn_log
      WHERE txn_id IS NULL OR txn_id % 7 <> 3) GROUP BY ALL""".replace("GROUP BY ALL", f"GROUP BY {TP}"), TXN),
)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    return verify.partition_sequence(txn.read_committed(records, transactions), F.col("offset"))


@query(
    "v04_same_multiset",
    on_log("""SELECT value, sum(s)::BIGINT AS surplus FROM (SELECT value, 1 AS s FROM txn_log UNION ALL
      SELECT value, -1 FROM txn_log WHERE txn_id IS NULL OR txn_id % 7 <> 3) GROUP BY value HAVING sum(s) <> 0""", TXN),
)
def _(spark, sf):
    records, transactions = fx.transactional_log(spark, sf)
    read = txn.read_committed(records, transactions)
    return verify.same_multiset(records.select("value"), read.select("value"))


@query(
    "v04_all_consumers_read_all",
    on_log("SELECT \"key\", value, 0::BIGINT AS surplus FROM log WHERE false"),
)
def _(spark, sf):
    """Two members of a group together: nothing is missing or extra."""
    records = fx.event_log(spark, sf)
    first = fx.assignments(spark, sf).filter("epoch = 0 AND member = 'm0'")
    second = fx.assignments(spark, sf).filter("epoch = 0 AND member = 'm1'")
    read = records.join(first, model.TP, "left_semi").unionByName(
        records.join(second, model.TP, "left_semi")
    )
    return verify.same_multiset(records.select("key", "value"), read.select("key", "value"))


@query(
    "v05_at_least",
    on_log(f"""SELECT {TP}, count(*) AS sent, count(*) + count(*) FILTER (arrival_seq % 50 = 0) AS received, true AS complete
      FROM log GROUP BY ALL"""),
)
def _(spark, sf):
    return verify.at_least(fx.event_log(spark, sf), delivered_twice(spark, sf), model.TP)
