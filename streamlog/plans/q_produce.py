"""Queries: envelopes, producing, typed values and shards."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog import model
from streamlog.functions import envelope, partitioner, serde
from streamlog.operators import produce, sharding
from streamlog.plans import fixtures as fx
from streamlog.plans.oracle_log import ASSIGNMENTS, ENDS, TP, hash_ctes, on_log
from streamlog.plans.q_sources import EVERYTHING, event_stream, stream_to_table
from streamlog.plans.registry import query
from streamlog.sources import log, source

N = fx.PARTITIONS


def routed(df):
    """Small numbers go to two topics, multiples of ten nowhere, others to one topic."""
    df = df.withColumn("k", fx.k_of())
    k = F.col("k")
    two = envelope.multi(
        envelope.record("out-a", F.col("value"), key=F.col("key")),
        envelope.record("out-b", F.col("value"), partition=F.col("partition")),
    )
    one = envelope.single(envelope.record("out-c", F.col("value")))
    cases = [(k % 10 == 0, envelope.pass_through()), (k < 10, two)]
    return df.withColumn("records", envelope.route(cases, one))


def envelopes(spark, sf):
    pairs = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1")
    return routed(pairs.withColumnRenamed("arrival_seq", "envelope_id")).select(
        "envelope_id", "records", "ctx"
    )


SENT = f"""sent AS (
  SELECT arrival_seq AS envelope_id, 0 AS pos, 'out-a' AS topic, ((h & 2147483647) % 4)::INTEGER AS p, "key", value
    FROM log JOIN hashes ON k = "key" WHERE kn % 10 <> 0 AND kn < 10
  UNION ALL SELECT arrival_seq, 1, 'out-b', "partition", NULL, value FROM log WHERE kn % 10 <> 0 AND kn < 10
  UNION ALL SELECT arrival_seq, 0, 'out-c', ((row_number() OVER (ORDER BY arrival_seq) - 1) % 4)::INTEGER, NULL, value
    FROM log WHERE kn % 10 <> 0 AND kn >= 10),
placed AS (SELECT envelope_id, pos, topic, p AS "partition", "key", value,
  row_number() OVER (PARTITION BY topic, p ORDER BY envelope_id, pos) - 1 AS "offset" FROM sent)"""

RENDERED = """results AS (SELECT e.arrival_seq AS envelope_id, e.topic AS ctx_topic, e."partition" AS ctx_partition,
  e."offset" AS ctx_offset, coalesce(string_agg(p.topic || '/' || p."partition" || ' ' || p."offset" || ': ' || p.value, ', '
    ORDER BY pos), 'passed through') AS text, count(p.pos) AS n
  FROM log e LEFT JOIN placed p ON p.envelope_id = e.arrival_seq GROUP BY ALL)"""


def flow(spark, sf):
    return produce.flexi_flow(envelopes(spark, sf), N)


@query("b02_flexi_flow_records", on_log(f"""SELECT envelope_id, pos, {TP}, "offset", coalesce("key", '') AS "key", value FROM placed""", SENT))
def _(spark, sf):
    records = flow(spark, sf).records
    key = F.coalesce("key", F.lit("")).alias("key")
    return records.select("envelope_id", "pos", *model.TP, "offset", key, "value")


@query(
    "b02_flexi_flow_results",
    on_log("""SELECT envelope_id, CASE n WHEN 0 THEN 'pass_through' WHEN 1 THEN 'single' ELSE 'multi' END AS kind, n AS n_parts
      FROM results""", SENT, RENDERED),
)
def _(spark, sf):
    results = flow(spark, sf).results
    n_parts = F.coalesce(F.size("parts"), F.lit(0)).cast("bigint").alias("n_parts")
    return results.select("envelope_id", produce.kind(F.col("parts")).alias("kind"), n_parts)


SINGLE = f"""placed AS (SELECT arrival_seq AS envelope_id, 'copy' AS topic, ((h & 2147483647) % 4)::INTEGER AS "partition", value,
  row_number() OVER (PARTITION BY (h & 2147483647) % 4 ORDER BY arrival_seq) - 1 AS "offset" FROM log JOIN hashes ON k = "key")"""


@query("b03_flow_single", on_log(f'SELECT envelope_id, {TP}, "offset", value FROM placed', SINGLE))
def _(spark, sf):
    one = envelope.single(envelope.record("copy", F.col("value"), key=F.col("key")))
    singles = fx.event_log(spark, sf).select(F.col("arrival_seq").alias("envelope_id"), one.alias("records"))
    results = produce.flexi_flow(singles, N).results
    part = results.select("envelope_id", F.col("parts")[0].alias("r"))
    return part.select("envelope_id", "r.topic", "r.partition", "r.offset", "r.value")


@query(
    "b04_flow_with_context",
    on_log("SELECT envelope_id, ctx_topic, ctx_partition, ctx_offset, n AS n_parts FROM results", SENT, RENDERED),
)
def _(spark, sf):
    results = flow(spark, sf).results
    return results.select(
        "envelope_id",
        F.col("ctx.topic").alias("ctx_topic"),
        F.col("ctx.partition").alias("ctx_partition"),
        F.col("ctx.offset").alias("ctx_offset"),
        F.coalesce(F.size("parts"), F.lit(0)).cast("bigint").alias("n_parts"),
    )


@query("b05_single", on_log(f"""SELECT arrival_seq AS envelope_id, 1 AS n_records, 'copy' AS topic, "key", value FROM log"""))
def _(spark, sf):
    one = envelope.single(envelope.record("copy", F.col("value"), key=F.col("key")))
    made = fx.event_log(spark, sf).select(F.col("arrival_seq").alias("envelope_id"), one.alias("records"))
    return made.select("envelope_id", F.size("records").alias("n_records"), F.col("records")[0].alias("r")).select(
        "envelope_id", "n_records", "r.topic", "r.key", "r.value"
    )


@query(
    "b06_multi",
    on_log(f"""SELECT arrival_seq AS envelope_id, pos, 'out-' || pos AS topic, "key", {TP.replace('topic', 'topic AS ctx_topic').replace('"partition"', '"partition" AS ctx_partition')}
      FROM log, (VALUES (2), (3)) AS targets(pos)"""),
)
def _(spark, sf):
    pair = envelope.multi(*[envelope.record(f"out-{i}", F.col("value"), key=F.col("key")) for i in (2, 3)])
    pairs = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1")
    made = pairs.select(F.col("arrival_seq").alias("envelope_id"), "ctx", F.posexplode(pair).alias("pos", "r"))
    return made.select(
        "envelope_id", (F.col("pos") + 2).alias("pos"), "r.topic", "r.key",
        F.col("ctx.topic").alias("ctx_topic"), F.col("ctx.partition").alias("ctx_partition"),
    )


@query(
    "b07_pass_through",
    on_log(f"""SELECT {TP}, count(*) AS envelopes, 0::BIGINT AS records, max("offset") + 1 AS committed FROM log GROUP BY ALL"""),
)
def _(spark, sf):
    """Nothing is written, everything is committed."""
    pairs = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1")
    empty = pairs.withColumn("records", envelope.pass_through())
    return empty.groupBy("ctx.topic", "ctx.partition").agg(
        F.count(F.lit(1)).alias("envelopes"),
        F.sum(F.size("records")).alias("records"),
        (F.max("ctx.offset") + 1).alias("committed"),
    )


@query("b08_with_pass_through", on_log("SELECT arrival_seq AS envelope_id, 'id-' || arrival_seq AS pass_through, 1 AS n_records FROM log"))
def _(spark, sf):
    one = envelope.single(envelope.record("copy", F.col("value")))
    made = fx.event_log(spark, sf).select(
        F.col("arrival_seq").alias("envelope_id"), one.alias("records"), F.lit("old").alias("pass_through")
    )
    text = F.concat(F.lit("id-"), F.col("envelope_id").cast("string"))
    return envelope.with_pass_through(made, text).select(
        "envelope_id", "pass_through", F.size("records").alias("n_records")
    )


ROUTED = on_log(
    """SELECT arrival_seq AS envelope_id, CASE WHEN kn % 10 = 0 THEN '' WHEN kn < 10 THEN 'out-a,out-b' ELSE 'out-c' END AS topics FROM log"""
)


@query("b09_route", ROUTED)
def _(spark, sf):
    topics = F.concat_ws(",", F.transform("records", lambda r: r["topic"])).alias("topics")
    return envelopes(spark, sf).select("envelope_id", topics)


@query("b09_route_stream", ROUTED)
def _(spark, sf):
    topics = F.concat_ws(",", F.transform("records", lambda r: r["topic"])).alias("topics")
    made = routed(event_stream(spark, sf)).select(F.col("arrival_seq").alias("envelope_id"), topics)
    return stream_to_table(made, "b09")


@query("b10_render_results", on_log("SELECT envelope_id, text FROM results", SENT, RENDERED))
def _(spark, sf):
    return produce.render_results(flow(spark, sf).results).select("envelope_id", "text")


@query("b13_choose_partition", on_log(f"SELECT envelope_id, pos, {TP} FROM placed", SENT))
def _(spark, sf):
    chosen = partitioner.choose(produce.expand(envelopes(spark, sf)), N, **produce.SEND_ORDER)
    return chosen.select("envelope_id", "pos", *model.TP)


@query(
    "b14_append_offsets",
    on_log(f"""SELECT {TP}, arrival_seq, end_offset + row_number() OVER (PARTITION BY {TP} ORDER BY arrival_seq DESC) - 1 AS "offset"
      FROM log JOIN ends USING ({TP})""", ENDS),
)
def _(spark, sf):
    """The log appended to itself, newest first."""
    again = fx.event_log(spark, sf).select(*model.TP, "arrival_seq", (-F.col("arrival_seq")).alias("seq"))
    placed = log.append_offsets(again, seq="seq", base=fx.ends(spark, sf))
    return placed.select(*model.TP, "arrival_seq", "offset")


@query(
    "b14_append_offsets_sorted",
    on_log(f"""SELECT {TP}, "key", arrival_seq, end_offset + row_number() OVER (PARTITION BY {TP}
      ORDER BY "key", arrival_seq) - 1 AS "offset" FROM log JOIN ends USING ({TP})""", ENDS),
)
def _(spark, sf):
    again = fx.event_log(spark, sf).select(*model.TP, "key", "arrival_seq")
    placed = log.append_offsets_sorted(again, order_by=["key", "arrival_seq"], base=fx.ends(spark, sf))
    return placed.select(*model.TP, "key", "arrival_seq", "offset")


@query("b14_log_table", on_log(f'SELECT {TP}, "offset", "timestamp", "key", value, arrival_seq FROM log'))
def _(spark, sf):
    """Building the log itself: hash, sort, number and write all events."""
    path = fx.run_dir(spark, "b14")
    fx.build_event_log(spark, sf, path)
    return log.read(spark, path).select(*model.TP, "offset", "timestamp", "key", "value", "arrival_seq")


@query(
    "b15_resume_on_error",
    on_log(f"""SELECT 'sent' AS outcome, {TP}, count(*) AS records, max("offset") + 1 AS committed FROM log WHERE kn < 90 GROUP BY ALL
      UNION ALL SELECT 'dead', {TP}, count(*), -1 FROM log WHERE kn >= 90 GROUP BY ALL"""),
)
def _(spark, sf):
    good, bad = produce.with_policy(fx.event_log(spark, sf), fx.k_of() < 90, on_error="resume")
    count = F.count(F.lit(1)).alias("records")
    sent = good.groupBy(*model.TP).agg(count, (F.max("offset") + 1).alias("committed"))
    dead = bad.groupBy(*model.TP).agg(count, F.lit(-1).cast("bigint").alias("committed"))
    return sent.select(F.lit("sent").alias("outcome"), "*").unionByName(
        dead.select(F.lit("dead").alias("outcome"), "*")
    )


@query("b16_send_once", on_log(f'SELECT {TP}, "offset", value FROM placed', SINGLE))
def _(spark, sf):
    """A batch write outside any stream, read back from the target log."""
    one = envelope.single(envelope.record("copy", F.col("value"), key=F.col("key")))
    singles = fx.event_log(spark, sf).select(F.col("arrival_seq").alias("envelope_id"), one.alias("records"))
    path = fx.run_dir(spark, "b16")
    records = produce.flexi_flow(singles, N).records
    log.write(records.select(*model.TP, "offset", "timestamp", "key", "value"), path)
    return log.read(spark, path).select(*model.TP, "offset", "value")


# -- typed values ------------------------------------------------------------

DATA = T.StructType([T.StructField("k", T.LongType())])
FAULTY = """faulty AS (SELECT * REPLACE (CASE WHEN arrival_seq % 97 = 0 THEN '[1,' ELSE value END AS value),
  arrival_seq % 97 = 0 AS bad FROM log)"""


def faulty_log(df):
    return df.withColumn(
        "value", F.when(F.col("arrival_seq") % 97 == 0, "[1,").otherwise(F.col("value"))
    )


@query("e01_typed_key_value", on_log(f"""SELECT {TP}, "offset", "key", value, length(value)::BIGINT AS n_bytes FROM log"""))
def _(spark, sf):
    raw = fx.event_log(spark, sf).withColumns(
        {"key": F.encode("key", "UTF-8"), "value": F.encode("value", "UTF-8")}
    )
    return raw.select(
        *model.TP, "offset", serde.text(F.col("key")).alias("key"), serde.text(F.col("value")).alias("value"),
        F.octet_length("value").cast("bigint").alias("n_bytes"),
    )


GOOD = on_log(f'SELECT {TP}, "offset", kn AS k FROM faulty WHERE NOT bad', FAULTY)


@query("e02_json_resume", GOOD)
def _(spark, sf):
    good, _ = serde.json_resume(faulty_log(fx.event_log(spark, sf)), DATA)
    return good.select(*model.TP, "offset", "data.k")


@query("e02_json_resume_stream", GOOD)
def _(spark, sf):
    good, _ = serde.json_resume(faulty_log(event_stream(spark, sf)), DATA)
    return stream_to_table(good.select(*model.TP, "offset", "data.k"), "e02")


@query("e02_json_faulty", on_log(f'SELECT {TP}, "offset", value FROM faulty WHERE bad', FAULTY))
def _(spark, sf):
    _, bad = serde.json_resume(faulty_log(fx.event_log(spark, sf)), DATA)
    return bad.select(*model.TP, "offset", "value")


@query(
    "e03_json_encode",
    on_log(f"""SELECT {TP}, "offset", '{{"user":"' || "key" || '","k":' || kn || '}}' AS value FROM log"""),
)
def _(spark, sf):
    value = serde.to_json_value(F.col("key").alias("user"), fx.k_of().alias("k"))
    return fx.event_log(spark, sf).select(*model.TP, "offset", value.alias("value"))


@query(
    "e04_decode_or_pass",
    on_log(f"""SELECT {TP}, count(*) AS committed_envelopes, max("offset") + 1 AS committed,
      sum(CASE WHEN bad THEN 0 ELSE 1 END)::BIGINT AS records, sum(CASE WHEN bad THEN 1 ELSE 0 END)::BIGINT AS dead
      FROM faulty GROUP BY ALL""", FAULTY),
)
def _(spark, sf):
    pairs = source.committable(faulty_log(fx.event_log(spark, sf)), EVERYTHING, "g1")
    out = envelope.single(envelope.record("numbers", F.col("data.k")))
    return serde.decode_or_pass(pairs, DATA, out).groupBy("ctx.topic", "ctx.partition").agg(
        F.count("ctx").alias("committed_envelopes"),
        (F.max("ctx.offset") + 1).alias("committed"),
        F.sum(F.size("records")).alias("records"),
        F.count_if("faulty").alias("dead"),
    )


# -- shards ------------------------------------------------------------------

CUSTOMER_HASHES = hash_ctes("chashes", "SELECT DISTINCT o_custkey::VARCHAR AS k FROM orders")


@query(
    "f01_shard_id",
    f"WITH {CUSTOMER_HASHES} SELECT k AS entity_id, ((h & 2147483647) % 12)::VARCHAR AS shard, "
    "(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INTEGER AS hash FROM chashes",
)
def _(spark, sf):
    ids = fx.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("entity_id")).distinct()
    return ids.select(
        "entity_id",
        partitioner.shard_id(F.col("entity_id"), 12).alias("shard"),
        partitioner.murmur2(F.col("entity_id")).alias("hash"),
    )


SHARD = """((h & 2147483647) % (SELECT count(DISTINCT "partition") FROM log WHERE topic = 'ev-signup'))::VARCHAR"""


@query("f02_message_extractor", on_log(f"""SELECT {TP}, "offset", "key" AS entity_id, {SHARD} AS shard FROM log JOIN hashes ON k = "key" """))
def _(spark, sf):
    records = fx.event_log(spark, sf)
    return sharding.with_shard_of_topic(records, records, "ev-signup").select(
        *model.TP, "offset", "entity_id", "shard"
    )


@query(
    "f02_message_extractor_declared",
    on_log(f"""SELECT {TP}, "offset", "key" AS entity_id, ((h & 2147483647) % 6)::VARCHAR AS shard FROM log JOIN hashes ON k = "key" """),
)
def _(spark, sf):
    """Partitions without records count: entities do not move when the first record comes to one."""
    return sharding.with_shard_of_topic(fx.event_log(spark, sf), fx.declared_table(spark, sf), "ev-signup").select(
        *model.TP, "offset", "entity_id", "shard"
    )


@query(
    "f03_extractor_no_envelope",
    f"WITH {CUSTOMER_HASHES} SELECT o_orderkey, k AS entity_id, ((h & 2147483647) % 7)::VARCHAR AS shard "
    "FROM orders JOIN chashes ON k = o_custkey::VARCHAR",
)
def _(spark, sf):
    orders = fx.table(spark, sf, "orders")
    sharded = sharding.with_shard(orders, 7, entity_id=F.col("o_custkey").cast("string"))
    return sharded.select("o_orderkey", "entity_id", "shard")


@query(
    "f04_locate",
    on_log(f"""SELECT log.topic, log."partition", "offset", "key" AS entity_id, ((h & 2147483647) % 4)::VARCHAR AS shard, member FROM log
      JOIN hashes ON k = "key" JOIN (SELECT member, "partition" AS p FROM assignments WHERE epoch = 3 AND topic = 'ev-signup')
        ON p = (h & 2147483647) % 4""", ASSIGNMENTS),
)
def _(spark, sf):
    assigned = fx.assignments(spark, sf).filter("epoch = 3 AND topic = 'ev-signup'")
    sharded = sharding.with_shard(fx.event_log(spark, sf), N)
    return sharding.locate(sharded, assigned.select("member", "partition")).select(
        *model.TP, "offset", "entity_id", "shard", "member"
    )
