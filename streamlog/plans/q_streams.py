"""Queries: stream operators around the log."""

from __future__ import annotations

import datetime

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog import model
from streamlog.functions import envelope, ordered
from streamlog.operators import batching
from streamlog.plans import fixtures as fx
from streamlog.plans.oracle_log import ORDER_LOG, TP, on_log
from streamlog.plans.q_commits import IN_ORDER, timed_fold
from streamlog.plans.q_sources import EVERYTHING, event_stream, stream_to_table
from streamlog.plans.registry import query
from streamlog.sources import source, subs
from streamlog.streaming import collect, delivery


@query("h01_map", on_log(f"""SELECT {TP}, "offset", 'copy-' || topic AS target, "key" || ':' || value AS mapped FROM log"""))
def _(spark, sf):
    return fx.event_log(spark, sf).select(
        *model.TP, "offset",
        F.concat(F.lit("copy-"), "topic").alias("target"),
        F.concat("key", F.lit(":"), "value").alias("mapped"),
    )


def square(k: pd.Series) -> pd.Series:
    """Stands for user code that has no built-in equivalent."""
    return k * k


@query("h02_map_async", on_log(f'SELECT {TP}, "offset", kn * kn AS squared FROM log'))
def _(spark, sf):
    user_code = F.pandas_udf(square, T.LongType())
    return fx.event_log(spark, sf).select(
        *model.TP, "offset", user_code(fx.k_of()).alias("squared")
    )


@query("h03_filter", on_log(f'SELECT {TP}, "offset", value FROM log WHERE kn % 10 <> 0'))
def _(spark, sf):
    kept = fx.event_log(spark, sf).filter(fx.k_of() % 10 != 0)
    return kept.select(*model.TP, "offset", "value")


@query(
    "h03_filter_keeps_offsets",
    on_log(f"""SELECT {TP}, "offset" AS ctx_offset, CASE WHEN kn % 10 = 0 THEN 0 ELSE 1 END AS n_records FROM log"""),
)
def _(spark, sf):
    pairs = source.committable(fx.event_log(spark, sf), EVERYTHING, "g1")
    out = envelope.single(envelope.record("kept", F.col("value")))
    routed = pairs.withColumn(
        "records", envelope.route([(fx.k_of() % 10 == 0, envelope.pass_through())], out)
    )
    return routed.select(
        "ctx.topic", "ctx.partition", F.col("ctx.offset").alias("ctx_offset"),
        F.size("records").alias("n_records"),
    )


@query("h04_take", on_log(f'SELECT {TP}, "offset", value FROM log ORDER BY {TP}, "offset" LIMIT 100'))
def _(spark, sf):
    return batching.take(fx.event_log(spark, sf), 100).select(*model.TP, "offset", "value")


@query("h04_take_per_partition", on_log(f'SELECT {TP}, "offset", value FROM log WHERE "offset" < 25'))
def _(spark, sf):
    return batching.take_per_partition(fx.event_log(spark, sf), 25).select(*model.TP, "offset", "value")


@query(
    "h05_take_while",
    on_log(f"""SELECT {TP}, "offset", value FROM (SELECT *, max(CASE WHEN kn < 95 THEN 0 ELSE 1 END) OVER (
        PARTITION BY {TP} ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS failed FROM log)
      WHERE coalesce(failed, 0) = 0"""),
)
def _(spark, sf):
    taken = batching.take_while(fx.event_log(spark, sf), fx.k_of() < 95, inclusive=True)
    return taken.select(*model.TP, "offset", "value")


@query(
    "h06_running_count",
    on_log(f"""SELECT {TP}, "offset", count(*) OVER (PARTITION BY {TP} ORDER BY "offset") AS running FROM log"""),
)
def _(spark, sf):
    return batching.running_count(fx.event_log(spark, sf)).select(*model.TP, "offset", "running")


@query("h06_sum_of_sums", on_log("SELECT topic, sum(last)::BIGINT AS total FROM (SELECT topic, \"partition\", count(*) AS last FROM log GROUP BY ALL) GROUP BY topic"))
def _(spark, sf):
    running = batching.running_count(fx.event_log(spark, sf))
    last = running.groupBy(*model.TP).agg(F.max("running").alias("last"))
    return last.groupBy("topic").agg(F.sum("last").alias("total"))


def groups_sql(n: int, sep: str) -> str:
    return f"""groups AS (SELECT topic, "partition", "offset" // {n} AS group_no,
  string_agg(value, '{sep}' ORDER BY "offset") AS joined, sum(kn)::BIGINT AS total,
  max("offset") AS "offset", count(*) AS size
      FROM log GROUP BY topic, "partition", log."offset" // {n})"""


@query("h07_grouped", on_log(f'SELECT {TP}, group_no, joined, "offset", size FROM groups', groups_sql(5, ",")))
def _(spark, sf):
    groups = batching.grouped(fx.event_log(spark, sf), 5)
    return groups.withColumn("joined", F.concat_ws(",", "values")).drop("values")


@query(
    "h08_grouped_within",
    on_log(f"""SELECT {TP}, in_batch AS group_no, CASE WHEN count(*) >= 20 THEN 'size' ELSE 'interval' END AS closed_by,
      string_agg(value, ',' ORDER BY "offset") AS joined, max("offset") AS "offset", count(*) AS size
      FROM (SELECT closed.*, value FROM closed JOIN (SELECT {TP}, "offset", value FROM log) USING ({TP}, "offset"))
      GROUP BY {TP}, in_batch""", IN_ORDER, timed_fold(20), recursive=True),
)
def _(spark, sf):
    groups = collect.grouped_within(fx.ordered_stream(spark, sf), 20, datetime.timedelta(days=1))
    return stream_to_table(groups, "h08")


@query("h09_sums_and_concats", on_log(f'SELECT {TP}, group_no, total, joined, "offset" FROM groups', groups_sql(10, "")))
def _(spark, sf):
    return batching.sums_and_concats(fx.event_log(spark, sf), 10, fx.k_of())


@query(
    "h09_sums_and_concats_envelopes",
    on_log(f"""SELECT 'sums' AS target, total::VARCHAR AS value, {TP}, "offset" FROM groups
      UNION ALL SELECT 'concats', joined, {TP}, "offset" FROM groups""",
      groups_sql(10, "")),
)
def _(spark, sf):
    groups = batching.sums_and_concats(fx.event_log(spark, sf), 10, fx.k_of())
    both = envelope.multi(
        envelope.record("sums", F.col("total")), envelope.record("concats", F.col("joined"))
    )
    sent = groups.withColumn("records", both)
    return sent.select(*model.TP, "offset", F.explode("records").alias("r")).select(
        F.col("r.topic").alias("target"), "r.value", *model.TP, "offset"
    )


@query("h10_merge", on_log(f'SELECT {TP}, "offset", "key" FROM log UNION ALL SELECT {TP}, "offset", "key" FROM olog', ORDER_LOG.strip()))
def _(spark, sf):
    columns = [*model.TP, "offset", "key"]
    return fx.event_log(spark, sf).select(*columns).unionByName(
        fx.order_log(spark, sf).select(*columns)
    )


@query("h11_zip_with_counter", on_log(f"""SELECT {TP}, "offset", row_number() OVER (PARTITION BY topic ORDER BY arrival_seq) AS counter, value FROM log"""))
def _(spark, sf):
    numbered = ordered.row_number(fx.event_log(spark, sf), ["topic"], "arrival_seq", name="counter")
    return numbered.select(*model.TP, "offset", "counter", "value")


@query("h12_flat_map_merge", on_log(f"""SELECT {TP}, "offset", word FROM log, unnest(string_split(value, ' ')) AS words(word)"""))
def _(spark, sf):
    words = F.explode(F.split("value", " ")).alias("word")
    return fx.event_log(spark, sf).select(*model.TP, "offset", words)


@query(
    "h13_group_by_partition",
    on_log(f"""SELECT {TP}, count(*) AS records, count(DISTINCT "key") AS keys, sum(kn)::BIGINT AS total FROM log GROUP BY ALL"""),
)
def _(spark, sf):
    return fx.event_log(spark, sf).groupBy(*model.TP).agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("key").alias("keys"),
        F.sum(fx.k_of()).alias("total"),
    )


@query(
    "h14_multi_sink",
    on_log(f"""SELECT 'values' AS sink, {TP}, count(*) AS records FROM log GROUP BY ALL
      UNION ALL SELECT 'keys', {TP}, count(*) FROM log GROUP BY ALL
      UNION ALL SELECT 'commit', {TP}, max("offset") + 1 FROM log GROUP BY ALL"""),
)
def _(spark, sf):
    root = fx.run_dir(spark, "h14")
    stream = source.committable(event_stream(spark, sf), EVERYTHING, "g1")

    def keep(column):
        write = delivery.append_records(f"{root}/{column}")
        return lambda batch, batch_id: write(batch.select(*model.TP, "offset", column), batch_id)

    query_ = delivery.multi_sink(
        stream, [keep("value"), keep("key")], delivery.append_commits(f"{root}/commits"),
        f"{root}/checkpoint",
    )
    query_.awaitTermination()
    count = F.count(F.lit(1)).alias("records")
    values = spark.read.parquet(f"{root}/value").groupBy(*model.TP).agg(count)
    keys = spark.read.parquet(f"{root}/key").groupBy(*model.TP).agg(count)
    committed = spark.read.parquet(f"{root}/commits").groupBy(*model.TP).agg(
        F.max("offset").alias("records")
    )
    parts = [("values", values), ("keys", keys), ("commit", committed)]
    out = [df.select(F.lit(name).alias("sink"), *model.TP, "records") for name, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "h15_unbatch",
    on_log(f"""SELECT {TP}, value, ("offset" % 7)::INTEGER AS pos,
      CASE WHEN "offset" % 7 = 6 OR "offset" = max("offset") OVER (PARTITION BY {TP}) THEN "offset" ELSE -1 END AS ctx_offset FROM log"""),
)
def _(spark, sf):
    groups = batching.grouped(fx.event_log(spark, sf), 7)
    ctx = F.struct(F.lit("g1").alias("group_id"), "offset")
    split = batching.unbatch(groups.withColumn("ctx", ctx).drop("offset"))
    return split.select(
        *model.TP, "value", "pos", F.coalesce("ctx.offset", F.lit(-1)).alias("ctx_offset")
    )


@query(
    "h16_recover",
    on_log(f"""SELECT {TP}, "offset", CASE WHEN arrival_seq % 97 = 0 THEN 'end-of-input' ELSE value END AS value
      FROM log WHERE NOT (arrival_seq % 97 = 0 AND arrival_seq % 2 = 0)"""),
)
def _(spark, sf):
    """A failing element becomes a sentinel; some sentinels are then filtered out."""
    failing = F.when(F.col("arrival_seq") % 97 != 0, F.col("value"))
    recovered = fx.event_log(spark, sf).withColumn(
        "value", F.coalesce(failing, F.lit("end-of-input"))
    )
    skip = (F.col("value") == "end-of-input") & (F.col("arrival_seq") % 2 == 0)
    return recovered.filter(~skip).select(*model.TP, "offset", "value")


@query("h17_two_topics_one_target", on_log(f"""SELECT 'merged' AS target, "key", value, {TP}, "offset" FROM log WHERE topic IN ('ev-click', 'ev-view')"""))
def _(spark, sf):
    pairs = source.committable(fx.event_log(spark, sf), subs.topics("ev-click", "ev-view"), "g1")
    out = pairs.withColumn(
        "records", envelope.single(envelope.record("merged", F.col("value"), key=F.col("key")))
    )
    return out.select("ctx", F.explode("records").alias("r")).select(
        F.col("r.topic").alias("target"), "r.key", "r.value", "ctx.topic", "ctx.partition", "ctx.offset"
    )
