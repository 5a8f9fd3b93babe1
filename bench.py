"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from streamlog.functions import context
from streamlog.operators import commits
from streamlog.plans import catalog, fixtures
from streamlog.sources import partitioned, source, subs

HEADLINE = [
    "b14_log_table",
    "a01_plain_source",
    "a06_plain_partitioned",
    "a06_plain_partitioned_numbered",
    "a19_assignment",
    "a20_assignment_with_offset",
    "a21_offsets_for_times",
    "c01_offset_batch",
    "c05_batch_flow",
    "c05_batch_flow_sized",
    "c11_next_observed",
    "c11_next_observed_flow",
    "h07_grouped",
    "h09_sums_and_concats",
    "b02_flexi_flow_results",
    "d05_offsets_for_times",
    "d09_consumer_lag",
    "d13_reset_filter",
    "d14_time_reset_filter",
    "d21_gaps",
    "e02_json_resume",
    "f01_shard_id",
    "f04_locate",
    "v01_duplicates",
    "v02_missing_blocks",
    "v03_partition_sequence_broken",
    "c06_batch_flow_interval",
    "b11_committable_sink_records",
    "g01_exactly_once",
]


# Log partitions per topic for the plain scan, batched commits and routing.
PARTITION_AXIS = (1, 8, 100)
COMMIT_BATCH = 1000


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("streamlog-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    # The logs the queries scan are written once, as tables; building the event
    # log is timed by its own query, and the first one also warms the JVM up.
    fixtures.event_log_path(spark, sf_dir)
    fixtures.order_log(spark, sf_dir)
    fixtures.ordered_stream_path(spark, sf_dir)

    seconds: dict[str, float] = {}
    rows: dict[str, float] = {}
    events = fixtures.table(spark, sf_dir, "events").count()
    for name in HEADLINE:
        began = time.perf_counter()
        consume(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - began, 3)
        rows[name] = round(events / seconds[name])
    for n in PARTITION_AXIS:
        log = fixtures.event_log_of(spark, sf_dir, n)
        plain = source.plain(log, subs.topic_pattern("ev-.*"))
        pairs = context.with_context(plain, "g1")
        shapes = {
            "scan": plain,
            "commit": commits.batch_flow(context.committables(pairs, seq="arrival_seq"), COMMIT_BATCH, single=True),
            "route": partitioned.numbered(plain),
        }
        for shape, df in shapes.items():
            name = f"{shape}_{n}_partitions"
            began = time.perf_counter()
            consume(df)
            seconds[name] = round(time.perf_counter() - began, 3)
            rows[name] = round(events / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "log_records": events,
                "log_records_per_sec": rows,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
