import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamlog.operators import batching, meta, metrics, progress, protect, rebalance, verify
from streamlog.sources import partitioned

POLLS = (
    "poll_batch bigint, arrival_seq bigint, topic string, partition int, offset bigint, timestamp timestamp_ntz"
)
T0 = datetime.datetime(2024, 1, 1)
OFFSETS = "topic string, partition int, offset bigint"


def polls(spark, rows):
    """rows: (poll_batch, partition, offset, milliseconds or None)."""
    full = [
        (b, i, "t", p, o, None if ms is None else T0 + datetime.timedelta(milliseconds=ms))
        for i, (b, p, o, ms) in enumerate(rows)
    ]
    return spark.createDataFrame(full, POLLS)


def offsets(spark, *rows):
    return spark.createDataFrame([("t", *r) for r in rows], OFFSETS)


def passed(df):
    return sorted((r.poll_batch, r.partition, r.offset) for r in df.collect())


def test_rewound_poll_is_dropped_and_sought(spark):
    records, requested = polls(spark, [(0, 0, 1, None)]), offsets(spark, (0, 100))
    assert passed(protect.reset_filter(records, requested, offset_threshold=10)) == []
    seeks = protect.seeks(records, requested, offsets(spark, (0, 100)), offset_threshold=10).collect()
    assert [(r.seek_offset, r.far_behind) for r in seeks] == [(100, False)]
    far = protect.seeks(records, requested, offsets(spark, (0, 50)), offset_threshold=10).first()
    assert far.far_behind


def test_polls_are_judged_by_what_was_requested_before_them(spark):
    records = polls(spark, [(0, 0, 1, None), (1, 0, 100, None), (2, 0, 200, None), (3, 0, 95, None), (4, 0, 201, None)])
    asked = spark.createDataFrame([("t", 0, 2, 1), ("t", 0, 101, 2)], OFFSETS + ", poll_batch bigint")
    safe = protect.reset_filter(records, asked, offset_threshold=5)
    assert passed(safe) == [(0, 0, 1), (1, 0, 100), (2, 0, 200), (4, 0, 201)]
    acked = spark.createDataFrame([("t", 0, 2, 2), ("t", 0, 101, 3)], OFFSETS + ", poll_batch bigint")
    sought = protect.seeks(records, asked, acked, offset_threshold=5).collect()
    assert [(r.poll_batch, r.seek_offset, r.far_behind) for r in sought] == [(3, 2, True)]


def test_large_offset_threshold_passes(spark):
    records, requested = polls(spark, [(0, 0, 1, 0)]), offsets(spark, (0, 100))
    safe = protect.reset_filter(
        records, requested, offset_threshold=1 << 40, time_threshold=datetime.timedelta(days=1)
    )
    assert passed(safe) == [(0, 0, 1)]


def test_older_records_than_received_are_dropped(spark):
    rows = [(0, 0, 100, 100_000), (1, 0, 90, 10_000), (2, 0, 101, 100_500)]
    safe = protect.reset_filter(
        polls(spark, rows), offsets(spark, (0, 100)), offset_threshold=1 << 40,
        time_threshold=datetime.timedelta(milliseconds=50),
    )
    assert passed(safe) == [(0, 0, 100), (2, 0, 101)]


def test_records_without_timestamp_are_not_judged_by_time(spark):
    rows = [(0, 0, 100, 100_000), (1, 0, 90, None)]
    safe = protect.reset_filter(
        polls(spark, rows), offsets(spark, (0, 100)), offset_threshold=1 << 40,
        time_threshold=datetime.timedelta(milliseconds=50),
    )
    assert len(passed(safe)) == 2


def test_dropped_poll_does_not_become_the_reference(spark):
    rows = [(0, 0, 100, 1_000), (1, 0, 5, 9_000), (2, 0, 101, 1_010)]
    safe = protect.reset_filter(
        polls(spark, rows), offsets(spark, (0, 100)), offset_threshold=10,
        time_threshold=datetime.timedelta(milliseconds=50),
    )
    assert passed(safe) == [(0, 0, 100), (2, 0, 101)]


def test_unknown_partition_passes(spark):
    records = polls(spark, [(0, 1, 1, None)])
    assert passed(protect.reset_filter(records, offsets(spark, (0, 100)), offset_threshold=10)) == [(0, 1, 1)]


def test_only_first_and_last_are_looked_at(spark):
    records = polls(spark, [(0, 0, 101, None), (0, 0, 1, None), (0, 0, 102, None)])
    assert len(passed(protect.reset_filter(records, offsets(spark, (0, 100)), offset_threshold=10))) == 3


def test_progress_after_revoke_and_assign(spark):
    events = [
        (1, "assign", 0, 10), (2, "requested", 0, 15), (3, "committed", 0, 15), (4, "assign", 0, 99),
        (5, "assign", 1, 7), (6, "revoke", 1, None), (7, "assign", 2, 3), (8, "revoke", 2, None), (9, "assign", 2, 4),
    ]
    df = spark.createDataFrame([(s, k, "t", p, o) for s, k, p, o in events], "seq bigint, kind string, " + OFFSETS)

    def state(seq=None):
        return {r.partition: (r.requested, r.committed) for r in progress.state_at(df, seq).collect()}

    assert state() == {0: (15, 15), 2: (4, 4)}
    assert state(2) == {0: (15, 10)}
    assert state(5) == {0: (15, 15), 1: (7, 7)}


def test_in_flight_until_that_offset_is_committed(spark):
    records = polls(spark, [(0, 0, 1, None), (0, 0, 2, None), (0, 1, 8, None)])
    left = progress.in_flight(records, offsets(spark, (0, 2), (1, 7)))
    assert [(r.partition, r.offset) for r in left.collect()] == [(1, 8)]


def test_unknown_partition_fails_when_strict(spark):
    log = polls(spark, [(0, 0, 3, None)])
    asked = offsets(spark, (0, 0), (9, 0))
    assert {r.partition: r.end_offset for r in meta.end_offsets(log, asked).collect()} == {0: 4, 9: 0}
    for lookup in (meta.end_offsets, meta.beginning_offsets):
        with pytest.raises(PySparkException, match="unknown topic-partition"):
            lookup(log, asked, strict=True).collect()


def test_lag_counts_from_the_start_without_a_commit(spark):
    log = polls(spark, [(0, p, o, None) for p in (0, 1) for o in range(5, 15)])
    commits = spark.createDataFrame(
        [("g", "t", 0, 12, "", 1)],
        "group_id string, topic string, partition int, offset bigint, metadata string, commit_seq bigint",
    )
    groups = spark.createDataFrame([("g", "t", 0), ("g", "t", 1)], "group_id string, topic string, partition int")
    assert {r.partition: r.lag for r in meta.consumer_lag(log, commits, groups).collect()} == {0: 3, 1: 10}


def test_rebalance_events(spark):
    rows = [(0, "a", "t", 0), (0, "a", "t", 1), (1, "a", "t", 0), (1, "b", "t", 1)]
    df = spark.createDataFrame(rows, "epoch int, member string, topic string, partition int")
    got = {(r.epoch, r.member, r.partition, r.event) for r in rebalance.events(df).collect()}
    assert got == {
        (0, "a", 0, "assigned"), (0, "a", 1, "assigned"), (1, "a", 1, "revoked"), (1, "b", 1, "assigned"),
    }


def test_resume_from_first_unread(spark):
    log = polls(spark, [(0, p, o, None) for p in (0, 1) for o in range(6)])
    done = log.filter("partition = 1 OR offset IN (0, 1, 4)")
    assert [(r.partition, r.resume_offset) for r in partitioned.resume_points(log, done).collect()] == [(0, 2)]


def test_take_while_includes_the_failing_record(spark):
    log = polls(spark, [(0, 0, o, None) for o in range(10)])
    keep = F.col("offset") < 4
    inclusive = batching.take_while(log, keep, inclusive=True)
    assert sorted(r.offset for r in inclusive.collect()) == [0, 1, 2, 3, 4]
    assert batching.take_while(log, keep).count() == 4


def test_missing_values_in_blocks(spark):
    expected = spark.range(1, 1001).withColumnRenamed("id", "v")
    gone = set(range(10, 31)) | {500} | {999, 1000}
    observed = expected.filter(~F.col("v").isin(*gone))
    got = sorted((r["first"], r["last"], r["size"], r["first_ten"]) for r in verify.missing_blocks(expected, observed).collect())
    assert got == [(10, 30, 21, list(range(10, 20))), (500, 500, 1, [500]), (999, 1000, 2, [999, 1000])]


def test_duplicates_beyond_the_expected_number(spark):
    rows = [("a", "t", 0, 0), ("a", "t", 0, 1), ("b", "t", 0, 2), ("b", "t", 0, 2), ("c", "t", 1, 0), ("c", "t", 0, 5), ("c", "t", 0, 6)]
    df = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")
    assert {r.value: r.copies for r in verify.duplicates(df).collect()} == {"a": 2, "c": 3}
    assert {r.value for r in verify.duplicates(df, expected=2).collect()} == {"c"}


def test_metrics(spark):
    rows = [("c", "counter", 1, 10.0), ("c", "counter", 3, 25.0), ("g", "gauge", 1, 2.0), ("g", "gauge", 2, 4.0)]
    df = spark.createDataFrame(rows, "metric string, kind string, at int, value double")
    assert {r.metric: r.value for r in metrics.summarise(df).collect()} == {"c": 15.0, "g": 4.0}
    assert {r.metric: r.value for r in metrics.summarise(df, gauge="mean").collect()} == {"c": 15.0, "g": 3.0}
