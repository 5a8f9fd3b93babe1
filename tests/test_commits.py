import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamlog.operators import commits
from streamlog.streaming import txn

SCHEMA = (
    "arrival_seq bigint, group_id string, topic string, partition int, offset bigint, "
    "metadata string, batch_size bigint"
)


def table(spark, rows):
    """rows: (group, topic, partition, offset) in arrival order."""
    full = [(i, g, t, p, o, f"m{i}", 1) for i, (g, t, p, o) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def gtps(df, *columns):
    return {(r.group_id, r.topic, r.partition): tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize(
    "offsets, expected",
    [
        ([("A", 12)], {"A": 12}),
        ([("A", 42), ("A", 12)], {"A": 42}),
        ([("A", 12), ("A", 42)], {"A": 42}),
        ([("A", 42), ("B", 11), ("A", 12), ("B", 43)], {"A": 42, "B": 43}),
    ],
)
def test_aggregate_keeps_the_highest(spark, offsets, expected):
    df = table(spark, [("g", t, 1, o) for t, o in offsets])
    got = {r.topic: r.offset for r in commits.aggregate_offsets(df).collect()}
    assert got == expected


def test_aggregate_keeps_the_earliest_of_equals(spark):
    df = table(spark, [("g", "A", 1, 5), ("g", "A", 1, 7), ("g", "A", 1, 7)])
    assert commits.aggregate_offsets(df).first().metadata == "m1"


def test_batch_takes_the_last_even_if_lower(spark):
    df = table(spark, [("g", "A", 1, 42), ("g", "A", 1, 12)])
    batch = commits.offset_batch(df)
    assert gtps(batch, "offset", "metadata", "updates") == {("g", "A", 1): (13, "m1", 2)}
    assert gtps(commits.offsets(batch), "offset") == {("g", "A", 1): (12,)}


def test_transaction_takes_the_highest(spark):
    df = table(spark, [("g", "A", 1, 42), ("g", "A", 1, 12), ("g", "B", 0, 3)])
    got = txn.require_single_group(txn.batch_offsets(df))
    assert gtps(got, "offset") == {("g", "A", 1): (43,), ("g", "B", 0): (4,)}


def test_transaction_of_two_groups_fails(spark):
    df = table(spark, [("g", "A", 1, 42), ("h", "A", 1, 12)])
    with pytest.raises(PySparkException, match="must not mix groups"):
        txn.require_single_group(txn.batch_offsets(df)).collect()


def test_two_groups_stay_apart(spark):
    rows = [(g, "A", p, o) for o in range(5) for p in (0, 1) for g in ("g1", "g2")]
    batch = commits.with_batch_size(commits.offset_batch(table(spark, rows)))
    got = gtps(batch, "offset", "batch_size")
    assert got == {(g, "A", p): (5, 20) for g in ("g1", "g2") for p in (0, 1)}


def test_filtered_batch_counts_partitions(spark):
    rows = [("g", t, 0, o) for o in range(4) for t in "ABC"]
    kept = commits.filter_batch(commits.offset_batch(table(spark, rows)), F.col("topic") != "C")
    assert {r.batch_size for r in commits.with_batch_size(kept).collect()} == {2}


def test_merge_lets_the_later_batch_win(spark):
    first = commits.offset_batch(table(spark, [("g", "A", 0, 9), ("g", "B", 0, 1)]))
    second = commits.offset_batch(table(spark, [("g", "A", 0, 3)]))
    merged = commits.merge_batches(
        first.withColumn("batch_seq", F.lit(1)).unionByName(second.withColumn("batch_seq", F.lit(2)))
    )
    assert gtps(merged, "offset", "updates") == {("g", "A", 0): (4, 2), ("g", "B", 0): (2, 1)}


def test_next_observed_commits_all_but_the_last(spark):
    df = table(spark, [("g", "A", 0, o) for o in (1, 2, 3)])
    batches = commits.batch_flow(df, 1, when="next_observed").orderBy("batch").collect()
    assert [b.offset - 1 for b in batches] == [1, 2]


def test_next_observed_of_two_partitions(spark):
    df = table(spark, [("g", "A", p, o) for p, o in ((1, 1), (2, 1), (1, 2), (2, 2), (1, 3))])
    batches = commits.batch_flow(df, 1, when="next_observed").orderBy("batch").collect()
    assert [(b.partition, b.offset - 1) for b in batches] == [(1, 1), (2, 1), (1, 2)]


def test_next_observed_ignores_lower_and_equal(spark):
    df = table(spark, [("g", "A", 0, o) for o in (5, 3, 5, 6, 6, 2, 9)])
    got = commits.next_observed(df).orderBy("arrival_seq").collect()
    assert [(r.offset, r.metadata, r.arrival_seq) for r in got] == [(5, "m0", 3), (6, "m3", 6)]


def test_next_observed_against_a_fold(spark):
    rng = random.Random(9)
    rows = [("g", rng.choice("AB"), rng.randrange(2), rng.randrange(60)) for _ in range(300)]
    deferred, expected = {}, []
    for seq, (g, t, p, o) in enumerate(rows):
        before = deferred.get((g, t, p))
        if before is None or before < o:
            if before is not None:
                expected.append((t, p, before, seq))
            deferred[g, t, p] = o
    handed_over = commits.next_observed(table(spark, rows), chunk_bits=3).collect()
    got = [(r.topic, r.partition, r.offset, r.arrival_seq) for r in handed_over]
    assert sorted(got) == sorted(expected)


def test_batches_close_by_size(spark):
    rng = random.Random(2)
    rows = [("g", rng.choice("AB"), 0, i) for i in range(25)]
    batches = commits.batch_flow(table(spark, rows), 10)
    sizes = {r.batch: r.batch_size for r in commits.flow(batches).collect()}
    assert sizes == {0: 10, 1: 10, 2: 5}


def test_sized_committables_close_early(spark):
    sizes = [4, 4, 4, 12, 1, 9]
    df = table(spark, [("g", "A", 0, i) for i in range(6)]).withColumn(
        "batch_size", F.element_at(F.array(*map(F.lit, sizes)), (F.col("arrival_seq") + 1).cast("int")).cast("bigint")
    )
    batches = commits.batch_flow(df, 10).orderBy("batch").collect()
    assert [(b.offset - 1, b.updates) for b in batches] == [(2, 12), (3, 12), (5, 10)]


def test_refresh_only_overdue_and_in_step(spark):
    df = spark.createDataFrame(
        [("A", 0, 5, 5, 0), ("A", 1, 6, 5, 0), ("A", 2, 5, 5, 90)],
        "topic string, partition int, requested bigint, committed bigint, last_commit int",
    )
    due = commits.refresh_due(df, F.lit(100), F.lit(60)).collect()
    assert [(r.partition, r.offset) for r in due] == [(0, 5)]


def test_only_assigned(spark):
    df = commits.offset_batch(table(spark, [("g", "A", 0, 1), ("g", "A", 1, 1)]))
    assigned = spark.createDataFrame([("A", 1)], "topic string, partition int")
    assert list(gtps(commits.only_assigned(df, assigned), "offset")) == [("g", "A", 1)]


def test_batches_hand_over_on_equal_offsets(spark):
    rows = [("g", "t", 0, o, f"m{k}", k, 3) for k, o in enumerate([5, 9, 9, 12])]
    schema = "group_id string, topic string, partition int, offset bigint, metadata string, arrival_seq bigint, batch_size bigint"
    handed = commits.next_observed(spark.createDataFrame(rows, schema)).orderBy("arrival_seq").collect()
    assert [(r["offset"], r["metadata"], r["batch_size"]) for r in handed] == [(5, "m0", 1), (9, "m1", 1), (9, "m2", 1)]


def test_declared_single_input_is_checked(spark):
    rows = [("g", "t", 0, 1, "m", 0, 2)]
    schema = "group_id string, topic string, partition int, offset bigint, metadata string, arrival_seq bigint, batch_size bigint"
    with pytest.raises(Exception, match="not a single committable"):
        commits.batch_flow(spark.createDataFrame(rows, schema), 10, single=True).collect()
