"""Chunked computations against plain Python, with chunks of four numbers."""

import random

import pytest
from pyspark.sql import functions as F

from streamlog.functions import ordered
from streamlog.sources import log

BITS = 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [
        (key, seq, rng.choice([None, *range(20)]))
        for key in ("a", "b", "c")
        for seq in rng.sample(range(60), {"a": 1, "b": 17, "c": 45}[key])
    ]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, seq bigint, v bigint")


def by_key(rows):
    keys = sorted({k for k, _, _ in rows})
    return {k: sorted((s, v) for key, s, v in rows if key == k) for k in keys}


def result(df, name):
    return {(r.k, r.seq): r[name] for r in df.collect()}


def test_row_number(df, rows):
    got = result(ordered.row_number(df, ["k"], "seq", bits=BITS), "rn")
    assert got == {
        (k, s): i for k, seqs in by_key(rows).items() for i, (s, _) in enumerate(seqs, 1)
    }


def test_row_number_without_keys(df, rows):
    only_c = df.filter("k = 'c'")
    got = result(ordered.row_number(only_c, [], "seq", bits=BITS), "rn")
    assert got == {("c", s): i for i, (s, _) in enumerate(by_key(rows)["c"], 1)}


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sum(df, rows, inclusive):
    got = result(
        ordered.running_sum(df, ["k"], "seq", F.col("v"), name="s", inclusive=inclusive, bits=BITS), "s"
    )
    for k, seqs in by_key(rows).items():
        total = 0
        for s, v in seqs:
            before, total = total, total + (v or 0)
            assert got[k, s] == (total if inclusive else before)


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_max(df, rows, inclusive):
    got = result(
        ordered.running_max(df, ["k"], "seq", F.col("v"), name="m", inclusive=inclusive, bits=BITS), "m"
    )
    for k, seqs in by_key(rows).items():
        seen = []
        for s, v in seqs:
            before = max(seen, default=None)
            seen += [] if v is None else [v]
            assert got[k, s] == (max(seen, default=None) if inclusive else before)


def test_lead(df, rows):
    got = result(ordered.lead(df, ["k"], "seq", "seq", name="n", bits=BITS), "n")
    for k, seqs in by_key(rows).items():
        following = [s for s, _ in seqs[1:]] + [None]
        assert [got[k, s] for s, _ in seqs] == following


def test_offsets_by_sequence_and_by_sort_agree(spark):
    rng = random.Random(1)
    data = [("t", rng.randrange(3), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(data, "topic string, partition int, at int, seq bigint")
    base = spark.createDataFrame([("t", 1, 1000)], "topic string, partition int, end_offset bigint")
    expected = {}
    for p in range(3):
        mine = sorted((at, seq) for _, part, at, seq in data if part == p)
        expected |= {seq: i + (1000 if p == 1 else 0) for i, (_, seq) in enumerate(mine)}
    placed = log.place_sorted(df, order_by=["at", "seq"], base=base)
    assert {r.seq: r.offset for r in placed.records.collect()} == expected
    ends = {r.partition: r.end_offset for r in placed.ends.collect()}
    assert ends == {
        p: sum(d[1] == p for d in data) + (1000 if p == 1 else 0) for p in range(3)
    }
    by_seq = log.append_offsets(df, seq="seq", base=base)
    for p in range(3):
        offsets = [r.offset for r in by_seq.filter(F.col("partition") == p).orderBy("seq").collect()]
        assert offsets == [i + (1000 if p == 1 else 0) for i in range(len(offsets))]


def test_hot_partition_spans_several_ranges(spark):
    """Half of all records in one topic-partition are sorted by several tasks."""
    df = spark.range(0, 40_000, 1, 8).select(
        F.lit("t").alias("topic"),
        F.when(F.col("id") % 2 == 0, 0).otherwise((F.col("id") % 7).cast("int")).alias("partition"),
        (40_000 - F.col("id")).alias("at"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sorted_ranges = df.repartitionByRange("topic", "partition", "at").withColumn(
            "r", F.spark_partition_id()
        )
        spans = sorted_ranges.filter("partition = 0").select("r").distinct().count()
        records = log.append_offsets_sorted(df, order_by=["at"])
        summary = records.groupBy("partition").agg(
            F.count("*").alias("n"), F.countDistinct("offset").alias("d"), F.max("offset").alias("m")
        ).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spans > 1
    assert all(r.n == r.d == r.m + 1 for r in summary)
