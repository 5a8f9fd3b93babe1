"""Commits up to the contiguous front, and sinks that are logs."""

import random

import pytest
from pyspark.sql import functions as F

from streamlog import model
from streamlog.sources.table import LogTable
from streamlog.streaming import frontier, sink
from streamlog.streaming.frontier import Frontier

CTX = "group_id string, topic string, partition int, offset bigint, metadata string"


def contexts(spark, offsets, partition=0):
    rows = [("g", "t", partition, o, f"m{o}") for o in offsets]
    return spark.createDataFrame(rows, CTX).select(F.struct(*[c.split()[0] for c in CTX.split(", ")]).alias("ctx"))


@pytest.fixture()
def running(monkeypatch):
    """The id of the query that is taken to run."""
    now = {"id": "q1"}
    monkeypatch.setattr(frontier, "running_query", lambda _: now["id"])
    return now


def plain_runs(offsets):
    out = []
    for o in sorted(set(offsets)):
        if out and out[-1][1] == o:
            out[-1][1] = o + 1
        else:
            out.append([o, o + 1])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_and_merge_are_a_set_of_intervals(spark, seed):
    draw = random.Random(seed)
    offsets = [draw.randrange(200) for _ in range(120)]
    found = frontier.runs(contexts(spark, offsets).select("ctx.*"), chunk_bits=draw.choice([2, 4, 17]))
    merged = frontier.merge(found.withColumn("front", F.lit(False))).orderBy("from").collect()
    assert [[r["from"], r["to"]] for r in merged] == plain_runs(offsets)
    assert all(r["metadata"] == f"m{r['to'] - 1}" for r in merged)


@pytest.mark.parametrize("seed", range(2))
def test_the_front_never_skips(spark, tmp_path, running, seed):
    """Micro-batches in any order, some repeated, under a second query as well."""
    draw = random.Random(seed)
    offsets = list(range(5, 60))
    draw.shuffle(offsets)
    batches = [offsets[:20], offsets[15:38], offsets[38:50], offsets[50:]]
    starts = spark.createDataFrame([("t", 0, 5)], "topic string, partition int, start bigint")
    front, done = Frontier(spark, str(tmp_path), starts), set()
    for n, batch in enumerate(batches):
        running["id"], number = ("q1", n) if n < 2 else ("q2", n - 2)
        for _ in range(draw.choice([1, 2])):  # a replay changes nothing
            front.write(contexts(spark, batch), number)
        done |= set(batch)
        assert front.is_committed(spark, number) and not front.is_committed(spark, number + 1)
        wanted = next(o for o in range(5, 61) if o not in done)
        ((offset, metadata),) = [(r["offset"], r["metadata"]) for r in front.fronts().collect()]
        assert offset == wanted and metadata == (f"m{wanted - 1}" if wanted > 5 else None)
    told = [(r["commit_seq"], r["offset"]) for r in front.commits().collect()]
    assert sorted(told) == sorted(told, key=lambda x: x[1]) and max(o for _, o in told) == 60
    assert front.state().count() == 1  # one interval is left


def test_topic_partitions_do_not_mix(spark, tmp_path, running):
    front = Frontier(spark, str(tmp_path))
    front.write(contexts(spark, [0, 1, 2], 0).unionByName(contexts(spark, [1, 2], 1)), 0)
    assert {r["partition"]: r["offset"] for r in front.fronts().collect()} == {0: 3, 1: 0}
    front.write(contexts(spark, [0], 1), 1)
    assert {r["partition"]: r["offset"] for r in front.fronts().collect()} == {0: 3, 1: 3}
    assert [(r["partition"], r["offset"]) for r in front.commits().orderBy("commit_seq").collect()] == [(0, 3), (1, 3)]


def test_a_sink_is_a_log(spark, tmp_path):
    table = LogTable(spark, f"{tmp_path}/log")
    rows = lambda a, b: spark.range(a, b).select(
        F.lit("t").alias("topic"), F.when(F.col("id") % 2 == 0, (F.col("id") % 3).cast("int")).alias("partition"),
        F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("seq"),
    )
    assert sink.append(table, rows(0, 100), "one", ["seq"], partitions=3)
    assert not sink.append(table, rows(0, 100), "one", ["seq"], partitions=3)
    assert sink.append(table, rows(100, 150), "two", ["seq"], partitions=3)
    got = table.records().orderBy("partition", "offset").collect()
    assert sorted(int(r["value"]) for r in got) == list(range(150))
    for p in range(3):
        own = [r for r in got if r["partition"] == p]
        assert [r["offset"] for r in own] == list(range(len(own))) and [int(r["value"]) for r in own] == sorted(int(r["value"]) for r in own)
    assert {(r["topic"], r["partition"]) for r in table.offset_range().collect()} == {("t", p) for p in range(3)}
    assert set(table.records().columns) == set(model.LOG.fieldNames())
    with pytest.raises(Exception, match="without partition"):
        sink.append(table, rows(0, 10), "three", ["seq"])
