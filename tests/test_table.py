"""Log tables: manifest, files cut at start offsets, time index."""

import datetime

import pytest
from pyspark.sql import functions as F

from streamlog import model
from streamlog.operators import meta, sharding
from streamlog.sources import partitioned, source, subs
from streamlog.sources.table import LogTable, partition_table

DAY = datetime.datetime(2024, 1, 1)


def records(spark, start, end, partitions=3):
    """Offsets ``start`` to ``end`` of each partition; timestamps jump back and forth."""
    return spark.range(start * partitions, end * partitions).select(
        F.lit("t").alias("topic"), (F.col("id") % partitions).cast("int").alias("partition"), F.expr(f"id div {partitions}").alias("offset"),
        (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(mins=F.expr(f"(id div {partitions}) * 10 - (id div {partitions}) % 7 * 25").cast("int"))).alias("timestamp"),
        F.lit(0).alias("timestamp_type"), F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"),
        F.array().cast(model.HEADERS).alias("headers"), F.col("id").alias("arrival_seq"),
    )


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    made = LogTable(spark, str(tmp_path_factory.mktemp("table")))
    made.declare(partition_table(spark, {"t": 5, "silent": 1}), "declared")
    for k in range(4):
        made.append(records(spark, k * 500, (k + 1) * 500), f"a{k}", file_records=100)
    return made


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def scanned(df):
    """Files that the plan reads from the table's appends."""
    return {f for f in df.inputFiles() if "/append=" in f and "/_manifest/" not in f}


def test_metadata_without_records(spark, table):
    ranges = {(r["topic"], r["partition"]): (r["begin_offset"], r["end_offset"]) for r in meta.offset_range(table).collect()}
    assert ranges == {("t", 0): (0, 2000), ("t", 1): (0, 2000), ("t", 2): (0, 2000), ("t", 3): (0, 0), ("t", 4): (0, 0), ("silent", 0): (0, 0)}
    assert {r["topic"]: r["partitions"] for r in meta.list_topics(table).collect()} == {"t": [0, 1, 2, 3, 4], "silent": [0]}
    wanted = partition_table(spark, {"t": 5})
    commits = spark.createDataFrame([("g", "t", 0, 7, "", 1)], "group_id string, topic string, partition int, offset bigint, metadata string, commit_seq bigint")
    groups = wanted.withColumn("group_id", F.lit("g"))
    sought = spark.createDataFrame([("t", 1, 3)], "topic string, partition int, offset bigint")
    for df in (
        meta.list_topics(table), meta.partitions_for(table, "t"), meta.offset_range(table), meta.beginning_offsets(table, wanted),
        meta.end_offsets(table, wanted, strict=True), meta.consumer_lag(table, commits, groups),
        meta.positions(table, wanted, meta.latest_commits(commits), sought),
    ):
        assert not scanned(df) and df.count()
    assert {r["lag"] for r in meta.consumer_lag(table, commits, groups).collect()} == {1993, 2000, 0}
    some = records(spark, 0, 50)
    sharded = sharding.with_shard_of_topic(some, table, "t")
    assert sharded.exceptAll(sharding.with_shard(some, 5)).isEmpty() and sharded.count() == 150
    with pytest.raises(Exception, match="unknown topic-partition"):
        meta.end_offsets(table, partition_table(spark, {"nowhere": 1}), strict=True).collect()


def test_files_are_runs_of_offsets(table):
    files = table.manifest().filter("file IS NOT NULL").orderBy("topic", "partition", "begin").collect()
    assert all(f["records"] == f["end"] - f["begin"] <= 100 for f in files)
    for a, b in zip(files, files[1:], strict=False):
        assert a["partition"] != b["partition"] or a["end"] == b["begin"]


def test_a_lagging_partition_does_not_widen_the_others(spark, table):
    starts = spark.createDataFrame([("t", 0, 0), ("t", 1, 1950), ("t", 2, 5000)], "topic string, partition int, start bigint")
    read = table.from_starts(starts)
    by_partition = {p: sum(f"partition={p}/" in f for f in scanned(read)) for p in range(3)}
    assert by_partition[0] >= 20 and by_partition[1] <= 2 and by_partition[2] == 0
    assert {r["partition"]: r["count"] for r in read.groupBy("partition").count().collect()} == {0: 2000, 1: 50}
    sub = subs.assignment_with_offset({("t", 0): 0, ("t", 1): 1950})
    assert subs.select(table, sub).count() == 2050
    later = spark.createDataFrame([("t", 1, 1990), ("t", 0, 1999)], "topic string, partition int, offset bigint")
    resumed = partitioned.from_offset_table(table, later, reset="latest")
    assert {r["partition"]: r["count"] for r in resumed.groupBy("partition").count().collect()} == {0: 1, 1: 10}


def test_assignments_read_their_folders_only(spark, table):
    named = spark.createDataFrame([("x", "t", 1), ("y", "t", 1)], "assignment string, topic string, partition int")
    shared = source.shared_assignments(table, named)
    assert shared.count() == 4000 and all("partition=1/" in f for f in scanned(shared))
    plain = spark.read.parquet(f"{table.path}/append=a0")
    text = source.shared_assignments(plain, named)._jdf.queryExecution().toString()
    scan = text[text.index("FileScan"):]
    assert "[t,1]" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]


def test_times_are_looked_up_in_few_files(spark, table):
    asked = [DAY + datetime.timedelta(minutes=m) for m in (-5, 0, 333, 4000, 19_000, 30_000)]
    times = spark.createDataFrame([("t", 0, at) for at in asked] + [("t", 3, DAY), ("nowhere", 0, DAY)], "topic string, partition int, at timestamp_ntz")
    found = {(r["topic"], r["partition"], r["at"]): (r["offset"], r["timestamp"]) for r in meta.offsets_for_times(table, times).collect()}
    every = [(r["offset"], r["timestamp"]) for r in table.records().filter("partition = 0").orderBy("offset").collect()]
    for at in asked:
        assert found["t", 0, at] == next(((o, t) for o, t in every if t >= at), (None, None))
    assert found["t", 3, DAY] == found["nowhere", 0, DAY] == (None, None) and len(found) == 8
    assert len(scanned(meta.offsets_for_times(table, times.filter("partition = 0")))) <= 5
    sub = subs.assignment_offsets_for_times({("t", 0): str(asked[3]), ("t", 1): "2030-01-01 00:00:00"})
    got = subs.select(table, sub, reset="latest")
    assert got.agg(F.min("offset")).first()[0] == found["t", 0, asked[3]][0] and got.filter("partition = 1").isEmpty()


def test_many_times_of_one_partition_stay_linear(spark, table):
    times = spark.range(10_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 3).cast("int"))).alias("at"),
    )
    found = meta.offsets_for_times(table, times)
    assert "array" not in plan(found).lower() and "collect_list" not in plan(found)
    wanted = meta.offsets_for_times(table.records(), times)
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty() and found.count() == 10_000


def test_an_append_is_all_or_nothing(spark, tmp_path):
    made = LogTable(spark, str(tmp_path))
    broken = records(spark, 0, 50).withColumn("value", F.when(F.col("offset") == 49, F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        made.append(broken, "one")
    assert made.offset_range().isEmpty() and made.records().isEmpty()
    assert made.append(records(spark, 0, 50), "one") and not made.append(records(spark, 0, 60), "one")
    assert made.records().count() == 150 and set(made.records().columns) == set(model.LOG.fieldNames())
