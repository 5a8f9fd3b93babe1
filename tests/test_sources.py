import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import context
from streamlog.operators import meta
from streamlog.sources import log, partitioned, source, subs

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    """Two topics of two partitions with 100 records each, a millisecond apart."""
    df = spark.range(400).select(
        F.concat(F.lit("topic-"), (F.col("id") % 2).cast("string")).alias("topic"),
        F.expr("cast(id div 2 % 2 as int)").alias("partition"),
        F.expr("id div 4").alias("offset"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=F.expr("id div 4") / 1000)).alias("timestamp"),
        F.lit(0).alias("timestamp_type"),
        F.lit("key").alias("key"),
        (F.expr("id div 4") + 1).cast("string").alias("value"),
        F.array().cast(model.HEADERS).alias("headers"),
        F.col("id").alias("arrival_seq"),
    )
    path = str(tmp_path_factory.mktemp("log") / "table")
    log.write(df, path)
    return path


@pytest.fixture(scope="module")
def records(spark, path):
    return log.read(spark, path)


def values(df):
    return sorted(int(r.value) for r in df.collect())


def test_start_at_a_time_reads_from_that_offset_on(records):
    at = START + datetime.timedelta(milliseconds=50)
    sub = subs.assignment_offsets_for_times({("topic-0", 0): str(at)})
    assert values(subs.select(records, sub)) == list(range(51, 101))


def test_start_at_a_time_of_an_empty_partition(records):
    sub = subs.assignment_offsets_for_times({("topic-9", 0): "2024-01-01 00:00:00"})
    assert values(subs.select(records, sub)) == []


def test_no_match_falls_back_to_commit_then_policy(spark, records):
    sub = subs.assignment_offsets_for_times({("topic-0", 0): "2030-01-01", ("topic-0", 1): "2030-01-01"})
    committed = spark.createDataFrame([("topic-0", 0, 90)], "topic string, partition int, offset bigint")
    assert values(subs.select(records, sub, committed=committed)) == sorted([*range(91, 101), *range(1, 101)])
    latest = subs.select(records, sub, committed=committed, reset="latest")
    assert values(latest) == list(range(91, 101))


def test_patterns_match_whole_names(records):
    assert subs.select(records, subs.topic_pattern("topic")).count() == 0
    assert subs.select(records, subs.topic_pattern("topic-[01]")).count() == 400
    assert subs.select(records, subs.topic_pattern("topic-0|x")).count() == 200


def test_long_lists(records):
    many = {("topic-1", p): 95 for p in range(400)}
    assert values(subs.select(records, subs.assignment_with_offset(many))) == sorted(2 * [96, 97, 98, 99, 100])
    assert subs.select(records, subs.assignment(*many)).count() == 200


def test_assignment_prunes_folders_and_row_groups(records):
    plan = subs.select(records, subs.assignment_with_offset({("topic-0", 1): 10}))._jdf.queryExecution().toString()
    scan = plan[plan.index("FileScan") :]
    assert "topic-0" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "GreaterThanOrEqual(offset,10)" in scan


def folders_and_filters(df):
    plan = df._jdf.queryExecution().toString()
    scan = plan[plan.index("FileScan"):]
    return scan[scan.index("PartitionFilters"):scan.index("PushedFilters")], scan[scan.index("PushedFilters"):]


def test_five_thousand_topic_partitions_still_prune(records):
    many = {("topic-0", p): 90 + p for p in range(5000)}
    for selected in (subs.assignment(*many), subs.assignment_with_offset(many)):
        folders, pushed = folders_and_filters(subs.select(records, selected))
        assert "topic" in folders and "partition" in folders and ("IN" in folders or "INSET" in folders)
    assert "GreaterThanOrEqual(offset,90)" in pushed
    assert values(subs.select(records, subs.assignment_with_offset(many))) == [*sorted([*range(91, 101), *range(92, 101)])]


def test_resuming_a_group_prunes(spark, records):
    commits = spark.createDataFrame(
        [("g", "topic-0", p, 60 + p, "", 1) for p in (0, 1)] + [("g", "topic-1", p, 70, "", 1) for p in (0, 1)],
        "group_id string, topic string, partition int, offset bigint, metadata string, commit_seq bigint",
    )
    folders, pushed = folders_and_filters(source.for_group(records, commits, "g"))
    assert "topic-0" in folders and "GreaterThanOrEqual(offset,60)" in pushed


def test_reset_none_fails_without_an_offset(spark, records):
    ranges = meta.offset_range(records)
    committed = spark.createDataFrame([("topic-0", 0, 90)], "topic string, partition int, offset bigint")
    with pytest.raises(PySparkException, match="no offset for"):
        subs.resolve_start(ranges, committed, reset="none").collect()
    with pytest.raises(ValueError):
        subs.resolve_start(ranges, committed, reset="sometimes")


def test_group_resumes_after_its_commit(spark, records):
    commits = spark.createDataFrame(
        [("g", "topic-0", 0, 40, "", 1), ("g", "topic-0", 0, 60, "", 2)],
        "group_id string, topic string, partition int, offset bigint, metadata string, commit_seq bigint",
    )
    one = records.filter("topic = 'topic-0' AND partition = 0")
    assert values(source.for_group(one, commits, "g")) == list(range(61, 101))
    assert values(source.for_group(one, commits, "other")) == list(range(1, 101))


def test_context_survives_mapping(records):
    pairs = source.committable(records, subs.topics("topic-0"), "g", metadata=F.col("value"))
    row = context.map_data(pairs, F.upper("key").alias("k")).filter("ctx.offset = 7").first()
    assert (row.k, row.ctx.group_id, row.ctx.metadata) == ("KEY", "g", "8")
    with pytest.raises(ValueError):
        context.with_context(records, "")


def test_missing_metadata_is_empty(records):
    pairs = source.committable(records, subs.topics("topic-0"), "g", metadata=F.lit(None))
    assert pairs.first().ctx.metadata == model.NO_METADATA


def test_user_code_sees_each_partition_in_order(spark, records):
    def code(frames):
        for frame in frames:
            assert len(frame[["topic", "partition"]].drop_duplicates()) == 1
            assert frame["offset"].is_monotonic_increasing
            yield frame[["topic", "partition", "offset"]]

    out = partitioned.apply_per_partition(
        records.select("topic", "partition", "offset"), code, "topic string, partition int, offset bigint", chunk_bits=3
    )
    assert out.count() == 400


def test_manual_offsets(spark, records):
    starts = spark.createDataFrame([("topic-0", 0, 99)], "topic string, partition int, offset bigint")
    assert partitioned.from_offset_table(records, starts).count() == 301
    assert partitioned.from_offset_table(records, starts, reset="latest").count() == 1


@pytest.mark.parametrize(
    "sub, expected",
    [
        (subs.topics("a", "b"), {"subscribe": "a,b"}),
        (subs.topic_pattern("a.*"), {"subscribePattern": "a.*"}),
        (subs.assignment(("a", 0), ("a", 2), ("b", 1)), {"assign": {"a": [0, 2], "b": [1]}}),
        (
            subs.assignment_with_offset({("a", 0): 5, ("b", 1): 7}),
            {"assign": {"a": [0], "b": [1]}, "startingOffsets": {"a": {"0": 5}, "b": {"1": 7}}},
        ),
        (
            subs.assignment_offsets_for_times({("a", 0): 1700000000000}),
            {"assign": {"a": [0]}, "startingOffsetsByTimestamp": {"a": {"0": 1700000000000}}},
        ),
    ],
)
def test_kafka_options(sub, expected):
    options = subs.to_kafka_options(sub, "host:9092", read_committed=True)
    assert options["kafka.bootstrap.servers"] == "host:9092"
    assert options["kafka.isolation.level"] == "read_committed"
    for name, value in expected.items():
        assert (options[name] if isinstance(value, str) else json.loads(options[name])) == value
    if "startingOffsetsByTimestamp" not in expected and "startingOffsets" not in expected:
        assert options["startingOffsets"] == "earliest"


@pytest.mark.parametrize(
    "sub",
    [
        subs.topics("topic-1"), subs.topic_pattern(".*-0"), subs.assignment(("topic-0", 1)),
        subs.assignment_with_offset({("topic-0", 1): 42}),
        subs.assignment_offsets_for_times({("topic-1", 0): "2024-01-01 00:00:00.080"}),
    ],
)
def test_stream_reads_what_a_batch_reads(spark, path, records, sub, tmp_path):
    stream = subs.select(log.read_stream(spark, path, maxFilesPerTrigger=1), sub, batch_log=records)
    query = (
        stream.select("topic", "partition", "offset").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "d"))
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "d"))
    wanted = subs.select(records, sub).select("topic", "partition", "offset")
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty() and not wanted.isEmpty()


def test_rows_of_the_broker_source_become_records(spark):
    raw = spark.sql("""SELECT binary('k') AS key, binary('v') AS value, 't' AS topic, 1 AS partition, 5L AS offset,
        TIMESTAMP '2024-01-01 00:00:00' AS timestamp, 0 AS timestampType,
        array(named_struct('key', 'h', 'value', binary('x'))) AS headers""")
    got = source.records_of(raw)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in model.RECORD]
    assert (got.first()["key"], got.first()["value"]) == ("k", "v")
