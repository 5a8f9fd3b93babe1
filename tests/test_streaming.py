import collections
import datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from streamlog import model, workspace
from streamlog.functions import envelope
from streamlog.operators import progress, protect, verify
from streamlog.sources import log, source, subs
from streamlog.streaming import collect, committed, control, delivery, store, txn
from streamlog.streaming.store import OutputLog

NOW = {"availableNow": True}
SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, value string, arrival_seq bigint"


@pytest.fixture()
def folder(spark, tmp_path):
    """Values 1..1000 over two partitions, appended in five ordered files."""
    path = str(tmp_path / "in")
    for i in range(5):
        append(spark, path, i * 200, (i + 1) * 200)
    return path


def append(spark, path, start, end):
    rows = spark.range(start, end).select(
        F.lit("in").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
        F.expr("id div 2").alias("offset"),
        (F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("timestamp"),
        F.lit("key").alias("key"), (F.col("id") + 1).cast("string").alias("value"), F.col("id").alias("arrival_seq"),
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, files=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(path)


def envelopes(df, drop_tens=False):
    pairs = source.committable(df, subs.topics("in"), "g")
    one = envelope.single(envelope.record("out", F.col("value"), partition=F.col("partition")))
    if drop_tens:
        one = envelope.route([(F.col("value").cast("int") % 10 == 0, envelope.pass_through())], one)
    return pairs.withColumn("records", one).select("records", "ctx")


class Failing:
    """Fails once at a micro-batch."""

    def __init__(self, at):
        self.at, self.done = at, False

    def __call__(self, batch_id):
        if batch_id == self.at and not self.done:
            self.done = True
            raise RuntimeError("injected")


def run_twice(start):
    with pytest.raises(StreamingQueryException, match="injected"):
        control.run_to_end(start())
    control.run_to_end(start())


def numbers(df):
    return sorted(int(r.value) for r in df.collect())


def test_exactly_once_after_an_abort(spark, folder, tmp_path):
    root, failing = str(tmp_path / "out"), Failing(2)
    run_twice(lambda: txn.flow(envelopes(stream(spark, folder)), root, "w", f"{root}/c", trigger=NOW, before_publish=failing))
    records = OutputLog(spark, root).records()
    assert numbers(records) == list(range(1, 1001))
    assert verify.gaps(records).isEmpty()
    in_order = F.col("value").cast("bigint").alias("v")
    for p in (0, 1):
        values = [r.v for r in records.filter(F.col("partition") == p).orderBy("offset").select(in_order).collect()]
        assert values == list(range(p + 1, 1001, 2))
    offsets = {r.partition: r.offset for r in OutputLog(spark, root).source_offsets().collect()}
    assert offsets == {0: 500, 1: 500}


def test_staged_records_are_invisible(spark, folder, tmp_path):
    root = str(tmp_path / "out")
    query = txn.flow(envelopes(stream(spark, folder)), root, "w", f"{root}/c", trigger=NOW, before_publish=Failing(2))
    with pytest.raises(StreamingQueryException):
        control.run_to_end(query)
    out = OutputLog(spark, root)
    assert numbers(out.records()) == list(range(1, 401))
    assert {r.partition: r.offset for r in out.source_offsets().collect()} == {0: 200, 1: 200}


def test_published_batch_is_not_written_again(spark, folder, tmp_path):
    """A crash after publishing, before Spark noted the batch as done."""
    root = str(tmp_path / "out")
    failing = Failing(1)
    run_twice(
        lambda: txn.flow(
            envelopes(stream(spark, folder)), root, "w", f"{root}/c", trigger=NOW, on_results=lambda _, b: failing(b)
        )
    )
    records = OutputLog(spark, root).records()
    assert numbers(records) == list(range(1, 1001))
    assert verify.gaps(records).isEmpty()


def test_filtered_messages_in_a_transaction(spark, folder, tmp_path):
    root = str(tmp_path / "out")
    control.run_to_end(txn.sink(envelopes(stream(spark, folder, 2), drop_tens=True), root, "w", f"{root}/c", trigger=NOW))
    out = OutputLog(spark, root)
    assert numbers(out.records()) == [v for v in range(1, 1001) if v % 10]
    assert {r.offset for r in out.source_offsets().collect()} == {500}


def test_record_without_partition_needs_a_key_and_a_count(spark, folder, tmp_path):
    keyed = source.committable(stream(spark, folder, 5), subs.topics("in"), "g").withColumn(
        "records", envelope.single(envelope.record("out", F.col("value"), key=F.col("value")))
    ).select("records", "ctx")
    root = str(tmp_path / "out")
    with pytest.raises(StreamingQueryException, match="record without partition"):
        control.run_to_end(txn.flow(keyed, root, "w", f"{root}/c", trigger=NOW))
    control.run_to_end(txn.flow(keyed, root, "w", f"{root}/c", trigger=NOW, partitions=3))
    records = OutputLog(spark, root).records()
    assert numbers(records) == list(range(1, 1001))
    assert records.select("partition").distinct().count() == 3


def test_new_checkpoint_on_an_old_store_fails(spark, folder, tmp_path):
    root = str(tmp_path / "out")
    control.run_to_end(txn.sink(envelopes(stream(spark, folder)), root, "w", f"{root}/c", trigger=NOW))
    with pytest.raises(StreamingQueryException, match="belongs to query"):
        control.run_to_end(txn.sink(envelopes(stream(spark, folder)), root, "w", f"{root}/c2", trigger=NOW))
    assert numbers(OutputLog(spark, root).records()) == list(range(1, 1001))


def test_commit_files_do_not_pile_up(spark, tmp_path):
    out, source_ = OutputLog(spark, str(tmp_path / "out")), None
    for batch in range(12):
        rows = spark.createDataFrame(
            [("out", 0, datetime.datetime(2024, 1, 1), "k", str(batch), batch)],
            "topic string, partition int, timestamp timestamp_ntz, key string, value string, seq bigint",
        )
        source_ = spark.createDataFrame([("g", "in", batch % 2, batch, "")], "group_id string, topic string, partition int, offset bigint, metadata string")
        out.publish(out.stage(rows, "w", batch, ["seq"]), source_, "w", batch, "q")
    assert len(list((tmp_path / "out/commits/writer=w/query=q/epoch=0").glob("batch_id=*"))) == 5
    assert len([f for f in (tmp_path / "out/published").iterdir() if not f.name.startswith(".")]) == 5
    assert numbers(out.records()) == list(range(12)) and verify.gaps(out.records()).isEmpty()
    assert {r.partition: r.offset for r in out.source_offsets().collect()} == {0: 10, 1: 11}
    assert out.is_published("w", 11, "q") and not out.is_published("w", 12, "q")


def one_record(spark, value, partition=0):
    return spark.createDataFrame(
        [("out", partition, datetime.datetime(2024, 1, 1), "k", value, 1)],
        "topic string, partition int, timestamp timestamp_ntz, key string, value string, seq bigint",
    )


def no_offsets(spark):
    return spark.createDataFrame([], "group_id string, topic string, partition int, offset bigint, metadata string")


def test_an_earlier_start_of_a_writer_is_fenced(spark, tmp_path):
    out, none = OutputLog(spark, str(tmp_path / "out")), no_offsets(spark)
    old = out.claim("w", "q")
    out.publish(out.stage(one_record(spark, "1"), "w", 0, ["seq"], epoch=old), none, "w", 0, "q", epoch=old)
    late = out.stage(one_record(spark, "2"), "w", 1, ["seq"], epoch=old)
    new = out.claim("w", "q")
    assert new == old + 1 and not (tmp_path / f"out/records/writer=w/epoch={old}/batch_id=1").exists()
    out.publish(out.stage(one_record(spark, "3"), "w", 1, ["seq"], epoch=new), none, "w", 1, "q", epoch=new)
    with pytest.raises(RuntimeError, match="is fenced: epoch 1, claimed since by 2"):
        out.publish(late, none, "w", 1, "q", epoch=old)
    # What the old start stages from now on lies beside what counts.
    out.stage(one_record(spark, "4"), "w", 0, ["seq"], epoch=new + 5)
    assert [(r.value, r.offset) for r in out.records().orderBy("offset").collect()] == [("1", 0), ("3", 1)]
    assert out.last_batch("w", "q") == 1
    with pytest.raises(RuntimeError, match="belongs to query q"):
        out.claim("w", "another")


def test_reading_an_output_log_shuffles_nothing(spark, tmp_path):
    """What counts is chosen by folder: the records of a writer are not gathered in one task."""
    out, none = OutputLog(spark, str(tmp_path / "out")), no_offsets(spark)
    assert out.records().isEmpty()
    for writer, partition in (("a", 0), ("b c", 1)):
        for n in (0, 1):  # each start publishes one batch and stages another
            epoch = out.claim(writer, "q")
            staged = out.stage(one_record(spark, f"{writer} {n}", partition), writer, n, ["seq"], epoch=epoch)
            out.publish(staged, none, writer, n, "q", epoch=epoch)
            out.stage(one_record(spark, f"{writer} {n + 1} early", partition), writer, n + 1, ["seq"], epoch=epoch)
    out.stage(one_record(spark, "c 0"), "c", 0, ["seq"])
    records = out.records()
    rows = [(r.writer, r.epoch, r.batch_id, r.value, r.offset) for r in records.collect()]
    assert sorted(rows) == [("a", 1, 0, "a 0", 0), ("a", 2, 1, "a 1", 1), ("b c", 1, 0, "b c 0", 0), ("b c", 2, 1, "b c 1", 1)]
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan, plan


@pytest.mark.parametrize("partition", [0, 1])
def test_writers_that_publish_at_the_same_moment(spark, tmp_path, monkeypatch, partition):
    """b publishes between the moment a looks and the moment it publishes; only other topic-partitions may."""
    out, none = OutputLog(spark, str(tmp_path / "out")), no_offsets(spark)
    mine, other = out.stage(one_record(spark, "1"), "a", 0, ["seq"]), out.stage(one_record(spark, "2", partition), "b", 0, ["seq"])
    plain, waiting = store.create_file, [True]

    def slow(*args):
        if waiting.pop() if waiting else False:
            out.publish(other, none, "b", 0)
        return plain(*args)

    monkeypatch.setattr(store, "create_file", slow)
    if partition == 0:
        with pytest.raises(RuntimeError, match="writer b has published offsets up to 1"):
            out.publish(mine, none, "a", 0)
        assert numbers(out.records()) == [2]
    else:
        out.publish(mine, none, "a", 0)
        assert numbers(out.records()) == [1, 2]
        assert {(r.partition, r.end_offset) for r in out.ends().collect()} == {(0, 1), (1, 1)}


def test_writers_that_stand_still_do_not_publish_on_old_numbers(spark, tmp_path, monkeypatch):
    """Others publish so often meanwhile that the number is deleted again."""
    out, none = OutputLog(spark, str(tmp_path / "out")), no_offsets(spark)
    out.claim("b", "q")
    mine = out.stage(one_record(spark, "1"), "a", 0, ["seq"])
    plain, waiting = store.create_file, [True]

    def slow(*args):
        if waiting.pop() if waiting else False:
            for _ in range(store.KEPT_COMMITS + 2):
                epoch = out.claim("b", "q")
            out.publish(out.stage(one_record(spark, "2", 1), "b", 0, ["seq"], epoch=epoch), none, "b", 0, "q", epoch=epoch)
        return plain(*args)

    monkeypatch.setattr(store, "create_file", slow)
    out.publish(mine, none, "a", 0)
    assert numbers(out.records()) == [1, 2]


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "x/1")
    assert [workspace.create_file(spark, path, text) for text in ("ä", "b")] == [True, False]
    assert workspace.read_text(spark, path) == "ä"
    assert not list((tmp_path / "x-aside").glob("[!.]*"))


def test_writers_that_meet_fail(spark, tmp_path):
    out, rows, none = OutputLog(spark, str(tmp_path / "out")), one_record(spark, "1"), no_offsets(spark)
    one, two = (out.stage(rows, w, 0, ["seq"]) for w in ("a", "b"))
    out.publish(one, none, "a", 0)
    with pytest.raises(RuntimeError, match="writer a has published offsets up to 1"):
        out.publish(two, none, "b", 0)


def test_at_most_once_with_a_new_checkpoint_loses_nothing(spark, folder, tmp_path):
    root = str(tmp_path)
    commit, committed = delivery.append_commits(f"{root}/commits"), delivery.is_committed(f"{root}/commits")

    def sink(batch, _):
        batch.select(*model.TP, "value").write.mode("append").parquet(f"{root}/data")

    for parity in (0, 1):
        records = source.committable(stream(spark, folder).filter(F.col("partition") == parity), subs.topics("in"), "g")
        control.run_to_end(delivery.at_most_once(records, sink, commit, committed, f"{root}/c{parity}"))
    assert numbers(spark.read.parquet(f"{root}/data")) == list(range(1, 1001))


def test_read_committed_stops_at_an_open_transaction(spark):
    rows = [("t", 0, 0, "0", 1), ("t", 0, 1, "1", 2), ("t", 0, 2, "2", 1), ("t", 0, 3, "3", None), ("t", 1, 0, "4", None)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string, txn_id bigint")
    states = spark.createDataFrame([(1, "committed")], "txn_id bigint, status string")
    assert numbers(txn.read_committed(df, states)) == [0, 4]
    decided = spark.createDataFrame([(1, "committed"), (2, "committed")], "txn_id bigint, status string")
    assert numbers(txn.read_committed(df, decided)) == [0, 1, 2, 3, 4]


def test_a_stream_keeps_undecided_records(spark, tmp_path):
    """Transaction 2 is open in the first micro-batch, fails once, and commits later; 3 opens later."""
    schema = "topic string, partition int, offset bigint, value string, txn_id bigint"
    path, root, states = str(tmp_path / "in"), str(tmp_path), [(1, "committed")]

    def add(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def now():
        return spark.createDataFrame(states, "txn_id bigint, status string")

    def start(hook=lambda _: None):
        def sink(batch, batch_id):
            hook(batch_id)
            batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

        stream = spark.readStream.schema(schema).parquet(path)
        return committed.flow(stream, now, sink, f"{root}/pending", f"{root}/c", trigger=NOW)

    out = lambda: numbers(spark.read.schema(schema).parquet(f"{root}/out"))
    add(("t", 0, 0, "0", 1), ("t", 0, 1, "1", 2), ("t", 0, 2, "2", 1), ("t", 0, 3, "3", None), ("t", 1, 0, "4", None))
    control.run_to_end(start())
    assert out() == [0, 4]
    states.append((2, "committed"))
    add(("t", 0, 4, "5", 3), ("t", 0, 5, "6", None))
    failing = Failing(1)
    run_twice(lambda: start(failing))
    assert out() == [0, 1, 2, 3, 4]
    states.append((3, "aborted"))
    add(("t", 1, 1, "7", None))
    control.run_to_end(start())
    assert out() == [0, 1, 2, 3, 4, 6, 7]
    with pytest.raises(ValueError, match="committed.flow"):
        txn.read_committed(spark.readStream.schema(schema).parquet(path), now())


def stream_of_decisions(spark, root, schema):
    decisions = spark.readStream.schema("txn_id bigint, status string").option("maxFilesPerTrigger", 1).parquet(f"{root}/decisions")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), decisions


def held(root):
    """Numbers of the micro-batches whose waiting records are still stored."""
    return sorted(int(p.name.removeprefix("batch_id=")) for p in Path(root).glob("pending/query=*/waiting/batch_id=*"))


def test_decisions_release_what_waits(spark, tmp_path):
    """Waiting records are stored once and come out when the decision does, also without new records."""
    schema, root = "topic string, partition int, offset bigint, value string, txn_id bigint", str(tmp_path)
    writes = collections.Counter()

    def add(folder, columns, *rows):
        spark.createDataFrame(list(rows), columns).coalesce(1).write.mode("append").parquet(f"{root}/{folder}")

    def records(*rows):
        add("in", schema, *rows)

    def decide(*rows):
        add("decisions", "txn_id bigint, status string", *rows)

    def run(hook=lambda _: None):
        def sink(batch, batch_id):
            hook(batch_id)
            writes[batch_id] += 1
            batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

        log_, decisions = stream_of_decisions(spark, root, schema)
        return committed.flow(log_, decisions, sink, f"{root}/pending", f"{root}/c", trigger=NOW)

    out = lambda: numbers(spark.read.schema(schema).parquet(f"{root}/out"))
    decide((9, "committed"))  # before any of its records
    records(("t", 0, 0, "0", 9), ("t", 0, 1, "1", 1), ("t", 0, 2, "2", None), ("t", 0, 3, "3", 2), ("t", 1, 0, "4", None))
    control.run_to_end(run())
    assert out() == [0, 4]
    first = held(root)
    records(("t", 0, 4, "5", 9), ("t", 0, 5, "6", None))
    control.run_to_end(run())
    assert out() == [0, 4] and held(root)[:1] == first and len(held(root)) == 2
    decide((1, "committed"))  # releases up to transaction 2, in a micro-batch without records
    failing = Failing(max(writes) + 1)
    run_twice(lambda: run(failing))
    assert out() == [0, 1, 2, 4] and held(root)[:1] == first
    decide((2, "aborted"))
    control.run_to_end(run())
    assert out() == [0, 1, 2, 4, 5, 6] and held(root) == []
    records(("t", 0, 1, "7", 3), ("t", 0, 6, "8", None))  # a late record of an open transaction holds the rest back
    control.run_to_end(run())
    assert out() == [0, 1, 2, 4, 5, 6]
    decide((3, "committed"))
    control.run_to_end(run())
    assert out() == [0, 1, 2, 4, 5, 6, 7, 8]


def test_a_long_transaction_is_not_written_again(spark, tmp_path):
    """Bytes of waiting records stay as they were stored, however many micro-batches pass."""
    schema, root = "topic string, partition int, offset bigint, value string, txn_id bigint", str(tmp_path)
    for k in range(5):
        rows = spark.range(k * 1000, k * 1000 + 1000).selectExpr(
            "'t' AS topic", "0 AS partition", "id AS offset", "CAST(id AS string) AS value", "IF(id = 0, 1L, NULL) AS txn_id"
        )
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
    spark.createDataFrame([(7, "committed")], "txn_id bigint, status string").coalesce(1).write.parquet(f"{root}/decisions")
    log_, decisions = stream_of_decisions(spark, root, schema)
    seen = []
    control.run_to_end(committed.flow(log_, decisions, lambda b, _: seen.append(b.count()), f"{root}/pending", f"{root}/c", trigger=NOW))
    assert seen == [0] * 5
    (folder,) = Path(root).glob("pending/query=*/waiting")
    stored = [spark.read.parquet(str(p)).count() for p in sorted(folder.glob("batch_id=*"))]
    assert stored == [1000] * 5


def sinks(root):
    return delivery.append_records(f"{root}/data"), delivery.append_commits(f"{root}/commits")


def test_at_least_once_repeats_but_loses_nothing(spark, folder, tmp_path):
    root = str(tmp_path)
    sink, commit = sinks(root)
    failing = Failing(1)

    def failing_commit(batch, batch_id):
        failing(batch_id)
        commit(batch, batch_id)

    run_twice(lambda: delivery.at_least_once(envelopes(stream(spark, folder)), sink, failing_commit, f"{root}/c"))
    got = numbers(spark.read.parquet(f"{root}/data"))
    assert set(got) == set(range(1, 1001)) and len(got) == 1200


def test_at_most_once_loses_but_repeats_nothing(spark, folder, tmp_path):
    root = str(tmp_path)
    sink, commit = sinks(root)
    failing = Failing(1)

    def failing_sink(batch, batch_id):
        failing(batch_id)
        sink(batch.select(*model.TP, "value"), batch_id)

    records = source.committable(stream(spark, folder), subs.topics("in"), "g")
    committed = delivery.is_committed(f"{root}/commits")
    run_twice(lambda: delivery.at_most_once(records, failing_sink, commit, committed, f"{root}/c"))
    got = numbers(spark.read.parquet(f"{root}/data"))
    assert got == [*range(1, 201), *range(401, 1001)]
    assert spark.read.parquet(f"{root}/commits").agg(F.max("offset")).first()[0] == 500


def test_two_effects_one_commit(spark, folder, tmp_path):
    root = str(tmp_path)
    records = source.committable(stream(spark, folder, 5), subs.topics("in"), "g")
    both = [
        (lambda name: lambda batch, _: batch.select("value").write.mode("append").parquet(f"{root}/{name}"))(name)
        for name in ("a", "b")
    ]
    control.run_to_end(delivery.multi_sink(records, both, delivery.append_commits(f"{root}/commits"), f"{root}/c"))
    for name in ("a", "b"):
        assert numbers(spark.read.parquet(f"{root}/{name}")) == list(range(1, 1001))
    assert spark.read.parquet(f"{root}/commits").count() == 2


def test_new_query_starts_from_stored_offsets(spark, folder, tmp_path):
    root = str(tmp_path / "store")
    out = OutputLog(spark, root)

    def update(batch, _):
        return batch.select(F.lit("sum").alias("topic"), F.lit(0).alias("partition"), "timestamp", "key", "value",
                            F.col("arrival_seq").alias("seq"))

    def start(name, **hooks):
        stored = delivery.stored_offsets(out, "g").select(*model.TP, F.col("offset").alias("start"))
        rest = stream(spark, folder).join(stored, model.TP, "left").filter("start IS NULL OR offset >= start").drop("start")
        return delivery.external_offsets(rest, update, root, name, "g", f"{root}/c-{name}", **hooks)

    with pytest.raises(StreamingQueryException, match="injected"):
        control.run_to_end(start("first", before_publish=Failing(3)))
    assert {r.offset for r in delivery.stored_offsets(out, "g").collect()} == {300}
    control.run_to_end(start("second"))
    assert numbers(out.records()) == list(range(1, 1001))
    assert verify.gaps(out.records()).isEmpty()


def test_drain_finishes_what_is_there(spark, folder, tmp_path):
    root = str(tmp_path / "out")
    query = txn.flow(envelopes(stream(spark, folder)), root, "w", f"{root}/c", trigger={"processingTime": "0 seconds"})
    control.drain(query)
    assert not query.isActive
    assert numbers(OutputLog(spark, root).records()) == list(range(1, 1001))


def test_read_committed_hides_aborted_and_keeps_the_rest(spark):
    rows = [("t", 0, i, str(i), txn_id) for i, txn_id in enumerate([None, 1, 2, None, 3, 1])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string, txn_id bigint")
    states = spark.createDataFrame([(1, "committed"), (2, "aborted"), (3, "aborted")], "txn_id bigint, status string")
    assert numbers(txn.read_committed(df, states)) == [0, 1, 3, 5]
    with pytest.raises(ValueError):
        txn.source(df, subs.topics("t"), "")


def to_table(df, tmp_path, name):
    query = (
        df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-c"))
        .trigger(availableNow=True).start(str(tmp_path / name))
    )
    query.awaitTermination()
    return df.sparkSession.read.parquet(str(tmp_path / name))


def test_groups_carry_over_micro_batches(spark, folder, tmp_path):
    groups = collect.grouped_within(stream(spark, folder), 30, datetime.timedelta(seconds=50))
    got = to_table(groups, tmp_path, "groups").filter("partition = 0").orderBy("group_no").collect()
    # A record every two seconds: the timer of 50 s runs out after 25 records.
    assert {(r.closed_by, r.size) for r in got} == {("interval", 25)}
    values = [int(v) for r in got for v in r.joined.split(",")]
    assert values == list(range(1, 2 * len(values), 2))


def test_commit_batches_carry_over_micro_batches(spark, folder, tmp_path):
    committables = stream(spark, folder).select(
        F.lit("g").alias("group_id"), "topic", "partition", "offset", F.lit("m").alias("metadata"),
        "arrival_seq", "timestamp", F.lit(1).cast("bigint").alias("batch_size"),
    )
    first = to_table(collect.commit_batches(committables, 300, stream=["group_id"]), tmp_path, "first").collect()
    assert sorted((r.batch, r.partition, r.offset, r.updates) for r in first) == [
        (b, p, 150 * (b + 1), 150) for b in range(3) for p in (0, 1)
    ]
    deferred = collect.commit_batches(committables, 300, stream=["group_id"], when="next_observed")
    rows = to_table(deferred, tmp_path, "deferred").collect()
    assert {(r.batch, r.partition): r.offset for r in rows} == {(b, p): 150 * (b + 1) for b in range(3) for p in (0, 1)}


def test_progress_and_protection_in_a_stream(spark, folder, tmp_path):
    polls = stream(spark, folder).withColumn("poll_batch", F.expr("arrival_seq div 100"))
    assigned = spark.createDataFrame([("in", 0)], "topic string, partition int")
    query = (
        progress.received(polls, assigned).writeStream.outputMode("complete").format("memory")
        .queryName("received").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {r.poll_batch: r.offset for r in spark.table("received").collect()}
    assert got == {b: 50 * b + 49 for b in range(10)}

    requested = spark.createDataFrame([("in", 0, 100)], "topic string, partition int, offset bigint")
    path = str(tmp_path / "safe")

    def protect_batch(batch, _):
        safe = protect.reset_filter(batch, requested, offset_threshold=10)
        safe.select("partition", "offset").write.mode("append").parquet(path)

    polls.writeStream.foreachBatch(protect_batch).trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "safe-c")
    ).start().awaitTermination()
    safe = spark.read.parquet(path).groupBy("partition").agg(F.min("offset").alias("m"), F.count("*").alias("n"))
    # Polls 0 and 1 of partition 0 begin below 90; partition 1 was never requested.
    assert {r.partition: (r.m, r.n) for r in safe.collect()} == {0: (100, 400), 1: (0, 500)}


def test_merged_streams_and_counts(spark, folder, tmp_path):
    both = stream(spark, folder).unionByName(stream(spark, folder)).groupBy("partition").count()
    both.writeStream.outputMode("complete").format("memory").queryName("merged").trigger(
        availableNow=True
    ).start().awaitTermination()
    assert {r.partition: r["count"] for r in spark.table("merged").collect()} == {0: 1000, 1: 1000}


def test_micro_batches_leave_no_intermediate_tables(spark, folder, tmp_path):
    shared = Path(workspace.shared_root(spark)) / "streamlog" / spark.sparkContext.applicationId
    before = set(shared.glob("*"))
    root = str(tmp_path / "out")
    control.run_to_end(txn.flow(envelopes(stream(spark, folder, 3)), root, "w", f"{root}/c", trigger=NOW))
    assert set(shared.glob("*")) == before


def test_log_stream_of_a_table(spark, tmp_path):
    df = spark.range(10).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("timestamp"), F.lit(0).alias("timestamp_type"),
        F.lit("k").alias("key"), F.col("id").cast("string").alias("value"),
        F.array().cast(model.HEADERS).alias("headers"), F.col("id").alias("arrival_seq"),
    )
    log.write(df, str(tmp_path / "t"))
    assert numbers(to_table(log.read_stream(spark, str(tmp_path / "t")), tmp_path, "copy")) == list(range(10))
