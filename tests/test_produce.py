import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.functions import context, envelope, serde
from streamlog.operators import batching, commits, produce


def numbers(spark, n):
    """Values "1".."n" of one topic-partition."""
    return spark.range(n).select(
        F.lit("in").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        (F.col("id") + 1).cast("string").alias("value"), F.col("id").alias("envelope_id"),
    )


def test_one_to_two_topics(spark):
    pair = envelope.multi(envelope.record("t2", F.col("value")), envelope.record("t3", F.col("value")))
    out = produce.flexi_flow(numbers(spark, 10).select("envelope_id", pair.alias("records")), 1)
    assert out.records.count() == 20
    assert {(r.topic, r.partition, r.offset) for r in out.records.collect()} == {
        (t, 0, o) for t in ("t2", "t3") for o in range(10)
    }


def test_conditional_envelopes_commit_everything(spark):
    routes = envelope.route(
        [
            (F.col("value") == "1", envelope.multi(envelope.record("t2", F.col("value")), envelope.record("t3", F.col("value")))),
            (F.col("value") == "2", envelope.pass_through()),
        ],
        envelope.single(envelope.record("t4", F.col("value"))),
    )
    pairs = context.with_context(numbers(spark, 10), "g").withColumn("records", routes)
    out = produce.flexi_flow(pairs.select("envelope_id", "records", "ctx"), 1)
    assert out.records.count() == 10
    kinds = {r.kind: r["count"] for r in out.results.select(produce.kind(F.col("parts")).alias("kind")).groupBy("kind").count().collect()}
    assert kinds == {"multi": 1, "pass_through": 1, "single": 8}
    batch = commits.offset_batch(context.committables(out.results, seq="envelope_id")).collect()
    assert [(b.offset, b.updates) for b in batch] == [(10, 10)]


def test_rendered_results(spark):
    pair = envelope.multi(envelope.record("a", F.col("value")), envelope.record("b", F.col("value"), partition=F.lit(1)))
    routes = envelope.route([(F.col("value") == "1", pair), (F.col("value") == "2", envelope.pass_through())],
                            envelope.single(envelope.record("a", F.col("value"))))
    ends = spark.createDataFrame([("a", 0, 7)], "topic string, partition int, end_offset bigint")
    out = produce.flexi_flow(numbers(spark, 3).withColumn("records", routes).select("envelope_id", "records"), 1, ends=ends)
    texts = [r.text for r in produce.render_results(out.results).orderBy("envelope_id").collect()]
    assert texts == ["a/0 7: 1, b/1 0: 1", "passed through", "a/0 8: 3"]


def test_failure_policies(spark):
    good, bad = produce.with_policy(numbers(spark, 10), F.col("value") != "5", on_error="resume")
    assert (good.count(), [r.value for r in bad.collect()]) == (9, ["5"])
    with pytest.raises(PySparkException, match="cannot be sent"):
        produce.with_policy(numbers(spark, 10), F.col("value") != "5", on_error="stop")[0].collect()
    with pytest.raises(ValueError):
        produce.with_policy(numbers(spark, 1), F.lit(True), on_error="ignore")


def test_groups_of_five(spark):
    groups = batching.grouped(numbers(spark, 10), 5).orderBy("group_no").collect()
    assert [",".join(g["values"]) for g in groups] == ["1,2,3,4,5", "6,7,8,9,10"]
    assert [g.offset for g in groups] == [4, 9]


def test_sums_and_concats(spark):
    rows = batching.sums_and_concats(numbers(spark, 100), 10, F.col("value").cast("bigint")).orderBy("group_no").collect()
    assert [r.total for r in rows] == [sum(range(i, i + 10)) for i in range(1, 101, 10)]
    assert rows[0].joined == "12345678910"
    assert [r.offset for r in rows] == list(range(9, 100, 10))


def test_only_the_last_element_commits(spark):
    groups = batching.grouped(numbers(spark, 7), 3).withColumn("ctx", F.struct("offset")).drop("offset")
    rows = batching.unbatch(groups).orderBy("group_no", "pos").collect()
    assert [(r.value, r.ctx.offset if r.ctx else None) for r in rows] == [
        ("1", None), ("2", None), ("3", 2), ("4", None), ("5", None), ("6", 5), ("7", 6),
    ]


SAMPLE = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.IntegerType())])


def test_faulty_json_is_skipped_but_committed(spark):
    texts = ["{faulty JSON data", *[f'{{"name":"n{i}","value":{i}}}' for i in range(3)]]
    rows = [("in", 0, i, t) for i, t in enumerate(texts)]
    df = context.with_context(spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string"), "g")
    good, bad = serde.json_resume(df, SAMPLE)
    assert [(r.data.name, r.data.value) for r in good.orderBy("offset").collect()] == [(f"n{i}", i) for i in range(3)]
    assert [r.value for r in bad.collect()] == texts[:1]
    out = envelope.single(envelope.record("names", F.col("data.name")))
    made = serde.decode_or_pass(df, SAMPLE, out)
    assert sorted((r.ctx.offset, len(r.records)) for r in made.collect()) == [(0, 0), (1, 1), (2, 1), (3, 1)]


def test_bytes_and_json(spark):
    df = spark.createDataFrame([(bytearray(b"\x00" * 7 + b"\x2a"), bytearray("é".encode()))], "n binary, s binary")
    row = df.select(serde.int64(F.col("n")).alias("n"), serde.text(F.col("s")).alias("s")).first()
    assert (row.n, row.s) == (42, "é")
    negative = spark.createDataFrame([(bytearray(b"\xff" * 8),)], "n binary").select(serde.int64(F.col("n")).alias("n")).first()
    assert negative.n == -1
    assert df.select(serde.to_json_value(F.lit(1).alias("a")).alias("j")).first().j == '{"a":1}'


def test_results_do_not_evaluate_envelopes_again(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "envelope_id long, v string").write.parquet(path)
    one = envelope.single(envelope.record("t", F.col("v"), key=F.col("v")))
    envelopes = spark.read.parquet(path).select(
        "envelope_id", envelope.route([(F.col("v").isNull(), envelope.pass_through())], one).alias("records"),
        F.expr("uuid()").alias("mark"),
    )
    results = produce.flexi_flow(envelopes, 2).results
    assert not [f for f in results.inputFiles() if path in f]
    assert {r.envelope_id: r.mark for r in results.collect()} == {r.envelope_id: r.mark for r in results.collect()}
    assert {r.envelope_id: len(r.parts) for r in results.collect()} == {1: 1, 2: 1, 3: 0}
