import pytest
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlog.functions import partitioner


def murmur2(data: bytes) -> int:
    """Byte by byte, as published."""
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    for i in range(0, len(data) - len(data) % 4, 4):
        k = int.from_bytes(data[i : i + 4], "little") * m & mask
        k = (k ^ k >> 24) * m & mask
        h = h * m & mask ^ k
    rest = data[len(data) - len(data) % 4 :]
    if rest:
        h = (h ^ int.from_bytes(rest, "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=20))
def test_hash_matches_plain_python(keys):
    got = partitioner.hash_keys(pa.array(keys, pa.string()))
    assert got.tolist() == [murmur2(k.encode()) for k in keys]


def test_hash_of_a_slice():
    keys = pa.array(["a", None, "bcdefg", "hij"], pa.string())[1:]
    assert partitioner.hash_keys(keys)[1:].tolist() == [murmur2(b"bcdefg"), murmur2(b"hij")]


def test_known_values_and_null(spark):
    known = {"21": -973932308, "foobar": -790332482, "abc": 479470107, "a-little-bit-long-string": -985981536}
    df = spark.createDataFrame([(k,) for k in [*known, None]], "k string")
    got = {r.k: r.h for r in df.select("k", partitioner.murmur2(F.col("k")).alias("h")).collect()}
    assert got == {**known, None: None}


def test_choose_explicit_then_key_then_turn(spark):
    rows = [
        (0, "t", 2, "abc"), (1, "t", None, "abc"), (2, "t", None, None), (3, "t", None, None),
        (4, "u", None, None), (5, "t", 0, None), (6, "t", None, None), (7, "t", None, None),
    ]
    df = spark.createDataFrame(rows, "seq bigint, topic string, partition int, key string")
    got = {r.seq: r.partition for r in partitioner.choose(df, 3, seq="seq").collect()}
    by_key = (murmur2(b"abc") & 0x7FFFFFFF) % 3
    assert got == {0: 2, 1: by_key, 2: 0, 3: 1, 4: 0, 5: 0, 6: 2, 7: 0}


def test_shard_is_the_partition_as_text(spark):
    df = spark.createDataFrame([("u1",), ("user-12345",)], "id string")
    rows = df.select("id", partitioner.shard_id(F.col("id"), 10).alias("s")).collect()
    assert {r.id: r.s for r in rows} == {
        k: str((murmur2(k.encode()) & 0x7FFFFFFF) % 10) for k in ("u1", "user-12345")
    }


def test_partition_counts_per_topic(spark):
    rows = spark.createDataFrame([("a", None, "k", 0), ("b", None, "k", 1), ("b", None, None, 2), ("b", None, None, 3)], "topic string, partition int, key string, seq bigint")
    got = {r.seq: r.partition for r in partitioner.choose(rows, {"a": 1, "b": 2}, seq="seq").collect()}
    assert got[0] == 0 and got[1] in (0, 1) and (got[2], got[3]) == (0, 1)
    with pytest.raises(Exception, match="unknown topic"):
        partitioner.choose(rows, {"a": 1}, seq="seq").collect()
