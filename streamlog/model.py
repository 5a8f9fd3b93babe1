"""Fixed schemas of the record log.

Timestamps are TIMESTAMP_NTZ because the tables the log is derived from carry
zone-less timestamps; "no timestamp" is NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("timestamp_type", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("headers", HEADERS),
    ]
)

# A log table also stores the order in which records arrived over all partitions.
LOG = T.StructType([*RECORD.fields, T.StructField("arrival_seq", T.LongType())])

OUT_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

CTX = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("metadata", T.StringType()),
    ]
)

NO_METADATA = ""

TP = ["topic", "partition"]
GTP = ["group_id", "topic", "partition"]
