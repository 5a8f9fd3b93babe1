"""Typed keys and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.functions import envelope

_CORRUPT = "_corrupt"


def text(column: Column) -> Column:
    """Bytes as UTF-8 text."""
    return column.cast("string")


def int64(column: Column) -> Column:
    """Eight big-endian bytes as a number."""
    return F.conv(F.hex(column), 16, -10).cast("bigint")


def parse_json(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``data`` (the parsed value, NULL if faulty) and ``faulty``.

    The parsed value comes out of a generator, through which Spark moves no
    filter: otherwise a filter on ``faulty`` would parse every value twice.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        "value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    faulty = F.col("value").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull()
    data = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
    return (
        df.select("*", F.explode(F.array(parsed)).alias("_parsed"))
        .withColumn("faulty", faulty)
        .withColumn("data", F.when(~F.col("faulty"), data))
        .drop("_parsed")
    )


def json_resume(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows whose value parses, and the faulty rest."""
    parsed = parse_json(df, schema)
    return (
        parsed.filter(~F.col("faulty")).drop("faulty"),
        parsed.filter("faulty").drop("faulty", "data"),
    )


def to_json_value(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def decode_or_pass(df: DataFrame, schema: T.StructType, produce: Column) -> DataFrame:
    """Envelopes: ``produce`` for a good row, nothing for a faulty one.

    ``produce`` may use ``data``. A faulty row keeps its context, so its offset is
    committed in order; ``faulty`` selects the rows for a dead-letter table.
    """
    return parse_json(df, schema).withColumn(
        "records", F.when(F.col("faulty"), envelope.pass_through()).otherwise(produce)
    )
