"""Envelopes: none, one or many output records plus what passes through.

An envelope is a column of type array<OUT_RECORD>: size 0 passes only the context
through, size 1 is a single record, more are written as one unit. The context is
an ordinary column next to it, so commits are taken from envelopes, never from
the exploded records, and an empty envelope still commits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model

RECORDS = f"array<{model.OUT_RECORD.simpleString()}>"


def record(
    topic: Column | str, value: Column, *, key: Column | None = None,
    partition: Column | None = None, timestamp: Column | None = None,
) -> Column:
    null = F.lit(None)
    return F.struct(
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        (null if partition is None else partition).cast("int").alias("partition"),
        (null if timestamp is None else timestamp).cast("timestamp_ntz").alias("timestamp"),
        (null if key is None else key).cast("string").alias("key"),
        value.cast("string").alias("value"),
    )


def single(one: Column) -> Column:
    return F.array(one)


def multi(*records: Column) -> Column:
    return F.array(*records) if records else pass_through()


def pass_through() -> Column:
    return F.array().cast(RECORDS)


def explode_records(df: DataFrame, *kept: Column | str) -> DataFrame:
    """One row per record: ``kept``, ``pos`` and the fields of the record.

    Written with the outer variant and a filter on its output: for the inner one
    Spark infers a filter on the array and would build every envelope twice.
    """
    exploded = df.select(*kept, F.posexplode_outer("records").alias("pos", "_r"))
    return exploded.filter(F.col("pos").isNotNull()).select(
        *[c for c in exploded.columns if c != "_r"], "_r.*"
    )


def with_pass_through(df: DataFrame, value: Column) -> DataFrame:
    """Replace what passes through the envelope."""
    return df.withColumn("pass_through", value)


def route(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The envelope of the first condition that holds."""
    chosen = None
    for condition, records in cases:
        chosen = (
            F.when(condition, records) if chosen is None else chosen.when(condition, records)
        )
    return otherwise if chosen is None else chosen.otherwise(otherwise)
