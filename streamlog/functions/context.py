"""The commit context that travels with a record in the ``ctx`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model


def with_context(df: DataFrame, group_id: str, metadata: Column | None = None) -> DataFrame:
    if not group_id:
        raise ValueError("a group id is required to commit offsets")
    text = F.lit(model.NO_METADATA) if metadata is None else metadata.cast("string")
    ctx = F.struct(
        F.lit(group_id).alias("group_id"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.coalesce(text, F.lit(model.NO_METADATA)).alias("metadata"),
    )
    return df.withColumn("ctx", ctx)


def map_data(df: DataFrame, *data: Column | str) -> DataFrame:
    """Replace the data columns; the context is carried along untouched."""
    return df.select(*data, "ctx")


def committables(df: DataFrame, *, seq: str) -> DataFrame:
    """The contexts of ``df`` as commit input; rows without one are dropped."""
    return (
        df.filter(F.col("ctx").isNotNull())
        .select("ctx.*", F.col(seq).alias("arrival_seq"))
        .withColumn("batch_size", F.lit(1).cast("bigint"))
    )
