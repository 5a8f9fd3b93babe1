"""Entities on shards: the shard of an entity is the partition of its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog.functions import partitioner
from streamlog.operators import meta
from streamlog.workspace import measured


def with_shard(df: DataFrame, partitions: int, *, entity_id: Column | None = None) -> DataFrame:
    """Add ``entity_id`` (default: the record key) and ``shard``."""
    entity = F.col("key") if entity_id is None else entity_id
    return df.withColumn("entity_id", entity).withColumn(
        "shard", partitioner.shard_id(F.col("entity_id"), partitions)
    )


def with_shard_of_topic(
    df: DataFrame, log: meta.Log, topic: str, *, entity_id: Column | None = None
) -> DataFrame:
    """As ``with_shard``, with the partition count of ``topic`` looked up in the log.

    Partitions are numbered from 0, so the highest number counts. A ``LogTable`` knows partitions
    that are still empty; a DataFrame only those that hold a record. One number comes to the driver.
    """
    last = meta.partitions_for(log, topic).agg(F.max("partition")).first()[0]
    if last is None:
        raise ValueError(f"no such topic: {topic}")
    return with_shard(df, last + 1, entity_id=entity_id)


def locate(sharded: DataFrame, assignment: DataFrame) -> DataFrame:
    """Member that hosts each entity: whoever reads partition n hosts shard "n".

    ``assignment``: member, partition of the sharding topic.
    """
    hosts = assignment.select("member", F.col("partition").cast("string").alias("shard"))
    return sharded.join(measured(hosts), "shard")


def regions(assignment: DataFrame) -> DataFrame:
    """Shards per member."""
    return assignment.groupBy("member").agg(
        F.sort_array(F.collect_set(F.col("partition"))).alias("shards")
    )


