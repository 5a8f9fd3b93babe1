"""Sinks that write log tables: partition chosen, offsets given, each micro-batch appended once."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog import model
from streamlog.functions import partitioner
from streamlog.sources import log
from streamlog.sources.table import LogTable
from streamlog.workspace import query_id, scratch


def with_partition(records: DataFrame, partitions: int | None) -> DataFrame:
    """A record without a partition gets that of its key, which needs the number of ``partitions``."""
    choices = [F.col("partition")] if "partition" in records.columns else []
    if partitions is not None:
        choices.append(partitioner.partition_for_key(F.col("key"), partitions))
    choices.append(F.raise_error(F.lit("record without partition")).cast("int"))
    return records.withColumn("partition", F.coalesce(*choices))


def append(table: LogTable, records: DataFrame, name: str, order_by: list[str], *, partitions: int | None = None) -> bool:
    """Append records after the ends of their topic-partitions, in the given order; False if ``name`` is there already.

    Columns of a log that ``records`` lack are empty.
    """
    if table.has(name):
        return False
    with scratch(table.spark):
        placed = log.place_sorted(with_partition(records, partitions), order_by=order_by, base=table.offset_range()).records
        empty = {
            f.name: (F.array() if f.name == "headers" else F.lit(None)).cast(f.dataType)
            for f in model.LOG.fields if f.name not in placed.columns
        }
        return table.append(placed.withColumns(empty), name)


def plain(
    records: DataFrame, table: LogTable, checkpoint: str, order_by: list[str], *,
    partitions: int | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream of records (topic, key, value; partition and timestamp if known) to a log table.

    A micro-batch is one append under the query's id and its number, so a replay adds nothing. One query
    writes a table at a time. For brokers, the same columns go to ``writeStream.format("kafka")``.
    """

    @functools.cache
    def own_id() -> str:
        return query_id(table.spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(table, batch, f"{own_id()}-{batch_id}", order_by, partitions=partitions)

    return (
        records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
