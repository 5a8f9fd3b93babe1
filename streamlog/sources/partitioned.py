"""One ordered sub-stream per topic-partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import context, ordered
from streamlog.operators import meta
from streamlog.sources import subs


def summarise(records: DataFrame, *aggs: Column) -> DataFrame:
    """Aggregates per topic-partition; map-side combined, so skew is harmless."""
    return records.groupBy(*model.TP).agg(*aggs)


def numbered(records: DataFrame, *, name: str = "position") -> DataFrame:
    """Each record's 1-based place in its topic-partition."""
    return ordered.row_number(records, model.TP, "offset", name=name)


def apply_per_partition(
    records: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema,
    *,
    chunk_bits: int = ordered.CHUNK_BITS,
) -> DataFrame:
    """Run user code over the ordered records of each topic-partition.

    ``fn`` gets an iterator of pandas frames, each of one topic-partition and
    ascending in offset. A topic-partition is handed out in runs of at most
    ``2 ** chunk_bits`` offsets, so a hot one is worked on by many tasks; code
    that must carry state over the runs belongs in a streaming query.
    """
    run = F.shiftright("offset", chunk_bits)
    placed = records.repartition(*model.TP, run).sortWithinPartitions(*model.TP, "offset")

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def split() -> Iterator[pd.DataFrame]:
            for frame in frames:
                for _, part in frame.groupby(model.TP, sort=False):
                    yield part

        return fn(split())

    return placed.mapInPandas(batches, schema)


def from_offset_table(
    log: meta.Log, starts: DataFrame, *, committed: DataFrame | None = None,
    reset: str = "earliest",
) -> DataFrame:
    """Start at ``starts(topic, partition, offset)``; others use the reset policy.

    Both small tables have one row per topic-partition.
    """
    explicit = starts.select(*model.TP, F.col("offset").alias("_explicit"))
    known = meta.offset_range(log).join(explicit, model.TP, "left")
    return subs.from_starts(
        log, subs.resolve_start(known, committed, reset=reset, explicit="_explicit")
    )


def committable_from_offset_table(
    log: meta.Log, starts: DataFrame, group_id: str, *, metadata: Column | None = None, **options
) -> DataFrame:
    return context.with_context(from_offset_table(log, starts, **options), group_id, metadata)


def resume_points(records: DataFrame, processed: DataFrame) -> DataFrame:
    """First unprocessed offset per topic-partition after a sub-stream ended early.

    ``processed``: topic, partition, offset. Fully processed ones are left out.
    """
    done = processed.select(*model.TP, "offset").distinct()
    left = records.join(done, [*model.TP, "offset"], "left_anti")
    return left.groupBy(*model.TP).agg(F.min("offset").alias("resume_offset"))
