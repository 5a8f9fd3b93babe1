"""Log tables: Parquet partitioned by topic and partition, with dense offsets.

Partition directories give pruning for topic and partition predicates. Files are
written in offset order, so the min/max statistics of ``offset`` and
``timestamp`` let a scan skip files and row groups when it starts at an offset.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import ordered
from streamlog.workspace import materialize, measured


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(model.LOG).parquet(path)


def read_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.schema(model.LOG).options(**options).parquet(path)


def write(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy(*model.TP).parquet(path)


def with_base(df: DataFrame, base: DataFrame | None, position: Column) -> DataFrame:
    """``offset`` = first free offset of the topic-partition + ``position``.

    ``base`` holds (topic, partition, end_offset); unknown ones start at 0.
    """
    if base is None:
        return df.withColumn("offset", position.cast("bigint"))
    ends = measured(base.select(*model.TP, F.col("end_offset").alias("_base")), "ends")
    joined = df.join(ends, model.TP, "left")
    start = F.coalesce(F.col("_base"), F.lit(0))
    return joined.withColumn("offset", (start + position).cast("bigint")).drop("_base")


def append_offsets(
    df: DataFrame, *, seq: str, then: tuple[str, ...] = (), base: DataFrame | None = None
) -> DataFrame:
    """Give each record the next offset of its topic-partition, in ``seq`` order.

    ``seq`` is a unique integer per topic-partition; few records may share one if
    ``then`` orders them. Lazy: only built-in
    operators, and no task holds more than one chunk of a topic-partition.
    """
    numbered = ordered.row_number(df, model.TP, seq, then=then, name="_rn")
    return with_base(numbered, base, F.col("_rn") - 1).drop("_rn")


@dataclass(frozen=True)
class Placed:
    """Records with offsets; ``first_offset`` and ``end_offset`` of each topic-partition they went to."""

    records: DataFrame
    ends: DataFrame


def place_sorted(
    df: DataFrame, *, order_by: list[str], base: DataFrame | None = None
) -> Placed:
    """As ``append_offsets`` for any sort order, e.g. (timestamp, id).

    One range shuffle sorts the records; Spark samples the ranges, so a hot
    topic-partition spans many of them. The position is pinned by writing the
    sorted rows to the shared folder, then per-range counts are summed up and
    joined back. Both jobs end before the lazy part begins.
    """
    ordering = [*model.TP, *order_by]
    placed = materialize(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "sorted",
    )
    # The id holds the range number in its upper bits and counts rows below them.
    placed = placed.withColumn("_range", F.shiftright("_pos", 33))
    ranges = placed.groupBy(*model.TP, "_range").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = (
        Window.partitionBy(*model.TP).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    ranges = ranges.withColumn("_before", before)
    if base is None:
        ranges = ranges.withColumn("_base", F.lit(0))
    else:
        ends = base.select(*model.TP, F.col("end_offset").alias("_base"))
        ranges = ranges.join(ends, model.TP, "left")
    start = F.coalesce(F.col("_base"), F.lit(0)) + F.col("_before")
    whole = Window.partitionBy(*model.TP)
    ranges = measured(
        ranges.select(
            *model.TP,
            "_range",
            (start - F.col("_first")).alias("_shift"),
            (start + F.col("_n")).alias("end_offset"),
            F.min(start).over(whole).alias("first_offset"),
            (F.col("_range") == F.max("_range").over(whole)).alias("_last"),
        ),
        "ranges",
    )
    shifts = ranges.select(*model.TP, "_range", "_shift")
    records = (
        placed.join(shifts, [*model.TP, "_range"])
        .withColumn("offset", (F.col("_pos") + F.col("_shift")).cast("bigint"))
        .drop("_pos", "_range", "_shift")
    )
    return Placed(records, ranges.filter("_last").select(*model.TP, "first_offset", "end_offset"))


def append_offsets_sorted(
    df: DataFrame, *, order_by: list[str], base: DataFrame | None = None
) -> DataFrame:
    """The records of ``place_sorted``."""
    return place_sorted(df, order_by=order_by, base=base).records
