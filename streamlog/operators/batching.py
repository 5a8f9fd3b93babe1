"""Groups of consecutive records, and how to take them apart again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import ordered
from streamlog.workspace import measured


def take(records: DataFrame, n: int) -> DataFrame:
    """The first n records in (topic, partition, offset) order."""
    return records.orderBy(*model.TP, "offset").limit(n)


def take_per_partition(records: DataFrame, n: int) -> DataFrame:
    """The first n records of each topic-partition.

    The chunk window leaves at most n rows per chunk before the exact rank is
    taken, so a hot topic-partition is cut down where its chunks are.
    """
    chunk = F.shiftright("offset", ordered.CHUNK_BITS)
    local = Window.partitionBy(*model.TP, chunk).orderBy("offset")
    first = records.withColumn("_rn", F.row_number().over(local)).filter(F.col("_rn") <= n)
    whole = Window.partitionBy(*model.TP).orderBy("offset")
    return first.withColumn("_rn", F.row_number().over(whole)).filter(F.col("_rn") <= n).drop("_rn")


def take_while(records: DataFrame, keep: Column, *, inclusive: bool = False) -> DataFrame:
    """Each topic-partition up to its first record that fails ``keep``.

    ``inclusive`` also returns that record. The cut-off is one aggregate value
    per topic-partition, so no ordering of the records is needed.
    """
    stop = measured(
        records.groupBy(*model.TP).agg(
            F.min(F.when(~F.coalesce(keep, F.lit(False)), F.col("offset"))).alias("_stop")
        )
    )
    before = F.col("offset") <= F.col("_stop") if inclusive else F.col("offset") < F.col("_stop")
    return records.join(stop, model.TP).filter(F.col("_stop").isNull() | before).drop("_stop")


def running_count(records: DataFrame, *, name: str = "running") -> DataFrame:
    """Count of records so far in each topic-partition."""
    return ordered.row_number(records, model.TP, "offset", name=name)


def group_numbers(
    records: DataFrame, n: int, *, keys: list[str] = model.TP, seq: str = "offset"
) -> DataFrame:
    """Add ``group_no``: n consecutive records of a key share one."""
    numbered = ordered.row_number(records, keys, seq, name="_rn")
    return numbered.withColumn("group_no", F.expr(f"(_rn - 1) div {n}")).drop("_rn")


def grouped(
    records: DataFrame, n: int, *, keys: list[str] = model.TP, seq: str = "offset"
) -> DataFrame:
    """Groups of n consecutive records with their values in order.

    ``offset`` is the highest of the group, which is what the group commits.
    """
    ordered_values = F.array_sort(F.collect_list(F.struct(seq, "value")))
    return group_numbers(records, n, keys=keys, seq=seq).groupBy(*keys, "group_no").agg(
        F.transform(ordered_values, lambda r: r["value"]).alias("values"),
        F.max("offset").alias("offset"),
        F.count(F.lit(1)).alias("size"),
    )


def sums_and_concats(
    records: DataFrame, n: int, number: Column, *, keys: list[str] = model.TP, seq: str = "offset"
) -> DataFrame:
    """Per group of n: the sum of ``number`` and the values joined in order."""
    ordered_values = F.array_sort(F.collect_list(F.struct(seq, "value")))
    return group_numbers(records.withColumn("_n", number), n, keys=keys, seq=seq).groupBy(
        *keys, "group_no"
    ).agg(
        F.sum("_n").alias("total"),
        F.concat_ws("", F.transform(ordered_values, lambda r: r["value"])).alias("joined"),
        F.max("offset").alias("offset"),
    )


def unbatch(groups: DataFrame, values: str = "values", ctx: str = "ctx") -> DataFrame:
    """One row per element; only the last element of a group carries the context."""
    others = [c for c in groups.columns if c not in (values, ctx)]
    split = groups.withColumn("_size", F.size(values)).select(
        *others, ctx, "_size", F.posexplode(values).alias("pos", "value")
    )
    last = F.col("pos") == F.col("_size") - 1
    return split.withColumn(ctx, F.when(last, F.col(ctx))).drop("_size")
