"""Checks that prove delivery: nothing lost, nothing twice, everything in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import ordered


def duplicates(records: DataFrame, *, expected: int = 1) -> DataFrame:
    """Values stored at more offsets than expected."""
    places = records.select("value", *model.TP, "offset").distinct()
    return (
        places.groupBy("value").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > expected)
    )


def missing(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected integers ``v`` that were not observed."""
    return expected.join(observed.select("v").distinct(), "v", "left_anti")


def missing_blocks(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Missing integers as runs: first, last, size, and the first ten of each."""
    gone = ordered.row_number(missing(expected, observed), [], "v", name="_rn")
    runs = gone.groupBy((F.col("v") - F.col("_rn")).alias("_run")).agg(
        F.min("v").alias("first"), F.max("v").alias("last"), F.count(F.lit(1)).alias("size")
    )
    head = F.sequence(F.col("first"), F.least(F.col("last"), F.col("first") + 9))
    return runs.select("first", "last", "size", head.alias("first_ten"))


def partition_sequence(records: DataFrame, value: Column, *, start: int = 0) -> DataFrame:
    """Per topic-partition: records, and those whose value breaks start, start+1, ..."""
    placed = ordered.row_number(records, model.TP, "offset", name="_rn")
    wrong = (value != F.col("_rn") - 1 + start) | value.isNull()
    return placed.groupBy(*model.TP).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(wrong).alias("mismatches")
    )


def same_multiset(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side; empty when both are equal."""
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    counted = both.groupBy(*columns).agg(F.sum("_side").alias("surplus"))
    return counted.filter(F.col("surplus") != 0)


def at_least(sent: DataFrame, received: DataFrame, keys: list[str]) -> DataFrame:
    """Sent and received counts per key, and whether at least as many arrived."""
    a = sent.groupBy(*keys).agg(F.count(F.lit(1)).alias("sent"))
    b = received.groupBy(*keys).agg(F.count(F.lit(1)).alias("received"))
    got = F.coalesce("received", F.lit(0))
    return a.join(b, keys, "left").select(
        *keys, "sent", got.alias("received"), (got >= F.col("sent")).alias("complete")
    )


def gaps(log: DataFrame, *, chunk_bits: int = ordered.CHUNK_BITS) -> DataFrame:
    """Holes in the offsets of a topic-partition: the offsets around, and how many."""
    offsets = log.select(*model.TP, "offset")
    following = ordered.lead(offsets, model.TP, "offset", "offset", name="next_offset", bits=chunk_bits)
    hole = F.col("next_offset") - F.col("offset") - 1
    return following.filter(hole > 0).select(*model.TP, "offset", "next_offset", hole.alias("missing"))
