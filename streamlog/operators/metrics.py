"""Summaries of metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summarise(samples: DataFrame, *, gauge: str = "last") -> DataFrame:
    """One value per metric; ``samples``: metric, kind, at, value.

    A counter is its last minus its first value. A gauge is its last value, or a
    statistic of all samples: "mean", "min" or "max".
    """
    last = F.max_by("value", "at")
    statistics = {"last": last, "mean": F.avg("value"), "min": F.min("value"), "max": F.max("value")}
    value = F.when(F.col("kind") == "counter", last - F.min_by("value", "at")).otherwise(
        statistics[gauge]
    )
    return samples.groupBy("metric", "kind").agg(
        F.count(F.lit(1)).alias("samples"), value.alias("value")
    )
