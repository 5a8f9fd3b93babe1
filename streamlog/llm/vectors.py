"""Vectors as integer components, for operators that must give the same result everywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer components must be smaller than this, so that squared distances fit 64 bits.
LARGEST = 1 << 28


def _finite(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def integers(rows: DataFrame, vector_col: str, keep: dict[str, Column], scale: int = 256) -> tuple[DataFrame, int, int]:
    """The columns of ``keep`` and ``q``, floor(scale * component), of usable rows; their dimension and largest |q|.

    Usable is a vector that is neither null nor empty, has finite components only and the
    commonest length of such vectors (of equally common lengths the greater). Without a usable
    row the dimension is 0. A component that reaches ``LARGEST`` is an error, not a wrong result.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    q = F.transform(vector, lambda x: F.floor(x * scale))
    usable = rows.where(_finite(vector) & (F.size(vector) > 0)).select(*[c.alias(n) for n, c in keep.items()], q.alias("q"))
    shape = (
        usable.groupBy(F.size("q").alias("dim"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("q", lambda x: F.abs(x)))).alias("most"))
        .orderBy(F.desc("n"), F.desc("dim"))
        .first()
    )
    if shape is None:
        return usable.where("false"), 0, 0
    if shape["most"] >= LARGEST:
        raise ValueError(f"a component times {scale} reaches {LARGEST}")
    return usable.where(F.size("q") == shape["dim"]).withColumn("q", F.col("q").cast("array<int>")), shape["dim"], shape["most"]


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column without nulls as int64 rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)
