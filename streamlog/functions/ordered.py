"""Ordered computations over keys of any size.

``Window.partitionBy(key).orderBy(seq)`` puts a whole key into one task, which
fails when one topic-partition holds a third of the log. Here every key is cut
into chunks of consecutive ``seq`` values. A chunk holds at most ``2 ** bits``
rows because ``seq`` is a unique integer within the key (an offset or an arrival
number). Each function

1. reduces every chunk to one row (map-side combined, little is shuffled),
2. carries values across the chunks of a key with a window over those rows,
3. joins the carried value back and finishes inside the chunk.

The chunk rows are fewer than the records by up to ``2 ** bits``, so their window
is small. The records themselves are shuffled and sorted once, by key and chunk.

Keys and ``seq`` must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 17
_CHUNK = "_chunk"


def _chunk_of(seq: str, bits: int) -> Column:
    return F.shiftright(F.col(seq).cast("bigint"), bits)


def _earlier(keys: list[str]):
    return (
        Window.partitionBy(*keys)
        .orderBy(_CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _inside(keys: list[str], *order: str):
    return Window.partitionBy(*keys, _CHUNK).orderBy(*order)


def _with_carry(df: DataFrame, keys: list[str], bits: int, seq: str, aggs, carry) -> DataFrame:
    chunked = df.withColumn(_CHUNK, _chunk_of(seq, bits))
    per_chunk = chunked.groupBy(*keys, _CHUNK).agg(*aggs)
    # The window needs the rows shuffled by chunk anyway. A hash join on the same
    # columns uses that shuffle and, unlike a merge join, adds no sort.
    carried = per_chunk.select(*keys, _CHUNK, carry.alias("_carry")).hint("shuffle_hash")
    return chunked.join(carried, [*keys, _CHUNK])


def row_number(
    df: DataFrame, keys: list[str], seq: str, *, then: tuple[str, ...] = (), name: str = "rn",
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """1-based position of each row within its key by ``seq``.

    ``then`` orders rows of equal ``seq``, such as the records of one envelope.
    """
    rows = _with_carry(
        df, keys, bits, seq,
        [F.count(F.lit(1)).alias("_n")],
        F.coalesce(F.sum("_n").over(_earlier(keys)), F.lit(0)),
    )
    number = F.col("_carry") + F.row_number().over(_inside(keys, seq, *then))
    return rows.withColumn(name, number.cast("bigint")).drop(_CHUNK, "_carry")


def running_sum(
    df: DataFrame, keys: list[str], seq: str, value: Column, *,
    name: str, inclusive: bool = True, bits: int = CHUNK_BITS,
) -> DataFrame:
    """Sum of ``value`` over this and earlier (or only earlier) rows of the key."""
    rows = _with_carry(
        df.withColumn("_v", value), keys, bits, seq,
        [F.sum("_v").alias("_s")],
        F.coalesce(F.sum("_s").over(_earlier(keys)), F.lit(0)),
    )
    frame = _inside(keys, seq).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    total = F.col("_carry") + F.coalesce(F.sum("_v").over(frame), F.lit(0))
    return rows.withColumn(name, total).drop(_CHUNK, "_carry", "_v")


def running_max(
    df: DataFrame, keys: list[str], seq: str, value: Column, *,
    name: str, inclusive: bool = False, bits: int = CHUNK_BITS,
) -> DataFrame:
    """Largest ``value`` of earlier rows of the key (NULL on the first)."""
    rows = _with_carry(
        df.withColumn("_v", value), keys, bits, seq,
        [F.max("_v").alias("_m")],
        F.max("_m").over(_earlier(keys)),
    )
    frame = _inside(keys, seq).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    best = F.greatest(F.col("_carry"), F.max("_v").over(frame))
    return rows.withColumn(name, best).drop(_CHUNK, "_carry", "_v")


def lead(
    df: DataFrame, keys: list[str], seq: str, value: str, *, name: str, bits: int = CHUNK_BITS
) -> DataFrame:
    """``value`` of the next row of the key by ``seq`` (NULL on the last).

    ``value`` must not be NULL.
    """
    rows = _with_carry(
        df, keys, bits, seq,
        [F.min_by(value, seq).alias("_first")],
        F.lead("_first").over(Window.partitionBy(*keys).orderBy(_CHUNK)),
    )
    following = F.coalesce(F.lead(value).over(_inside(keys, seq)), F.col("_carry"))
    return rows.withColumn(name, following).drop(_CHUNK, "_carry")
