"""Mixing sources to target weights by hash thresholds.

Every document has a 60-bit hash of its id. The tokens of a source that fall
below a threshold are the share the mix takes, so a budget becomes a threshold.
Tokens are summed by source and hash bucket (4,096 buckets, partial sums before
the shuffle); the bucket in which the running sum crosses the budget is the only
one that is looked at again, with the next 12 bits, until it holds one hash
value. Nothing is sorted but the buckets. Thresholds are nested: a larger budget
takes a superset.

A target above the size of its source means whole copies first and a threshold
for the rest. Targets follow the weights; a source stops at ``most_copies`` times
its size and the others share the excess by weight: target = min(cap, level *
weight), where the level comes from running sums over the sources ordered by
cap / weight. These windows hold one row per source, in one task.

Defined results: null text has size 0; a null source is a source, after all
others; documents with one hash (repeated ids) are taken or left together; the
last such group is taken if that brings the source nearer to its target; an
empty table gives no rows. Columns other than id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlog import workspace

#: Bits per refinement and number of refinements; together the 60 bits of the hash.
STEP_BITS, STEPS = 12, 5
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """60 bits, uniform; computed alike by any engine that has md5."""
    hexed = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(hexed, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most_copies: int = 2) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    caps = sizes.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most_copies).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    up_to = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    on = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = caps.select(
        "*",
        ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0)))
         / F.sum("weight").over(on)).alias("level"),
    )
    # Level after level rises while sources stop at their cap, and falls after that.
    held = level.withColumn("level", F.max("level").over(everything))
    return held.select(
        "source", "source_size",
        F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"),
    )


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``copies`` and ``limit`` to ``sources``: hashes below ``limit`` are taken once more."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = workspace.measured(
        sources.select(
            "source", "source_size", "target", copies.cast("long").alias("copies"),
            (F.col("target") - copies * F.col("source_size")).alias("budget"),
            F.lit(0).cast("long").alias("low"), F.lit(False).alias("closed"),
        ),
        "mix-state",
    )
    for step in range(STEPS):
        shift = STEP_BITS * (STEPS - 1 - step)
        inside = (F.col("hash") >= F.col("low")) & (
            F.shiftright("hash", shift + STEP_BITS) == F.shiftright("low", shift + STEP_BITS)
        )
        open_ = state.where(~F.col("closed")).select(F.col("source").alias("s"), "low")
        sums = (
            rows.join(open_, F.col("source").eqNullSafe(F.col("s")))
            .where(inside)
            .groupBy("source", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("tokens"), F.min("hash").alias("least"), F.max("hash").alias("most"))
        )
        upto = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("tokens").over(upto)).select(F.col("source").alias("s"), "bucket", "tokens", "least", "most", "upto")
        # The first bucket in which the running sum passes the budget; at most one per source.
        crossing = state.select("source", "budget").join(sums, F.col("source").eqNullSafe(F.col("s"))).where(
            (F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("tokens") <= F.col("budget")) & (F.col("tokens") > 0)
        ).select("s", "bucket", "least", "most", "tokens", (F.col("upto") - F.col("tokens")).alias("before"))
        rest = F.col("budget") - F.col("before")
        single = F.col("least") == F.col("most")
        nearer = F.col("tokens") - rest < rest
        state = workspace.measured(
            state.join(crossing, (F.col("source").eqNullSafe(F.col("s"))) & ~F.col("closed"), "left").select(
                "source", "source_size", "target", "copies",
                F.when(F.col("closed") | F.col("bucket").isNull(), F.col("budget")).otherwise(rest).alias("budget"),
                F.when(F.col("closed"), F.col("low"))
                .when(F.col("bucket").isNull(), F.lit(1 << 60))  # all hashes fit the budget
                .when(single & nearer, F.col("least") + 1)
                .when(single, F.col("least"))
                .otherwise(F.shiftleft(F.col("bucket"), shift)).alias("low"),
                (F.col("closed") | F.col("bucket").isNull() | single).alias("closed"),
            ),
            "mix-state",
        )
        if state.where(~F.col("closed")).isEmpty():
            break
    return state.select("source", "source_size", "target", "copies", F.col("low").alias("limit"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most_copies: int = 2,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): ``rows`` has id, source, size, source_size, target and copies of every document."""
    rows = workspace.materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("hash"),
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = thresholds(rows, targets(sizes, weights, share, most_copies))
    held = limits.withColumnRenamed("source", "s")
    copies = F.col("copies") + (F.col("hash") < F.col("limit")).cast("long")
    taken = rows.join(held, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies")
    )
    return taken, limits


def apply_mix(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken; documents of size 0 add nothing and go."""
    held = limits.select(F.col("source").alias("_s"), F.col("copies").alias("_copies"), F.col("limit").alias("_limit"))
    copies = F.col("_copies") + (id_hash(F.col("doc_id")) < F.col("_limit")).cast("long")
    return (
        docs.join(held, F.col("source").eqNullSafe(F.col("_s")))
        .where((copies > 0) & (n_words(F.col("text")) > 0))
        .withColumn("_again", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(*docs.columns)
    )
