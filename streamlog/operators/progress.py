"""How far readers have come: received, requested and committed offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.workspace import measured


def received(records: DataFrame, assigned: DataFrame, *, order: str = "arrival_seq") -> DataFrame:
    """Last record of each assigned topic-partition in each poll batch."""
    mine = records.join(measured(assigned.select(*model.TP)), model.TP, "left_semi")
    return mine.groupBy("poll_batch", *model.TP).agg(
        F.max_by("offset", order).alias("offset"), F.max_by("timestamp", order).alias("timestamp")
    )


def commits(events: DataFrame) -> DataFrame:
    """Latest offset per topic-partition and kind ("requested", "committed").

    ``events``: seq, kind, topic, partition, offset.
    """
    updates = events.filter(F.col("kind").isin("requested", "committed"))
    return updates.groupBy(*model.TP, "kind").agg(F.max_by("offset", "seq").alias("offset"))


def state_at(events: DataFrame, seq: int | None = None) -> DataFrame:
    """Requested and committed offsets after the event ``seq`` (or all events).

    A revoke forgets a topic-partition. An assign sets both offsets only where
    there is none yet; later updates replace them. One row per topic-partition
    that is known; ``assigned`` tells whether an assign is in force.
    """
    if seq is not None:
        events = events.filter(F.col("seq") <= seq)

    def seq_of(kind: str) -> Column:
        return F.when(F.col("kind") == kind, F.col("seq"))

    revoked = measured(events.groupBy(*model.TP).agg(F.max(seq_of("revoke")).alias("_revoked")))
    current = events.join(revoked, model.TP).filter(
        F.col("_revoked").isNull() | (F.col("seq") > F.col("_revoked"))
    )
    initial = F.min_by("offset", seq_of("assign"))
    return current.groupBy(*model.TP).agg(
        F.coalesce(F.max_by("offset", seq_of("requested")), initial).alias("requested"),
        F.coalesce(F.max_by("offset", seq_of("committed")), initial).alias("committed"),
        F.max(seq_of("assign")).isNotNull().alias("assigned"),
    )


def in_flight(records: DataFrame, committed: DataFrame, *, order: str = "arrival_seq") -> DataFrame:
    """Last emitted offset per topic-partition until exactly that offset is committed.

    ``committed``: topic, partition, offset, where offset is the processed one.
    """
    last = records.groupBy(*model.TP).agg(F.max_by("offset", order).alias("offset"))
    return last.join(committed.select(*model.TP, "offset"), [*model.TP, "offset"], "left_anti")
