"""Protection against offsets that jump back.

All records of one topic-partition in one poll are dropped when the first or the
last of them lies too far before what was already requested (offsets) or safely
received (timestamps). Only the two ends are looked at, so a poll is reduced to
one row by a hash aggregate before anything else happens.

Requests and commits are events. With a column ``poll_batch`` an event counts from
the next poll on; without it, it was there before the first one. A poll is judged
by the latest event before it, never by a later one.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import model
from streamlog.functions import ordered
from streamlog.operators import folds
from streamlog.workspace import measured

POLL = [*model.TP, "poll_batch"]


def _poll_ends(records: DataFrame, order: str) -> DataFrame:
    return records.groupBy(*POLL).agg(
        F.min_by("offset", order).alias("first_offset"),
        F.max_by("offset", order).alias("last_offset"),
        F.min_by("timestamp", order).alias("first_timestamp"),
        F.max_by("timestamp", order).alias("last_timestamp"),
    )


def _as_of(
    polls: DataFrame, events: DataFrame, name: str, bits: int = ordered.CHUNK_BITS
) -> DataFrame:
    """Add the offset of the latest event before each poll, NULL if there was none."""
    at = F.col("poll_batch") if "poll_batch" in events.columns else F.lit(-1)
    made = events.select(*model.TP, at.cast("bigint").alias("poll_batch"), "offset")
    made = made.groupBy(*POLL).agg(F.max("offset").alias("_event")).withColumn("_seq", F.col("poll_batch") * 2 + 1)
    both = polls.withColumn("_seq", F.col("poll_batch") * 2).unionByName(made, allowMissingColumns=True)
    latest = F.when(F.col("_event").isNotNull(), F.struct("_seq", "_event"))
    carried = ordered.running_max(both, model.TP, "_seq", latest, name="_latest", bits=bits)
    rows = carried.filter("_event IS NULL").withColumn(name, F.col("_latest._event"))
    return rows.select(*polls.columns, name)


def _micros(timestamp: Column) -> Column:
    """Microseconds between zone-less timestamps and 1970, whatever the session zone."""
    epoch = F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz")
    since = timestamp.cast("timestamp_ntz") - epoch

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), since)

    minutes = (part("day").cast("bigint") * 24 + part("hour")) * 60 + part("minute")
    # Seconds are a decimal with microseconds.
    return minutes * 60_000_000 + (part("second") * 1_000_000).cast("bigint")


def judge_polls(
    records: DataFrame, requested: DataFrame, *, offset_threshold: int | None,
    time_threshold: datetime.timedelta | None = None, order: str = "arrival_seq",
    chunk_bits: int = ordered.CHUNK_BITS, group_bits: int = folds.GROUP_BITS,
) -> DataFrame:
    """One row per poll and topic-partition with ``safe``.

    ``requested``: topic, partition, offset and, for events, poll_batch. A poll
    before the first request is safe. A time threshold compares with the last
    *safe* poll.
    """
    polls = _as_of(_poll_ends(records, order), requested, "requested", chunk_bits)
    known = F.col("requested").isNotNull()
    rewound = F.lit(False)
    if offset_threshold is not None:
        lowest = F.least("first_offset", "last_offset")
        rewound = known & (lowest < F.col("requested") - offset_threshold)
    if time_threshold is None:
        return polls.withColumn("safe", ~rewound)

    # Narrow, one row per poll, and read by several steps below: judged once, from one scan of the records.
    polls = measured(polls, "polls")
    span = int(time_threshold / datetime.timedelta(microseconds=1))
    forever = F.lit((1 << 62))
    earliest = F.least(_micros(F.col("first_timestamp")), _micros(F.col("last_timestamp")))
    # Without timestamps, or before any request, every state is acceptable.
    allow = F.when(~known | earliest.isNull(), forever).otherwise(
        F.greatest(earliest, F.lit(0)) + span
    )
    judged = folds.safe_polls(
        polls.select(
            *POLL,
            F.when(~rewound, allow).alias("allow"),
            _micros(F.col("last_timestamp")).alias("next"),
        ),
        model.TP,
        "poll_batch",
        chunk_bits=chunk_bits,
        group_bits=group_bits,
    )
    return polls.join(judged, POLL)


def reset_filter(records: DataFrame, requested: DataFrame, **thresholds) -> DataFrame:
    """The records that are safe to hand on; see ``judge_polls`` for the thresholds."""
    judged = judge_polls(records, requested, **thresholds)
    unsafe = measured(judged.filter(~F.col("safe")).select(*POLL), "unsafe")
    return records.join(unsafe, POLL, "left_anti")


def seeks(
    records: DataFrame, requested: DataFrame, committed: DataFrame, *,
    offset_threshold: int | None, **thresholds,
) -> DataFrame:
    """Where to read again after a dropped poll: the offset committed by then.

    ``far_behind`` warns that the last request is itself more than the threshold
    ahead of the committed offset, which makes a reader seek again and again.
    """
    judged = judge_polls(records, requested, offset_threshold=offset_threshold, **thresholds)
    dropped = _as_of(judged.filter(~F.col("safe")), committed, "seek_offset")
    behind = F.lit(False)
    if offset_threshold is not None:
        behind = F.col("requested") - F.col("seek_offset") > offset_threshold
    return dropped.select(*POLL, "seek_offset", behind.alias("far_behind"))
