"""Batches closed by size or by time, over a stream.

Time is the time of the records, so that a replay gives the same batches; the
clock of a key is the latest timestamp it has seen. The timer starts with the
first record of a key and anew with every closed batch; when it runs out with
nothing collected it is only set again. A *tick*, a row without an offset,
carries no element and moves the clock on.

A key's state is what it has collected, at most one batch. Rows of a key within
one micro-batch are sorted here, so the source only has to keep order between
micro-batches; limit its rate to bound a micro-batch.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from streamlog import model


def closings(
    clock: np.ndarray, sizes: np.ndarray, ticks: np.ndarray, limit: int,
    interval: int | None, started: int | None,
) -> tuple[np.ndarray, list[str], int | None]:
    """Batch of each row, why each batch was closed, and the timer afterwards.

    Rows of the batch that is still open have the number after the last reason.
    Works from batch to batch, not from row to row. ``clock`` must not fall.
    """
    n = len(clock)
    collected = np.cumsum(np.where(ticks, 0, sizes))
    numbers = np.zeros(n, np.int64)
    reasons: list[str] = []
    if started is None and n:
        started = int(clock[0])
    i = 0
    while i < n:
        if interval is not None and clock[i] - started >= interval:
            started += int((clock[i] - started) // interval) * interval
        if ticks[i]:
            numbers[i] = len(reasons)
            i += 1
            continue
        before = collected[i - 1] if i else 0
        full = int(np.searchsorted(collected, before + limit, side="left"))
        expired = n if interval is None else int(np.searchsorted(clock, started + interval, side="left"))
        end = min(full + 1, max(expired, i + 1), n)
        numbers[i:end] = len(reasons)
        if full < n and full + 1 == end:
            reasons.append("size")
            started = int(clock[full])
        elif expired < n:
            reasons.append("interval")
            started += interval
        i = end
    return numbers, reasons, started


class Collected:
    """State of a key: rows of the open batch, the timer, batches so far, deferred rows."""

    def __init__(self, state: GroupState) -> None:
        saved = json.loads(state.get[0]) if state.exists else {}
        self.rows: list[list] = saved.get("rows", [])
        self.started: int | None = saved.get("started")
        self.number: int = saved.get("number", 0)
        self.deferred: list[list] = saved.get("deferred", [])

    def save(self, state: GroupState) -> None:
        state.update((json.dumps(vars(self), default=lambda v: v.item()),))

    def close(self, rows: pd.DataFrame, limit: int, interval: int | None) -> pd.DataFrame:
        """Add ``rows`` to what is open; returns the rows of batches that closed.

        The rows get ``batch`` and ``closed_by``. Needs columns _clock, _size, _tick.
        """
        columns = list(rows.columns)
        if self.rows:
            rows = pd.concat([pd.DataFrame(self.rows, columns=columns), rows], ignore_index=True)
        clock = np.maximum.accumulate(rows["_clock"].to_numpy(np.int64))
        numbers, reasons, self.started = closings(
            clock, rows["_size"].to_numpy(np.int64), rows["_tick"].to_numpy(bool), limit, interval, self.started
        )
        rows = rows.assign(_clock=clock, batch=numbers + self.number)[~rows["_tick"].astype(bool)]
        open_ = rows["batch"] == self.number + len(reasons)
        self.rows = rows.loc[open_, columns].astype(object).values.tolist()
        by = dict(enumerate(reasons, self.number))
        self.number += len(reasons)
        closed = rows[~open_]
        return closed.assign(closed_by=closed["batch"].map(by))


def _micros(interval: datetime.timedelta | None) -> int | None:
    return None if interval is None else int(interval / datetime.timedelta(microseconds=1))


def _sorted_rows(frames: Iterator[pd.DataFrame], seq: str) -> pd.DataFrame:
    rows = pd.concat(list(frames), ignore_index=True)
    rows["_clock"] = rows["timestamp"].astype("datetime64[us]").astype("int64")
    rows["_tick"] = rows["offset"].isna()
    # Always by seq. Ticks without one come after the records they arrived with.
    return rows.sort_values([seq, "_clock"], na_position="last")


def grouped_within(
    stream: DataFrame, n: int, interval: datetime.timedelta, *, keys: list[str] = model.TP
) -> DataFrame:
    """Groups of up to n consecutive records, closed after ``interval`` at the latest.

    Output per group: the keys, group_no, closed_by, the values joined by commas,
    the highest offset and the size. ``stream`` has the keys, offset, timestamp
    and value.
    """
    types = dict(stream.dtypes)
    key_ddl = ", ".join(f"`{k}` {types[k]}" for k in keys)
    length = _micros(interval)
    out = [*keys, "group_no", "closed_by", "joined", "offset", "size"]

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        collected = Collected(state)
        rows = _sorted_rows(frames, "offset")[["offset", "value", "_clock", "_tick"]].assign(_size=1)
        closed = collected.close(rows, n, length)
        collected.save(state)
        groups = closed.groupby("batch", sort=True).agg(
            closed_by=("closed_by", "last"), joined=("value", ",".join), offset=("offset", "max"), size=("_size", "sum")
        )
        named = groups.reset_index(names="group_no").assign(**dict(zip(keys, key)))
        yield named[out].astype({"offset": "int64", "size": "int64"})

    needed = dict.fromkeys([*keys, "offset", "timestamp", "value"])
    return stream.select(*needed).groupBy(*keys).applyInPandasWithState(
        fold,
        f"{key_ddl}, group_no bigint, closed_by string, joined string, offset bigint, size bigint",
        "saved string", "append", GroupStateTimeout.NoTimeout,
    )


_ELEMENT = [*model.GTP, "offset", "metadata", "arrival_seq", "_clock", "_tick", "_size"]


def _hand_over(rows: pd.DataFrame, deferred: list[list]) -> tuple[pd.DataFrame, list[list]]:
    """Replace each row that raises its topic-partition's offset by the previous one.

    Returns the rows handed over, and those deferred now.
    """
    before = pd.DataFrame(deferred, columns=_ELEMENT).astype(rows.dtypes.to_dict())
    both = pd.concat([before, rows], ignore_index=True)
    offsets = both.groupby(model.GTP, sort=False)["offset"]
    highest = offsets.cummax().groupby([both[k] for k in model.GTP], sort=False).shift(1)
    same_batch = (both["_size"] > 1) & (both["offset"] == highest)
    raising = both[highest.isna() | (both["offset"] > highest) | same_batch]
    by_partition = raising.groupby(model.GTP, sort=False)
    held_back = ["offset", "metadata"]
    handed = raising.assign(**{c: by_partition[c].shift(1) for c in held_back})
    handed = handed[handed["offset"].notna()].assign(_size=1).astype(rows.dtypes.to_dict())
    return handed, by_partition.tail(1).astype(object).values.tolist()


def commit_batches(
    committables: DataFrame, max_batch: int, max_interval: datetime.timedelta | None = None, *,
    stream: list[str], when: str = "first_observed",
) -> DataFrame:
    """Offset batches of a stream of committables, closed by size or time.

    ``committables``: group_id, topic, partition, offset, metadata, arrival_seq,
    timestamp and batch_size. Output as ``commits.batch_flow``, plus closed_by.
    With ``when="next_observed"`` an offset is handed over when a higher one of
    its topic-partition arrives.
    """
    if when not in ("first_observed", "next_observed"):
        raise ValueError(f"unknown commit rule: {when}")
    types = dict(committables.dtypes)
    out_keys = list(dict.fromkeys([*stream, "batch", *model.GTP]))
    out = [*out_keys, "offset", "metadata", "updates", "last_seq", "closed_by"]
    ddl = ", ".join(
        f"`{k}` {'bigint' if k == 'batch' else types[k]}" for k in out_keys
    ) + ", offset bigint, metadata string, updates bigint, last_seq bigint, closed_by string"
    length = _micros(max_interval)

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        collected = Collected(state)
        rows = _sorted_rows(frames, "arrival_seq").rename(columns={"batch_size": "_size"})
        ticks = rows.loc[rows["_tick"], _ELEMENT]
        rows = rows.loc[~rows["_tick"], _ELEMENT].astype({"offset": "int64"})
        if when == "next_observed":
            rows, collected.deferred = _hand_over(rows, collected.deferred)
        if len(ticks):
            # A tick comes after the records that arrived before it.
            rows = pd.concat([rows, ticks], ignore_index=True).sort_values("arrival_seq", kind="stable")
        closed = collected.close(rows, max_batch, length)
        collected.save(state)
        batches = closed.groupby(["batch", *model.GTP], sort=False).agg(
            offset=("offset", "last"), metadata=("metadata", "last"), updates=("_size", "sum"),
            last_seq=("arrival_seq", "last"), closed_by=("closed_by", "last"),
        )
        named = batches.reset_index().assign(**dict(zip(stream, key)))
        whole = {c: "int64" for c in ("batch", "offset", "updates", "last_seq")}
        named = named[out].astype(whole)
        yield named.assign(offset=named["offset"] + 1)

    needed = [*model.GTP, "offset", "metadata", "arrival_seq", "timestamp", "batch_size"]
    return (
        committables.select(*dict.fromkeys([*stream, *needed]))
        .groupBy(*stream)
        .applyInPandasWithState(fold, ddl, "saved string", "append", GroupStateTimeout.NoTimeout)
    )
