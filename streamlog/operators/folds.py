"""Ordered folds with a reset, computed chunk by chunk.

Some rules depend on everything before a row: a batch closes when the sizes since
the last close reach a limit; a poll is unsafe compared with the last safe one.
Such a fold looks sequential, but a chunk of rows is a function from the state
before it to the state after it, and functions can be tabulated per chunk in
parallel and then chained. The three steps are

1. tabulate each chunk (its rows go to one task; a chunk is bounded),
2. chain the tables of a key, which gives every chunk its entry state,
3. replay each chunk from its entry state.

Chaining is done in levels, so no task holds the tables of a whole hot key.

A call of Python costs as much as thousands of rows, so chunks smaller than a block
of ``2 ** BLOCK_BITS`` numbers share one: a step takes a block and treats each chunk,
or each group of chunks, in it by itself.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.workspace import materialize

CHUNK_BITS = 17
BLOCK_BITS = 17
GROUP_BITS = 10  # chunks whose tables are chained in one task
SIZE_GROUP_BITS = 5  # the same for tables of sizes, which may be large


def _runs(values: np.ndarray) -> list[slice]:
    """Where equal neighbours stand."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [slice(*ends) for ends in zip(cuts, cuts[1:])]


def _block_of(column: str, bits: int) -> Column:
    """The block of parts that span ``2 ** bits`` numbers each; a larger part is a block."""
    return F.shiftright(column, max(0, BLOCK_BITS - bits)).alias("_block")


# -- closing by size ---------------------------------------------------------
# State: the size collected since the last close, below the limit. A table cuts
# the states into pieces, rows of an array: the first state of the piece, the
# state it ends as, the closes seen, and 1 if later states of the piece end as
# many states later, 0 if all end alike. It has no more pieces than the chunk has
# rows plus one, and no more than ``limit``.


def _joined(pieces: np.ndarray, limit: int) -> np.ndarray:
    """The same table with as few pieces as neighbours allow."""
    for slope in (0, 1):  # pieces that end alike first, then pieces in step
        start, end, closes, _ = pieces
        single = np.diff(start, append=limit) == 1  # a piece of one state has either slope
        fits = single | (pieces[3] == slope)
        in_step = np.diff(end) == slope * np.diff(start)
        follows = np.r_[False, fits[1:] & fits[:-1] & in_step & (np.diff(closes) == 0)]
        pieces[3] = np.where(np.r_[follows[1:], False], slope, np.where(single, 0, pieces[3]))
        pieces = pieces[:, ~follows]
    return pieces


def _size_table(sizes: np.ndarray, limit: int) -> np.ndarray:
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    # A batch that starts fresh before row i starts again before row jump[i];
    # if the chunk does not close it, it stays there.
    closing = np.searchsorted(total[1:], total + limit, side="left")
    closes = (closing < n).astype(np.int64)
    jump = np.where(closes == 1, closing + 1, np.arange(n + 1))
    while (jump != jump[jump]).any():  # twice as far each time
        closes, jump = closes + closes[jump], jump[jump]
    left = total[-1] - total[jump]
    # Row i closes the states from limit - total[i + 1] on that no later row of the chunk is needed for.
    row = np.flatnonzero((np.diff(total) > 0) & (total[:-1] < limit))[::-1]
    pieces = np.stack(
        [np.maximum(limit - total[row + 1], 0), left[row + 1], closes[row + 1] + 1, np.zeros(len(row), np.int64)]
    )
    if total[-1] < limit:  # the lowest states are not closed
        pieces = np.concatenate([[[0], [total[-1]], [0], [1]], pieces], axis=1)
    return _joined(pieces, limit)


def _size_then(first: np.ndarray, second: np.ndarray, limit: int) -> np.ndarray:
    """The table of two chunks, one after the other."""
    start, end, closes, slope = first
    last = end + slope * (np.diff(start, append=limit) - 1)
    low = np.searchsorted(second[0], end, side="right") - 1
    parts = np.searchsorted(second[0], last, side="right") - low
    of = np.repeat(np.arange(len(start)), parts)
    piece = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    state = np.maximum(end[of], second[0][piece])
    ends = second[1][piece] + second[3][piece] * (state - second[0][piece])
    return _joined(
        np.stack([start[of] + state - end[of], ends, closes[of] + second[2][piece], slope[of] * second[3][piece]]),
        limit,
    )


def _size_step(state: int, pieces: np.ndarray) -> tuple[int, int]:
    """The state a chunk leads to, and the batches it closes."""
    at = int(np.searchsorted(pieces[0], state, side="right")) - 1
    start, end, closes, slope = pieces[:, at].tolist()
    return end + slope * (state - start), closes


def _packed(pieces: np.ndarray) -> bytes:
    return np.ascontiguousarray(pieces, "<i8").tobytes()


def _unpacked(table: bytes) -> np.ndarray:
    return np.frombuffer(table, "<i8").reshape(4, -1)


def _replay_sizes(sizes: np.ndarray, limit: int, entry: int, closes: int) -> np.ndarray:
    numbers, total = np.empty(len(sizes), np.int64), np.cumsum(sizes)
    i, before = 0, -entry
    while i < len(sizes):  # from batch to batch
        end = int(np.searchsorted(total, before + limit, side="left")) + 1
        numbers[i:end] = closes
        closes += 1
        i, before = end, total[min(end, len(sizes)) - 1]
    return numbers


def batch_numbers(
    df: DataFrame, keys: list[str], seq: str, size: str, limit: int, *,
    name: str = "batch", chunk_bits: int = CHUNK_BITS, group_bits: int = SIZE_GROUP_BITS,
) -> DataFrame:
    """Number of the batch each row falls into when batches close at ``limit``.

    Rows of a key are taken by ``seq`` (a unique integer); the row that makes the
    collected ``size`` reach ``limit`` is the last of its batch. Adds the number.
    Sizes are not negative.

    Tables of ``2 ** group_bits`` neighbours are chained into one until a key has a
    single group, so a task holds that many tables of at most ``limit`` pieces of
    32 bytes, and of no more pieces than their rows; of small chunks, the tables of a block.
    """
    types, columns = dict(df.dtypes), df.columns
    key_ddl = ", ".join(f"`{k}` {types[k]}" for k in keys)
    placed = df.withColumn("_chunk", F.shiftright(F.col(seq).cast("bigint"), chunk_bits))
    placed = placed.select("*", _block_of("_chunk", chunk_bits))
    rows = placed.select(
        *keys, "_chunk", "_block", F.col(seq).alias("_seq"), F.col(size).cast("bigint").alias("_size")
    )

    def tabulate(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_seq")
        chunks, sizes = _runs(frame["_chunk"].to_numpy()), frame["_size"].to_numpy()
        tables = [_packed(_size_table(sizes[chunk], limit)) for chunk in chunks]
        return frame[[*keys, "_chunk"]].iloc[[chunk.start for chunk in chunks]].assign(_table=tables)

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_chunk")
        groups, composed = _runs(frame["_group"].to_numpy()), []
        for group in groups:
            first, *others = frame["_table"].iloc[group]
            whole = _unpacked(first)
            for table in others:
                whole = _size_then(whole, _unpacked(table), limit)
            composed.append(_packed(whole))
        return frame[[*keys, "_group"]].iloc[[group.start for group in groups]].assign(_table=composed)

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_chunk")
        entries, before = [], []
        for group in _runs(frame["_group"].to_numpy()):
            state, closes = int(frame["_entry"].iloc[group.start]), int(frame["_before"].iloc[group.start])
            for table in frame["_table"].iloc[group]:
                entries.append(state)
                before.append(closes)
                state, more = _size_step(state, _unpacked(table))
                closes += more
        return frame[[*keys, "_chunk"]].assign(_entry=entries, _before=before)

    table_ddl = f"{key_ddl}, _chunk bigint, _table binary"
    entry_ddl = f"{key_ddl}, _chunk bigint, _entry bigint, _before bigint"

    def grouped(tables: DataFrame, level: int) -> DataFrame:
        tables = tables.withColumn("_group", F.shiftright("_chunk", group_bits))
        return tables.select("*", _block_of("_group", chunk_bits + (level + 1) * group_bits))

    # Stored, as they are chained upwards and entered again on the way down.
    levels = [materialize(rows.groupBy(*keys, "_block").applyInPandas(tabulate, table_ddl), "size-tables")]
    ends = levels[0].agg(F.min("_chunk").alias("low"), F.max("_chunk").alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    while low >> group_bits != high >> group_bits:
        composed = (
            grouped(levels[-1], len(levels) - 1).groupBy(*keys, "_block")
            .applyInPandas(compose, f"{key_ddl}, _group bigint, _table binary")
        )
        levels.append(materialize(composed.withColumnRenamed("_group", "_chunk"), "size-tables"))
        low, high = low >> group_bits, high >> group_bits
        if (low, high) == (-1, 0):  # numbers on both sides of zero never meet
            break

    zero = F.lit(0).cast("bigint")
    top = levels.pop().withColumns({"_group": zero, "_entry": zero, "_before": zero})
    entries = top.groupBy(*keys).applyInPandas(chain, entry_ddl)
    for level in reversed(range(len(levels))):
        entered = grouped(levels[level], level).join(
            entries.withColumnRenamed("_chunk", "_group"), [*keys, "_group"]
        )
        entries = entered.groupBy(*keys, "_block").applyInPandas(chain, entry_ddl)

    def replay(frame: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        frame, entered = frame.sort_values(seq), entered.sort_values("_chunk")
        chunks, sizes = _runs(frame["_chunk"].to_numpy()), frame[size].to_numpy()
        entry = zip(chunks, entered["_entry"].tolist(), entered["_before"].tolist(), strict=True)
        numbers = [_replay_sizes(sizes[chunk], limit, state, closes) for chunk, state, closes in entry]
        return frame[columns].assign(**{name: np.concatenate(numbers)})

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    entries = entries.select("*", _block_of("_chunk", chunk_bits))
    return (
        placed.groupBy(*keys, "_block").cogroup(entries.groupBy(*keys, "_block")).applyInPandas(replay, schema)
    )


# -- last safe timestamp -----------------------------------------------------
# State: timestamp of the last safe poll, or NONE. A poll is safe when the state
# is at most its ``_allow``; it then sets the state to its ``_next``. A table is a
# step function: states up to ``_upto[i]`` end as ``_exit[i]``, higher ones stay.

NONE = np.iinfo(np.int64).min


def _safety_table(allow: np.ndarray, following: np.ndarray) -> tuple[list[int], list[int]]:
    final, allows = following.tolist(), allow.tolist()
    ahead: list[int] = []  # later polls by rising ``allow``, nearest on top
    falling: list[int] = []  # their ``allow``, negated: ascending, so it can be bisected
    for i in range(len(allows) - 1, -1, -1):
        nearest = bisect_right(falling, -final[i]) - 1
        if nearest >= 0:
            final[i] = final[ahead[nearest]]
        if allows[i] != NONE:
            while falling and falling[-1] >= -allows[i]:
                ahead.pop()
                falling.pop()
            ahead.append(i)
            falling.append(-allows[i])
    upto: list[int] = []
    leads_to: list[int] = []
    for limit, end in zip(allows, final):
        if limit == NONE or (upto and limit <= upto[-1]):
            continue  # an earlier poll takes every state this one would
        if upto and leads_to[-1] == end:
            upto[-1] = limit
        else:
            upto.append(limit)
            leads_to.append(end)
    return upto, leads_to


def _step(state: int, upto, leads_to) -> int:
    i = int(np.searchsorted(np.asarray(upto, np.int64), state, side="left"))
    return int(leads_to[i]) if i < len(upto) else state


def safe_polls(
    polls: DataFrame, keys: list[str], seq: str, *,
    chunk_bits: int = CHUNK_BITS, group_bits: int = GROUP_BITS,
) -> DataFrame:
    """Which polls are safe; ``polls`` has the keys, ``seq``, ``allow`` and ``next``.

    ``allow`` is NULL for a poll that is unsafe whatever the state, ``next`` NULL
    for one without a timestamp. Returns the keys, ``seq`` and ``safe``.
    """
    types = dict(polls.dtypes)
    key_ddl = ", ".join(f"`{k}` {types[k]}" for k in keys)
    rows = polls.select(
        *keys,
        F.col(seq).cast("bigint").alias("_seq"),
        F.coalesce(F.col("allow"), F.lit(int(NONE))).alias("_allow"),
        F.coalesce(F.col("next"), F.lit(int(NONE))).alias("_next"),
        F.shiftright(F.col(seq).cast("bigint"), chunk_bits).alias("_chunk"),
    )
    rows = rows.select("*", _block_of("_chunk", chunk_bits))

    def tabulate(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_seq")
        chunks, allow, following = _runs(frame["_chunk"].to_numpy()), frame["_allow"].to_numpy(), frame["_next"].to_numpy()
        upto, leads_to = zip(*(_safety_table(allow[chunk], following[chunk]) for chunk in chunks))
        return frame[[*keys, "_chunk"]].iloc[[chunk.start for chunk in chunks]].assign(_upto=upto, _exit=leads_to)

    tables = (
        rows.groupBy(*keys, "_block")
        .applyInPandas(tabulate, f"{key_ddl}, _chunk bigint, _upto array<bigint>, _exit array<bigint>")
        .withColumn("_group", F.shiftright("_chunk", group_bits))
    )
    tables = tables.select("*", _block_of("_group", chunk_bits + group_bits))

    tables = materialize(tables, "poll-tables")  # chained and joined below

    def composed(chunks: list[tuple]) -> tuple[list[int], list[int]]:
        # The composed function can only change at a limit of one of the chunks.
        limits = sorted({int(u) for upto, _ in chunks for u in upto})
        upto: list[int] = []
        leads_to: list[int] = []
        for limit in limits:
            state = limit
            for table in chunks:
                state = _step(state, *table)
            if upto and leads_to[-1] == state:
                upto[-1] = limit
            else:
                upto.append(limit)
                leads_to.append(state)
        return upto, leads_to

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_chunk")
        groups = _runs(frame["_group"].to_numpy())
        chunks = list(zip(frame["_upto"], frame["_exit"]))
        upto, leads_to = zip(*(composed(chunks[group]) for group in groups))
        return frame[[*keys, "_group"]].iloc[[group.start for group in groups]].assign(_upto=upto, _exit=leads_to)

    def entries_of(frame: pd.DataFrame, state: int) -> list[int]:
        entries = []
        for upto, leads_to in zip(frame["_upto"], frame["_exit"]):
            entries.append(state)
            state = _step(state, upto, leads_to)
        return entries

    def chain_groups(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_group")
        return frame[[*keys, "_group"]].assign(_entry=entries_of(frame, int(NONE)))

    def chain_chunks(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_chunk")
        entries: list[int] = []
        for group in _runs(frame["_group"].to_numpy()):
            entries += entries_of(frame.iloc[group], int(frame["_entry"].iloc[group.start]))
        return frame[[*keys, "_chunk"]].assign(_entry=entries)

    group_entries = (
        tables.groupBy(*keys, "_block")
        .applyInPandas(compose, f"{key_ddl}, _group bigint, _upto array<bigint>, _exit array<bigint>")
        .groupBy(*keys)
        .applyInPandas(chain_groups, f"{key_ddl}, _group bigint, _entry bigint")
    )
    entries = (
        tables.join(group_entries, [*keys, "_group"])
        .groupBy(*keys, "_block")
        .applyInPandas(chain_chunks, f"{key_ddl}, _chunk bigint, _entry bigint")
        .select("*", _block_of("_chunk", chunk_bits))
    )

    def replay(frame: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        frame, entered = frame.sort_values("_seq"), entered.sort_values("_chunk")
        polls = list(zip(frame["_allow"].tolist(), frame["_next"].tolist()))
        safe = []
        for chunk, state in zip(_runs(frame["_chunk"].to_numpy()), entered["_entry"].tolist(), strict=True):
            for allow, following in polls[chunk]:
                ok = allow != NONE and state <= allow
                safe.append(ok)
                state = following if ok else state
        return frame[[*keys, "_seq"]].assign(_safe=safe)

    judged = (
        rows.groupBy(*keys, "_block").cogroup(entries.groupBy(*keys, "_block"))
        .applyInPandas(replay, f"{key_ddl}, _seq bigint, _safe boolean")
    )
    return judged.withColumnsRenamed({"_seq": seq, "_safe": "safe"})
