"""Chunked folds against a sequential one."""

import datetime
import random
import time

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from streamlog.operators import folds
from streamlog.streaming.collect import Collected


class State:
    """Stands for a group state."""

    exists = False

    def update(self, value):
        self.exists, self.get = True, value


def sequential_batches(sizes, limit):
    numbers, held, batch = [], 0, 0
    for size in sizes:
        numbers.append(batch)
        held += size
        if held >= limit:
            held, batch = 0, batch + 1
    return numbers, held, batch


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=40), st.integers(1, 10), st.data())
def test_size_table_is_the_fold(sizes, limit, data):
    entry = data.draw(st.integers(0, limit - 1))
    cut = data.draw(st.integers(0, len(sizes)))
    whole = folds._size_table(np.array(sizes, np.int64), limit)
    halves = [folds._size_table(np.array(part, np.int64), limit) for part in (sizes[:cut], sizes[cut:])]
    held, n = entry, 0
    for size in sizes:
        held += size
        if held >= limit:
            held, n = 0, n + 1
    chained = folds._size_then(*halves, limit)
    for table in (whole, chained):
        assert folds._size_step(entry, table) == (held, n)
        assert table.shape[1] <= min(limit, len(sizes) + 1)


def test_many_chunks_with_a_large_limit_stay_small():
    """A thousand chunks of sizes of one, and of mixed sizes, against a limit of a million."""
    limit, rng = 10**6, np.random.default_rng(5)
    ones = folds._size_table(np.ones(1 << 17, np.int64), limit)
    assert ones.shape[1] <= 3
    whole = ones
    for _ in range(1023):
        whole = folds._size_then(whole, ones, limit)
    assert whole.shape[1] <= 3
    assert folds._size_step(17, whole) == ((17 + (1 << 27)) % limit, (17 + (1 << 27)) // limit)
    mixed = [rng.integers(1, 9, 1 << 13) for _ in range(32)]
    whole = folds._size_table(mixed[0], limit)
    for sizes in mixed[1:]:
        whole = folds._size_then(whole, folds._size_table(sizes, limit), limit)
    numbers, held, closes = sequential_batches(np.concatenate(mixed).tolist(), limit)
    assert folds._size_step(0, whole) == (held, closes)
    assert whole.shape[1] <= (32 << 13) + 1


def sequential_safe(allow, following):
    state, safe = folds.NONE, []
    for a, f in zip(allow, following):
        ok = a is not None and state <= a
        safe.append(ok)
        if ok:
            state = folds.NONE if f is None else f
    return safe


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 30)), st.one_of(st.none(), st.integers(0, 30))), max_size=25),
    st.one_of(st.just(int(folds.NONE)), st.integers(-5, 40)),
)
def test_safety_table_is_the_fold(polls, entry):
    allow = [folds.NONE if a is None else a for a, _ in polls]
    following = [folds.NONE if f is None else f for _, f in polls]
    table = folds._safety_table(np.array(allow, np.int64), np.array(following, np.int64))
    state = entry
    for a, f in zip(allow, following):
        if a != folds.NONE and state <= a:
            state = f
    assert folds._step(entry, *table) == state


def test_batch_numbers_over_chunks(spark):
    rng = random.Random(3)
    rows = [
        (key, seq, rng.randrange(1, 9), f"{key}{seq}")
        for key, n in (("hot", 400), ("cold", 30))
        for seq in rng.sample(range(1000), n)
    ]
    df = spark.createDataFrame(rows, "k string, seq bigint, size bigint, payload string")
    got = folds.batch_numbers(df, ["k"], "seq", "size", 25, chunk_bits=4, group_bits=2).collect()
    for key in ("hot", "cold"):
        mine = sorted((seq, size) for k, seq, size, _ in rows if k == key)
        expected, _, _ = sequential_batches([size for _, size in mine], 25)
        found = sorted((r.seq, r.batch, r.payload) for r in got if r.k == key)
        assert [b for _, b, _ in found] == expected
        assert all(p == f"{key}{s}" for s, _, p in found)


def test_safe_polls_over_chunks(spark):
    rng = random.Random(4)
    rows = []
    for key, n in (("hot", 400), ("cold", 25)):
        for seq in range(n):
            allow = None if rng.random() < 0.1 else seq + rng.randrange(-40, 20)
            rows.append((key, seq, allow, None if rng.random() < 0.05 else seq + rng.randrange(-10, 10)))
    df = spark.createDataFrame(rows, "k string, seq bigint, allow bigint, next bigint")
    got = folds.safe_polls(df, ["k"], "seq", chunk_bits=4, group_bits=3).collect()
    for key in ("hot", "cold"):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        expected = sequential_safe([r[2] for r in mine], [r[3] for r in mine])
        assert [r.safe for r in sorted((r for r in got if r.k == key), key=lambda r: r.seq)] == expected


def seconds(df):
    began = time.perf_counter()
    return df.collect(), time.perf_counter() - began


def test_small_chunks_of_sizes_share_a_call(spark):
    """Ten thousand chunks are not as many calls of Python; numbers on both sides of zero."""
    rng = random.Random(6)
    rows = [(seq % 2, seq, rng.randrange(0, 9)) for seq in range(-20_000, 20_000)]
    df = spark.createDataFrame(rows, "k int, seq bigint, size bigint").repartition(4).cache()
    whole, alone = seconds(folds.batch_numbers(df, ["k"], "seq", "size", 25))
    got, small = seconds(folds.batch_numbers(df, ["k"], "seq", "size", 25, chunk_bits=3))
    assert sorted(got) == sorted(whole)
    for key in (0, 1):
        expected, _, _ = sequential_batches([size for k, _, size in rows if k == key], 25)
        assert [r.batch for r in sorted(got, key=lambda r: r.seq) if r.k == key] == expected
    assert small < 4 * alone + 10


def test_small_chunks_of_polls_share_a_call(spark):
    rng = random.Random(7)
    rows = [
        (seq % 2, seq, None if rng.random() < 0.1 else seq + rng.randrange(-40, 20), seq + rng.randrange(-10, 10))
        for seq in range(-15_000, 15_000)
    ]
    df = spark.createDataFrame(rows, "k int, seq bigint, allow bigint, next bigint").repartition(4).cache()
    whole, alone = seconds(folds.safe_polls(df, ["k"], "seq"))
    got, small = seconds(folds.safe_polls(df, ["k"], "seq", chunk_bits=3, group_bits=2))
    assert sorted(got) == sorted(whole)
    for key in (0, 1):
        expected = sequential_safe([r[2] for r in rows if r[0] == key], [r[3] for r in rows if r[0] == key])
        assert [r.safe for r in sorted(got, key=lambda r: r.seq) if r.k == key] == expected
    assert small < 4 * alone + 10


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(0, 40), min_size=1, max_size=40), st.integers(1, 6), st.integers(1, 30),
    st.lists(st.integers(0, 40), max_size=3),
)
def test_collector_survives_restarts(steps, limit, interval, cuts):
    """The batches do not depend on where micro-batches end."""
    times = np.cumsum(steps).tolist()

    def run(restart_at):
        state, closed = State(), []
        bounds = sorted({0, len(times), *(c for c in restart_at if c < len(times))})
        for start, end in zip(bounds, bounds[1:]):
            collected = Collected(state)
            rows = pd.DataFrame({"i": range(start, end), "_clock": times[start:end], "_tick": False, "_size": 1})
            for _, batch in collected.close(rows, limit, interval).groupby("batch"):
                closed.append((batch["closed_by"].iloc[0], tuple(batch["i"])))
            collected.save(state)
        return closed

    whole = run(())
    assert run(cuts) == whole

    # A clock that ticks one unit at a time gives the same batches.
    held, started, plain, i = [], times[0], [], 0
    for now in range(times[0], times[-1] + 1):
        if now - started >= interval:
            if held:
                plain.append(("interval", tuple(held)))
                held = []
            started = now
        while i < len(times) and times[i] == now:
            held.append(i)
            i += 1
            if len(held) >= limit:
                plain.append(("size", tuple(held)))
                held, started = [], now
    assert whole == plain


def test_interval_is_in_microseconds():
    from streamlog.streaming.collect import _micros

    assert _micros(datetime.timedelta(milliseconds=2)) == 2000
    assert _micros(None) is None
