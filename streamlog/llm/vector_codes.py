"""Vector codes by product quantisation; codebooks are trained with norm-of-sum bounds.

A vector is cut into parts, and each part position has a codebook whose entries are
moved by rounds of assigning and averaging, all in integers. A full search is made
once. After it each row keeps, for every part and group of ``GROUP`` entries, a lower
bound on the distance to the group's entries (but for the assigned one) and the round
in which the bound was taken. The driver keeps the codebooks of all rounds. In a later
round a bound shrinks by the largest true displacement of the group's entries between
its own round and now, the norm of the sum of their moves, which is never more than
the sum of the norms. Only groups whose shrunken bound does not exceed the exact
distance to the assigned entry are scanned again; they get a new bound and stamp.

Work is spread by rows. A round writes the rows with their bounds once, reads them for
the sums (one row per entry from each task), and drops the table of the round before.
Codebooks (parts x entries x width integers) are all that the driver holds.

Defined results: rows with unusable vectors (see ``vectors.integers``) do not appear; the
dimension must be a multiple of the number of parts, else it is an error. The first codebook
takes the vectors with the smallest ids, nulls last; rows with the same id by their
components. Fewer vectors than entries give a smaller codebook; an empty table gives no
rows. Repeated rows count as often as they stand. Only id, vector and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import workspace
from streamlog.llm import vectors

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Consecutive entries that share a bound.
GROUP = 8
_FAR = np.int64(1) << 62


def _rounded_down(bounds: np.ndarray) -> np.ndarray:
    """Floats as the upper halves of their 32 bits; a smaller bound is a bound as well."""
    return ((bounds * (1 - 1e-6)).astype(np.float32).view(np.uint32) >> 16).astype(np.uint16)


def _bound(halves: np.ndarray) -> np.ndarray:
    return (halves.astype(np.uint32) << 16).view(np.float32).astype(np.float64)


def _squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries, as int64. Smaller floats are used where they are exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    bound = 4 * x.shape[1] * most * most
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    a, b = x.astype(kind), book.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)


class Search:
    """Assigns parts of rows to the codebook of the newest round."""

    def __init__(self, history: list[np.ndarray]):
        self.history = history  # of each round (parts, entries, width)
        self.parts, self.entries, self.width = history[0].shape
        self.groups = -(-self.entries // GROUP)
        now = history[-1]
        #: by round and part: the largest displacement of a group's entries since that round, rounded up
        self.moved = np.zeros((len(history), self.parts, self.groups))
        for t, then in enumerate(history):
            far = np.sqrt(((now - then) ** 2).sum(2).astype(np.float64)) * (1 + 1e-12)
            padded = np.zeros((self.parts, self.groups * GROUP))
            padded[:, :self.entries] = far
            self.moved[t] = padded.reshape(self.parts, self.groups, GROUP).max(2)
        self.scanned = 0  # distances that were taken, but for those to assigned entries

    def _bounds(self, d: np.ndarray, code: np.ndarray) -> np.ndarray:
        """``d`` (rows, groups, GROUP) to a bound below the distances of each group without the assigned entry."""
        d[np.arange(len(d)), code // GROUP, code % GROUP] = _FAR
        return _rounded_down(np.sqrt(d.min(2).astype(np.float64)))

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, bounds and stamps by a full search. ``x`` is (rows, parts, width)."""
        n = len(x)
        code, low = np.empty((n, self.parts), np.uint8), np.empty((n, self.parts, self.groups), np.uint16)
        for p in range(self.parts):
            d = np.full((n, self.groups * GROUP), _FAR)
            d[:, :self.entries] = _squared(x[:, p], self.history[-1][p])
            code[:, p] = d.argmin(1)
            low[:, p] = self._bounds(d.reshape(n, self.groups, GROUP), code[:, p].astype(np.int64))
        self.scanned += n * self.parts * self.entries
        return code, low, np.full((n, self.parts, self.groups), len(self.history) - 1, np.uint8)

    def again(self, x: np.ndarray, code: np.ndarray, low: np.ndarray, stamp: np.ndarray) -> np.ndarray:
        """Bring codes, bounds and stamps up to the newest codebook, in place. Returns the squared distances."""
        error = np.empty((len(x), self.parts), np.int64)
        for p in range(self.parts):
            book, own = self.history[-1][p], code[:, p].astype(np.int64)
            d = ((x[:, p] - book[own]) ** 2).sum(1)
            reach = np.sqrt(d.astype(np.float64)) * (1 + 1e-12)
            fails = _bound(low[:, p]) - self.moved[stamp[:, p], p, np.arange(self.groups)] <= reach[:, None]
            rows = np.flatnonzero(fails.any(1))
            if len(rows):
                fails[rows, own[rows] // GROUP] = True  # the assigned entry may become one of the others
                at, group = np.nonzero(fails[rows])
                padded = np.zeros((self.groups * GROUP, self.width), np.int64)
                padded[:self.entries] = book
                near = ((x[rows, p][at][:, None] - padded.reshape(self.groups, GROUP, self.width)[group]) ** 2).sum(2)
                near[group[:, None] * GROUP + np.arange(GROUP) >= self.entries] = _FAR
                found = np.full((len(rows), self.groups, GROUP), _FAR)
                found[at, group] = near
                self.scanned += len(at) * GROUP
                flat = found.reshape(len(rows), -1)
                best = flat.argmin(1)  # equal distances: the lowest index; entries left out are farther than the old one
                d[rows], code[rows, p] = flat[np.arange(len(rows)), best], best
                fresh = self._bounds(found, best)
                low[rows[at], p, group] = fresh[at, group]
                stamp[rows[at], p, group] = len(self.history) - 1
            error[:, p] = d
        return error


def _unpack(batch: pa.RecordBatch, parts: int, width: int, groups: int):
    n = batch.num_rows
    x = vectors.matrix(batch.column("q"), parts * width).reshape(n, parts, width)
    raw = [b"".join(batch.column(c).to_pylist()) for c in ("code", "low", "stamp")]
    code = np.frombuffer(raw[0], np.uint8).reshape(n, parts).copy()
    low = np.frombuffer(raw[1], "<u2").reshape(n, parts, groups).copy()
    return x, code, low, np.frombuffer(raw[2], np.uint8).reshape(n, parts, groups).copy()


def _packed(a: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(a)], pa.binary())


_STATE = ["code", "low", "stamp"]


def _assign(rows: DataFrame, history: list[np.ndarray], first: bool) -> DataFrame:
    """Rows with codes, bounds and stamps of the newest codebook."""
    parts, _, width = history[0].shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(history)
        for batch in batches:
            if first:
                x = vectors.matrix(batch.column("q"), parts * width).reshape(-1, parts, width)
                code, low, stamp = search.first(x)
            else:
                x, code, low, stamp = _unpack(batch, parts, width, search.groups)
                search.again(x, code, low, stamp)
            kept = [batch.column(c) for c in ("id", "label", "q")]
            yield pa.record_batch([*kept, _packed(code), _packed(low.astype("<u2")), _packed(stamp)], ["id", "label", "q", *_STATE])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "label", "q"))
    return rows.mapInArrow(step, f"{kinds}, code binary, low binary, stamp binary")


def _averages(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebook: entries at the floor of the mean of their parts; an unused entry stays."""
    parts, entries, width = book.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            x = vectors.matrix(batch.column("q"), parts * width).reshape(-1, parts, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
            at = (code + np.arange(parts) * entries).ravel()
            count += np.bincount(at, minlength=len(count))
            np.add.at(total, at, x.reshape(-1, width))
        used = np.flatnonzero(count)
        yield pa.record_batch(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            ["entry", "n", "total"],
        )

    found = state.select("q", "code").mapInArrow(sums, "entry int, n long, total array<long>")
    total = found.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(width)])
    new = book.reshape(-1, width).copy()
    for row in total.toLocalIterator():
        new[row["entry"]] = [row[f"t{k}"] // row["n"] for k in range(width)]
    return new.reshape(book.shape)


def _store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = workspace.new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _empty(spark: SparkSession, rows: DataFrame) -> DataFrame:
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    return spark.createDataFrame([], f"id {kinds['id']}, label {kinds['label']}, code binary, error long")


def encode(
    docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` of usable rows, a byte of ``code`` per part, and the final codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: up to 256 entries")
    spark = docs.sparkSession
    rows, dim, _ = vectors.integers(docs, vector_col, {"id": F.col(f"`{id_col}`"), "label": F.col(f"`{label_col}`")})
    if dim == 0:
        return _empty(spark, rows), np.zeros((parts, 0, 0), np.int64)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    width = dim // parts
    seeds = rows.select("id", "q").orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).collect()
    history = [np.array([r["q"] for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)]
    state, path = _store(_assign(rows, history, first=True), "codes")
    for done in range(rounds):
        history.append(_averages(state, history[-1]))
        if done < rounds - 1:
            old, (state, path) = path, _store(_assign(state, history, first=False), "codes")
            workspace.delete(spark, old)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(history)
        for batch in batches:
            x, code, low, stamp = _unpack(batch, parts, width, search.groups)
            error = search.again(x, code, low, stamp).sum(1)
            yield pa.record_batch([batch.column("id"), batch.column("label"), _packed(code), pa.array(error)], ["id", "label", "code", "error"])

    coded, _ = _store(state.mapInArrow(last, _empty(spark, rows).schema), "coded")
    workspace.delete(spark, path)
    return coded, history[-1]


def books_sha256(books: np.ndarray) -> str:
    """Of all components by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over the rows of the same label; nulls are one label."""
    by_label = workspace.measured(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "labels")
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["_label"]), "left").drop("_label")
