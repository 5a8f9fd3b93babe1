"""Hard negatives by exact integer scores from residue matrices.

Scores are inner products of integer vectors. They are computed as float32 matrix products
modulo a few small primes: with residues between -(p-1)/2 and (p-1)/2 every sum of a product
stays below 2^24, so each is exact in float32 (vectors with more components than that allows
are multiplied in stretches). As many primes are used as the largest possible score needs,
and the signed score comes back by Chinese remaindering.

Anchors are the stated queries and are set against all rows in blocks: a block of at most
``BLOCK`` anchor components is sent to all tasks, so what is broadcast does not grow with the
data. For each block two passes read the rows:
the first keeps every anchor's best rows of its label, the second keeps, for each of them,
the best rows of other labels within the score window. A task keeps a few rows per anchor,
whatever the number of rows, and tasks' lists are merged by a shuffle on the anchor.

Defined results: rows with a null label or an unusable vector (``vectors.integers``) take no
part. A row without an id takes part, is never an anchor, and comes last among ties; the
largest 64-bit integer stands for it inside and is no usable id. Other rows are rows with
another id than the anchor. Repeated rows count each, so a repeated anchor has its results
as often. An anchor without other rows of its label, or a positive without a row in its
window, has no result; an empty table gives no rows. Vectors whose scores may reach 2^52 are
an error. Only id, vector and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlog import workspace
from streamlog.llm import vectors
from streamlog.llm.housekeeping import dropping_shuffles

#: Primes below 2^10, descending; residues of 64 components add up exactly in float32.
PRIMES = [p for p in range(1021, 500, -2) if all(p % d for d in range(3, 32, 2))]
#: Components of the anchors in a block, and scores held at a time.
BLOCK, TILE = 1 << 21, 1 << 20
#: Rows of a table that are scored together.
ROWS = 1 << 11
NO_ID, LEAST = np.int64((1 << 63) - 1), np.int64(-(1 << 63))


class Residues:
    """Integer matrices modulo primes, and their products."""

    def __init__(self, dim: int, most: int):
        self.bound = dim * most * most
        if self.bound >= 1 << 52:
            raise ValueError("scores of these vectors may reach 2^52")
        self.primes, product = [], 1
        for p in PRIMES:
            if self.primes and product > 2 * self.bound:
                break
            self.primes.append(p)
            product *= p
        #: Components whose products of residues add up below 2^24.
        self.stretch = ((1 << 24) - 1) // (self.primes[0] // 2) ** 2

    def split(self, q: np.ndarray) -> list[np.ndarray]:
        out = []
        for p in self.primes:
            r = q % p
            out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
        return out

    def scores(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Exact inner products of the rows of two matrices, from their residues."""
        value, weight = None, 1
        for p, x, y in zip(self.primes, a, b, strict=True):
            r = np.zeros((len(x), len(y)), np.int64)
            for at in range(0, x.shape[1], self.stretch):
                r += (x[:, at:at + self.stretch] @ y[:, at:at + self.stretch].T).astype(np.int64)
            if value is None:
                value = r % p
            else:  # value + weight * digit has the residue r modulo p
                value += weight * ((r - value % p) * pow(weight, -1, p) % p)
            weight *= p
        return np.where(value > weight // 2, value - weight, value)


class Best:
    """The best ``k`` (score, id) of each slot: higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int, bound: int):
        self.score, self.id = np.full((slots, k), LEAST), np.full((slots, k), NO_ID)
        self.k, self.bound = k, bound

    def _top(self, score: np.ndarray) -> np.ndarray:
        n = score.shape[1]
        if (self.bound + 1) * n < 1 << 62:  # one number holds score and column
            key = np.where(score == LEAST, LEAST, score * n + np.arange(n)[::-1])
            return np.argpartition(key, n - self.k, axis=1)[:, n - self.k:]
        return np.argsort(~score, axis=1, kind="stable")[:, :self.k]

    def add(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score`` (slots, rows), LEAST where a row does not count; ``ids`` of the rows, ascending."""
        if score.shape[1] > self.k:
            top = self._top(score)
            score, own = np.take_along_axis(score, top, 1), ids[top]
        else:
            own = np.broadcast_to(ids, score.shape)
        score, own = np.concatenate((self.score[slots], score), 1), np.concatenate((self.id[slots], own), 1)
        order = np.lexsort((own, ~score))[:, :self.k]
        self.score[slots], self.id[slots] = np.take_along_axis(score, order, 1), np.take_along_axis(own, order, 1)

    def rows(self, kinds: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
        """What was found; ``kinds`` are columns of numbers by slot."""
        slot, place = np.nonzero(self.score != LEAST)
        ids, score = self.id[slot, place], self.score[slot, place]
        columns = [pa.array(v[slot]) for _, v in kinds]
        return pa.record_batch([*columns, pa.array(ids, mask=ids == NO_ID), pa.array(score)], [*(n for n, _ in kinds), "id", "score"])


def _tiles(batches: Iterator[pa.RecordBatch], dim: int, residues: Residues):
    """(labels, ids, residues) of up to ``ROWS`` rows, by ascending id."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            ids = batch.column("id").fill_null(int(NO_ID)).to_numpy()
            order = np.argsort(ids, kind="stable")
            q = vectors.matrix(batch.column("q"), dim)[order]
            yield batch.column("label").to_numpy()[order], ids[order], residues.split(q)


def _pick(parts: list[np.ndarray], at) -> list[np.ndarray]:
    return [p[at] for p in parts]


def _positives(rows: DataFrame, block, dim: int, residues: Residues, k: int) -> DataFrame:
    """``(anchor, id, score)``: the best rows of its label for each anchor of the block, of every task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, own, q = block.value["label"], block.value["id"], residues.split(block.value["q"].astype(np.int64))
        best = Best(len(label), k, residues.bound)
        by_label = np.argsort(label, kind="stable")
        sorted_labels = label[by_label]
        for labels, ids, r in _tiles(batches, dim, residues):
            for x in np.unique(labels):
                low, high = np.searchsorted(sorted_labels, [x, x + 1])
                if low == high:
                    continue
                these = np.flatnonzero(labels == x)
                at, some = ids[these], _pick(r, these)
                step = max(1, TILE // len(these))
                for start in range(low, high, step):
                    anchors = by_label[start:min(start + step, high)]
                    score = residues.scores(_pick(q, anchors), some)
                    score[own[anchors][:, None] == at] = LEAST
                    best.add(anchors, score, at)
        yield best.rows([("anchor", np.arange(len(label)))])

    found = rows.mapInArrow(search, "anchor long, id long, score long")
    return _merged(found, ["anchor"], k)


def _negatives(rows: DataFrame, block, windows, dim: int, residues: Residues, k: int) -> DataFrame:
    """``(anchor, slot, id, score)``: the best rows of other labels within each window of each anchor, of every task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, q = block.value["label"], residues.split(block.value["q"].astype(np.int64))
        low, high = windows.value  # (anchors, slots)
        n, slots = low.shape
        best = [Best(n, k, residues.bound) for _ in range(slots)]
        for labels, ids, r in _tiles(batches, dim, residues):
            step = max(1, TILE // len(ids))
            for start in range(0, n, step):
                anchors = np.arange(start, min(start + step, n))
                score = residues.scores(_pick(q, anchors), r)
                score[label[anchors][:, None] == labels] = LEAST
                for slot in range(slots):
                    # A row below the worst of a full list cannot enter it; an equal one may, by its id.
                    least = np.maximum(low[anchors, slot], best[slot].score[anchors, -1])
                    fits = (score >= least[:, None]) & (score <= high[anchors, slot][:, None])
                    some = np.flatnonzero(fits.any(1))
                    if len(some):
                        best[slot].add(anchors[some], np.where(fits[some], score[some], LEAST), ids)
        for slot in range(slots):
            yield best[slot].rows([("anchor", np.arange(n)), ("slot", np.full(n, slot))])

    found = rows.mapInArrow(search, "anchor long, slot long, id long, score long")
    return _merged(found, ["anchor", "slot"], k)


def _merged(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    docs: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label",
    positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95, block: int = BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the columns of ``docs``; ids are integers. A negative's score lies between
    ``lower`` and ``upper`` hundredths of the positive's, both included.
    """
    spark = docs.sparkSession
    label = F.col(f"`{label_col}`") if isinstance(label_col, str) else label_col
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    all_rows, dim, most = vectors.integers(
        docs, vector_col,
        {"id": F.col(f"`{id_col}`").cast("long"), "label": label.cast("long"), "anchor": F.coalesce(is_anchor, F.lit(False))},
    )
    all_rows = all_rows.where("label IS NOT NULL")
    rows = all_rows.select("id", "label", "q")
    chosen = all_rows.where("anchor AND id IS NOT NULL").select(F.monotonically_increasing_id().alias("n"), "id", "label", "q")
    anchors = workspace.materialize(chosen, "anchors")
    total = anchors.count()
    if not total:
        return spark.createDataFrame([], schema)
    residues = Residues(dim, most)
    blocks = -(-total * dim // block)  # dealt by a hash of row numbers, which no repeated id can fill
    out = workspace.new_dir(spark, "negatives")
    for b in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("n"), F.lit(blocks)) == b).orderBy("n").toArrow()
        if not part.num_rows:
            continue
        columns = part.combine_chunks()
        own = columns["id"].to_numpy()
        sent = spark.sparkContext.broadcast({
            "id": own, "label": columns["label"].to_numpy(),
            "q": vectors.matrix(columns["q"].combine_chunks(), dim).astype(np.int32),
        })
        with dropping_shuffles(spark):
            good = _positives(rows, sent, dim, residues, positives).toArrow()
            at, slot, score = good["anchor"].to_numpy(), good["rank"].to_numpy() - 1, good["score"].to_numpy()
            low, high = np.ones((len(own), positives), np.int64), np.zeros((len(own), positives), np.int64)
            low[at, slot], high[at, slot] = -(-lower * score // 100), upper * score // 100
            windows = spark.sparkContext.broadcast((low, high))
            pairs = workspace.local_table(spark, {
                "anchor": pa.array(at), "slot": pa.array(slot.astype(np.int64)), "anchor_id": pa.array(own[at]),
                "positive_id": good["id"].combine_chunks(), "positive_score": pa.array(score),
            })
            found = _negatives(rows, sent, windows, dim, residues, negatives)
            found.join(pairs, ["anchor", "slot"]).select(
                "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            ).write.mode("append").parquet(out)
        windows.unpersist()
        sent.unpersist()
    return spark.read.schema(schema).parquet(out)
