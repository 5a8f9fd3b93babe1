"""SimHash near-duplicates with pivot distance tables.

Fingerprints: XXH64 (seed 42) of every shingle of three words; a bit is 1 if it
is set in over half of them.

Reference fingerprints (pivots): zero, and ``PIVOTS`` for each of four blocks of
16 bits, with half of that block's bits set. The table of a fingerprint holds its
Hamming distances to all of them. A differing bit moves distances of its own
block only (relative to the distance from zero), so for two fingerprints that
differ in at most two bits, the relative distances of at least two blocks are
equal. Each of the six pairs of blocks therefore gives a key, the distances of
its pivots; fingerprints meet where such a key is equal. In a bucket, pairs with
a distance that differs by more than two in any column of the table are
discarded, the survivors are verified bit by bit, and one link to an earlier
member of its component is given per fingerprint, not all pairs.

Buckets above ``BUCKET`` fingerprints, which only huge groups of near copies
make, take an exact way of linear cost: two fingerprints differ in at most two
bits just when they share one of the 65 values at distance 0 or 1, so each is
linked to the least of those it shares such a value with. At most 65 share one.

Equal fingerprints are one row in all of this, however many documents have them.

Defined results: a null or empty text has fingerprint zero and links like any
other; documents with null ids are grouped but never name a component unless
they are alone in it; repeated rows are linked. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog import workspace
from streamlog.llm.components import components

SEED, WIDTH, DISTANCE = 42, 3, 2
BLOCKS, PIVOTS, BUCKET = 4, 14, 512
_CHUNK = 1 << 16


def _references() -> np.ndarray:
    """(blocks, pivots) fingerprints: half of the bits of one block each."""
    draw, out = np.random.default_rng(SEED), np.zeros((BLOCKS, PIVOTS), np.uint64)
    for block in range(BLOCKS):
        for k in range(PIVOTS):
            for bit in draw.permutation(16)[:8]:
                out[block, k] |= np.uint64(1) << np.uint64(16 * block + int(bit))
    return out


REFERENCES = _references()


def fingerprint(text: bytes) -> int:
    """The SimHash of one text; memory is bounded for any length."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], stops[:-1]))
    width = min(WIDTH, len(words))
    firsts, lasts = starts[:len(words) - width + 1].tolist(), (stops[width - 1:] - 1).tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(firsts), _CHUNK):
        spans = zip(firsts[at:at + _CHUNK], lasts[at:at + _CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = ones * 2 > len(firsts)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)``; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t")).mapInArrow(
        sketch, f"`{id_col}` {kind}, fp long"
    )


def distance_table(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hamming distances to zero, shape (n, 1, 1), and to the references, shape (n, blocks, pivots)."""
    zero = np.bitwise_count(fps)[:, None, None]
    return zero, np.bitwise_count(fps[:, None, None] ^ REFERENCES)


def keys(fps: np.ndarray) -> np.ndarray:
    """(n, 6): for each pair of blocks, their pivot distances relative to zero as one key."""
    zero, table = distance_table(fps)
    relative = (table.astype(np.int64) - zero + 8).astype(np.uint64)  # 0..16
    powers = np.uint64(17) ** np.arange(PIVOTS, dtype=np.uint64)
    block = (relative * powers).sum(2, dtype=np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    out = [((block[:, a] * mix) ^ (block[:, b] + np.uint64(k + 1)) * mix ** np.uint64(3)) * mix for k, (a, b) in enumerate(combinations(range(BLOCKS), 2))]
    return np.stack(out, 1)


def bucket_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what is within ``DISTANCE`` in one bucket, at most one for each fingerprint."""
    zero, table = distance_table(fps)
    table = np.concatenate((table.reshape(len(fps), -1), zero[:, :, 0]), 1).astype(np.int16)
    root, out = np.arange(len(fps)), []
    for i in range(1, len(fps)):
        near = np.flatnonzero((np.abs(table[:i] - table[i]) <= DISTANCE).all(1))
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= DISTANCE]
        for other in np.unique(root[near], return_index=True)[1] if len(near) else ():
            j = near[other]
            if root[j] != root[i]:
                out.append((int(fps[i].view(np.int64)), int(fps[j].view(np.int64))))
                root[root == root[i]] = root[j]
    return out


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: enough links between distinct fingerprints to join each component."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for k, column in enumerate(keys(fps.view(np.uint64)).T):
                yield pa.record_batch([pa.array(np.full(len(fps), k, np.int32)), pa.array(column.view(np.int64)), pa.array(fps)], ["pair", "key", "fp"])

    rows = workspace.materialize(distinct.select("fp").mapInArrow(keyed, "pair int, key long, fp long"), "pivot-keys")
    filled = workspace.measured(rows.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pivot-buckets")
    members = rows.join(filled, ["pair", "key"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for own in batch.column(0) for x in bucket_links(own.values.to_numpy().view(np.uint64))]
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    bounded = members.where(F.col("n") <= bucket).groupBy("pair", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    near = bounded.select("fps").mapInArrow(within, "a long, b long")
    large = members.where(F.col("n") > bucket).select("fp").distinct()
    around = F.array(F.lit(0).cast("long"), *[F.lit(x).cast("long") for x in (np.uint64(1) << np.arange(64, dtype=np.uint64)).view(np.int64).tolist()])
    flips = large.select("fp", F.explode(F.transform(around, lambda x: x.bitwiseXOR(F.col("fp")))).alias("value"))
    shared = flips.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # 65 at most
    far = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b")
    return near.unionByName(far).distinct()


def _rooted(rows: DataFrame, bucket: int, *least: Column) -> DataFrame:
    """``(fp, root, least...)`` of the different fingerprints of rows ``(id, fp)``."""
    distinct = workspace.materialize(rows.groupBy("fp").agg(*least), "distinct-fingerprints")
    roots = components(links(distinct, bucket))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    return workspace.measured(named.select(*distinct.columns, F.coalesce("root", "fp").alias("root")), "roots")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``(id, fp, component_id)`` of every document."""
    rows = workspace.materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    rooted = _rooted(rows, bucket, F.min(id_col).alias("least"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = workspace.measured(rooted.join(names, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One document of each component: that with the smallest id (null last), then fingerprint, then hash of the text.

    Rows that are equal in id and text are not told apart; exact deduplication comes first. The same
    plan at every size: what stays is found on narrow rows, then whole documents pass one exchange,
    by id and hash of the text.
    """
    hash_ = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    marked = docs.select("doc_id", "text").withColumn("_key", F.struct("doc_id", hash_.alias("h")))
    rows = workspace.materialize(
        fingerprints(marked, "_key").select(F.col("_key.doc_id").alias("id"), F.col("_key.h").alias("h"), "fp"), "fingerprints"
    )
    order = F.min(F.struct(F.col("id").isNull(), "id", "fp", "h")).alias("least")
    stays = _rooted(rows, bucket, order).groupBy("root").agg(F.min("least").alias("least"))
    stays = workspace.materialize(stays.select(F.col("least.id").alias("_id"), F.col("least.h").alias("_stays")), "stays")
    hit = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_stays"))
    return docs.withColumn("_h", hash_).join(stays.hint("merge"), hit, "left_semi").select(*docs.columns)
