"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line; long ones are cut after words whose hash is a multiple of
four, so that an edit changes digests near it only. The k-th repeat of a digest
is a digest of its own. A sketch has three groups of cells; each digest is added
to one cell a group: a count, the xor of the digests and the xor of their checks.
The sketch of one version minus that of another holds just what differs. Peeling
recovers it: a cell with count 1 or -1 whose check fits is a digest, which is
then taken out of its other cells. Where cells are left over, the sketches of
this pair are made again with four times the cells, until all is recovered; a
sketch with 3 cells for each digest of both versions practically always is.

Likeness is the share of digests in common, |A and B| / |A or B|, and 1 for two
texts without words. Documents are compared with their successors by id: a
range-partitioned table, in which the first document of each range is copied to
the range before, so no task sees more than its range.

Defined results: a null text is empty; null ids come first; equal ids are ordered
by text; a single document is its own successor; an empty table has no rows.
Only id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog import workspace

#: Cells of the stored fingerprint, a multiple of 3; factor of a retry.
CELLS, LARGER = 12, 4
_END = b"\x1e"  # stands for a line end among the words
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_REMEMBERED = 1 << 19


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt * 0xD1342543DE82EF95 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def digests(texts: list[bytes], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(digests, number of them by text) for a list of texts."""
    words = [text.replace(b"\n", b" \x1e ").split() + [_END] for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter((known[w] for own in words for w in own), np.uint64, lengths.sum())
    end = hashes == np.uint64(xxhash.xxh64_intdigest(_END))
    cut = end | (hashes & np.uint64(3) == 0)
    start = np.flatnonzero(np.concatenate(([True], cut[:-1])))
    place = np.arange(len(hashes), dtype=np.int64) - np.repeat(start, np.diff(np.append(start, len(hashes))))
    power = np.multiply.accumulate(np.full(int(place.max()) + 1, _ODD))
    digest = _mix(np.add.reduceat(np.where(end, np.uint64(0), hashes * power[place]), start), 1)
    full = ~end[start]  # not an empty line
    owner = np.repeat(np.arange(len(texts)), lengths)[start][full]
    digest = digest[full]
    order = np.lexsort((digest, owner))
    d, o = digest[order], owner[order]
    first = np.concatenate(([True], (d[1:] != d[:-1]) | (o[1:] != o[:-1]))) if len(d) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    rank = np.arange(len(d)) - np.repeat(at, np.diff(np.append(at, len(d))))
    d = np.where(rank > 0, _mix(d + rank.astype(np.uint64), 2), d)
    return d, np.bincount(o, minlength=len(texts))


def _places(digest: np.ndarray, cells: int) -> list[np.ndarray]:
    third = np.uint64(cells // 3)
    return [(_mix(digest, 3 + k) % third).astype(np.int64) + k * (cells // 3) for k in range(3)]


def sketches(digest: np.ndarray, owner: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, digests, checks) of ``n`` sketches, each of shape (n * cells,)."""
    count, keys, checks = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    check = _mix(digest, 9)
    for place in _places(digest, cells):
        at = owner * cells + place
        np.add.at(count, at, 1)
        np.bitwise_xor.at(keys, at, digest)
        np.bitwise_xor.at(checks, at, check)
    return count, keys, checks


def spelled(sizes: np.ndarray, sketch: tuple[np.ndarray, ...], cells: int) -> list[str]:
    """Fingerprints as text: number of digests, then counts, digests and 32 bits of the checks of all cells."""
    n = len(sizes)
    count, keys, checks = (x.reshape(n, cells) for x in sketch)
    raw = np.concatenate([
        sizes.astype("<u4")[:, None].view(np.uint8), count.astype("<u4").view(np.uint8), keys.astype("<u8").view(np.uint8),
        checks.astype("<u4").view(np.uint8),
    ], axis=1)
    return [base64.b64encode(row.tobytes()).decode() for row in raw]


def peel(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of what differs, and which of the ``n`` pairs were recovered whole."""
    count, keys, checks = a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]
    pairs, found, signs = [], [], []
    active = np.flatnonzero(count | (keys != 0))
    while len(active):
        pure = active[np.abs(count[active]) == 1]
        pure = pure[checks[pure] == _mix(keys[pure], 9)]
        if not len(pure):
            break
        pair, digest, sign = pure // cells, keys[pure], count[pure]
        order = np.lexsort((digest, pair))
        pair, digest, sign = pair[order], digest[order], sign[order]
        once = np.concatenate(([True], (pair[1:] != pair[:-1]) | (digest[1:] != digest[:-1])))
        pair, digest, sign = pair[once], digest[once], sign[once]
        touched = []
        for place in _places(digest, cells):
            at = pair * cells + place
            np.subtract.at(count, at, sign)
            np.bitwise_xor.at(keys, at, digest)
            np.bitwise_xor.at(checks, at, _mix(digest, 9))
            touched.append(at)
        pairs.append(pair)
        found.append(digest)
        signs.append(sign)
        active = np.unique(np.concatenate(touched))
    left = (count != 0) | (keys != 0)
    whole = ~left.reshape(n, cells).any(1)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(pairs or [empty]), np.concatenate(found or [empty.view(np.uint64)]), np.concatenate(signs or [empty]), whole)


def _part(digest: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests of the chosen texts and their new owners."""
    stops = np.cumsum(sizes)
    lengths = sizes[chosen]
    shift = np.repeat(stops[chosen] - lengths - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return digest[np.arange(lengths.sum()) + shift], np.repeat(np.arange(len(chosen)), lengths)


def likeness(digest: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Share of digests that texts ``a[k]`` and ``b[k]`` have in common, from peeled differences."""
    out, open_ = np.ones(len(a)), np.arange(len(a))
    while len(open_):
        n = len(open_)
        one, two = (sketches(*_part(digest, sizes, x[open_]), n, cells) for x in (a, b))
        pair, _, _, whole = peel(one, two, n, cells)
        differing = np.bincount(pair, minlength=n)[whole]
        done = open_[whole]
        both = sizes[a[done]] + sizes[b[done]]
        out[done] = np.where(both + differing > 0, (both - differing) / np.maximum(both + differing, 1), 1.0)
        open_, cells = open_[~whole], cells * LARGER
    return out


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[:len(text) - n] + following[:n] if n else text


def with_next(docs: DataFrame, id_col: str, text_col: str, ranges: int) -> DataFrame:
    """``(part, after, doc_id, text)`` sorted so that each row is followed by its successor; ``after`` rows only follow."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    ids = rows.select("doc_id")
    firsts = (
        ids.where("doc_id is not null").repartitionByRange(ranges, "doc_id")
        .groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("first"))
        .orderBy("first").select("first").toPandas()["first"].tolist()  # one id for each range
    )
    nulls = not ids.where("doc_id is null").isEmpty()
    held = spark.sparkContext.broadcast(np.array(firsts))
    kind = docs.schema[id_col].dataType.simpleString()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = held.value
        for batch in batches:
            ids = batch.column(0)
            known = np.array(ids.is_valid())
            part = np.full(len(ids), -1, np.int64)
            if known.any():
                part[known] = np.searchsorted(bounds, np.array(ids.drop_null().to_pylist()), "right") - 1
            head = known.copy()
            if known.any():
                head[known] = bounds[part[known]] == np.array(ids.drop_null().to_pylist())
            if nulls:
                head |= ~known
            out = batch.append_column("part", pa.array(part)).append_column("after", pa.array(np.zeros(len(part), np.int32)))
            yield out
            # What comes after the range before; the very first documents come after the last range.
            before = part[head] - 1
            before[before < (-1 if nulls else 0)] = len(bounds) - 1
            if head.any():
                copied = batch.filter(pa.array(head))
                yield copied.append_column("part", pa.array(before)).append_column("after", pa.array(np.ones(len(before), np.int32)))

    moved = rows.mapInArrow(dealt, f"doc_id {kind}, text binary, part long, after int")
    placed = moved.repartitionById(ranges, F.pmod("part", F.lit(ranges)).cast("int"))  # hashing would put ranges together
    return placed.sortWithinPartitions("part", "after", F.col("doc_id").asc_nulls_first(), "text")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """One row per document: the id and ``SCHEMA``."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, names, size = _Words(), [], [], 0
        last: tuple | None = None
        for batch in batches:
            names = batch.column(0).type
            for row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                row = (row[0], row[1].as_py(), row[2], row[3])
                if last is not None and last[2] == row[2] and not last[3]:
                    held.append((last[0], last[1], row[1]))
                    size += len(last[1])
                    if size > 4 << 20 or len(held) >= 4096:
                        yield rated(held, known, names)
                        held, size = [], 0
                last = row
        if held:
            yield rated(held, known, names)

    def rated(held: list[tuple], known: dict, kind: pa.DataType) -> pa.RecordBatch:
        n = len(held)
        texts = [(own.decode("utf-8", "replace"), after.decode("utf-8", "replace")) for _, own, after in held]
        new = [edited(*x).encode() for x in texts]
        digest, sizes = digests([own for _, own, _ in held] + new + [after for *_, after in held], known)
        k = np.arange(n)
        cells = sketches(*_part(digest, sizes, np.arange(2 * n)), 2 * n, CELLS)
        prints = spelled(sizes[:2 * n], cells, CELLS)
        return pa.record_batch(
            [pa.array([x[0] for x in held], kind), pa.array([len(t) for t, _ in texts], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in new]), pa.array(prints[:n]), pa.array(prints[n:]),
             pa.array(likeness(digest, sizes, k, k + n)), pa.array(likeness(digest, sizes, k, k + 2 * n))],
            [id_col, *(x.split()[0] for x in SCHEMA.split(", "))],
        )

    return with_next(docs, id_col, text_col, ranges).mapInArrow(rate, f"`{id_col}` {kind}, {SCHEMA}")
