"""Best-fit packing by sum of squares.

Tokenising: words recur, so each task keeps the ids of words it has met; a word
of ASCII or Latin-1 letters goes through the tokenizer's own model, every other
one through its whole pipeline. Splitting at ASCII white space first is safe,
as the tokenizer drops white space and never joins across it. Only documents
longer than a sequence are cut.

Packing: let N(g) be the number of open sequences with g free places. A piece
goes where the sum of N(g)^2 becomes smallest; among equals to the tightest place.
Pieces are dealt to groups of about ``GROUP_PIECES`` at random (by a hash of a
row number, so no key is hot), longest first inside a group. What a group leaves
open is dealt again, a whole sequence as one piece and to other groups than
before, until one group holds all that is open or a round saves no sequence. A
task holds one group.

Defined results: a null or empty text is the single id 0; repeated rows are
pieces of their own; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import itertools
import re
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog import workspace

CAPACITY, END = 2048, 0
GROUP_PIECES = 1 << 16
#: Words that a task remembers; beyond that it starts anew.
REMEMBERED = 1 << 19
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall


class _Parts(dict):
    """Lower-cased parts of words to ids, as the tokenizer's model cuts them."""

    def __init__(self, whole, spelled: list[bytes]):
        self.tokenize, self.spelled = whole.model.tokenize, spelled
        self.byte_level = lru_cache(4096)(lambda c: whole.pre_tokenizer.pre_tokenize_str(c)[0][0])

    def __missing__(self, part: str) -> bytes:
        mapped = part if part.isascii() else "".join([c if c < "\x80" else self.byte_level(c) for c in part])
        spelled = self.spelled
        self[part] = out = b"".join([spelled[t.id] for t in self.tokenize(mapped)])
        return out


class Encoder(dict):
    """Word bytes to ids, as little-endian unsigned 32-bit integers.

    Keys and values are bytes, which Python's garbage collector need not visit.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.spelled = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        self.parts = _Parts(self.whole, self.spelled)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
            self.parts.clear()
        text = word.decode()
        if _PLAIN(text) and "<|" not in text:
            out = b"".join(map(self.parts.__getitem__, _PARTS(text.lower())))
        else:
            out = b"".join([self.spelled[i] for i in self.whole.encode(text, add_special_tokens=False).ids])
        self[word] = out
        return out

    def encode(self, text: bytes) -> bytes:
        # ASCII letters are lower-cased at once; not so where a special token's string, which keeps its case, may stand.
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids)``; ``ids`` are little-endian unsigned 32-bit integers."""
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path).encode
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, part))
                size += len(ids)
                if size > 16 << 20:
                    yield made(rows, batch.schema.field(0).type)
                    rows, size = [], 0
            if rows:
                yield made(rows, batch.schema.field(0).type)

    def made(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = (kind, pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            [id_col, "piece", "start", "length", "ids"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text")).mapInArrow(
        cut, f"`{id_col}` {kind}, piece int, start long, length long, ids binary"
    )


def fill(sizes: list[int], capacity: int = CAPACITY) -> list[int]:
    """The sequence of each size, in the order given."""
    open_count = np.zeros(capacity + 1, np.int64)  # N(g); full and untouched sequences are not open
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []  # gaps with an open sequence, ascending
    out, made = [], 0
    for size in sizes:
        fresh = capacity - size
        best, gap, new = 2 * int(open_count[fresh]) + 1 if fresh else 0, capacity, fresh
        at = int(np.searchsorted(gaps, size)) if gaps else 0
        if at < len(gaps) and fresh:
            around = np.array(gaps[at:])
            after = open_count[around - size]
            change = 2 * (after - open_count[around]) + 2
            if around[0] == size:
                change[0] = 1 - 2 * open_count[size]
            k = int(change.argmin())
            if change[k] <= best:
                gap, new = int(around[k]), int(around[k]) - size
        if gap == capacity:
            own, made = made, made + 1
        else:
            own = by_gap[gap].pop()
            open_count[gap] -= 1
            if not by_gap[gap]:
                gaps.remove(gap)
        if new:
            if not by_gap[new]:
                insort(gaps, new)
            by_gap[new].append(own)
            open_count[new] += 1
        out.append(own)
    return out


def _pack_groups(items: DataFrame, groups: int, deal: int, capacity: int) -> DataFrame:
    """``(item, length)`` to ``(item, bin, place)``: each task packs what it gets; ``deal`` numbers the round."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        item, length = table["item"].to_numpy(), table["length"].to_numpy()
        order = np.lexsort((item, -length))
        item, length = item[order], length[order]
        bins = np.array(fill(length.tolist(), capacity))
        used = np.zeros(bins.max() + 1, np.int64)
        place = np.empty(len(bins), np.int64)
        for k, (b, n) in enumerate(zip(bins.tolist(), length.tolist(), strict=True)):
            place[k] = used[b]
            used[b] += n
        # A sequence is named by its first piece, so names need no agreement between tasks.
        names = item[np.unique(bins, return_index=True)[1]][bins]
        yield pa.record_batch([pa.array(item), pa.array(names), pa.array(place), pa.array(used[bins])], ["item", "bin", "place", "used"])

    dealt = items.select("item", "length").repartition(groups, F.xxhash64("item", F.lit(deal)))
    return dealt.mapInArrow(pack, "item long, bin long, place long, used long")


def assign(rows: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of at most ``capacity``."""
    numbered = workspace.materialize(rows.withColumn("_item", F.monotonically_increasing_id()), "pieces")
    items = numbered.select(F.col("_item").alias("item"), "length")
    placed = None
    for deal in itertools.count():
        n = items.count()
        if not n:
            break
        groups = -(-n // group_pieces)
        packed = workspace.materialize(_pack_groups(items, groups, deal, capacity), "packed")
        if packed.where(F.col("item") == F.col("bin")).count() == n:  # a sequence is named by one of its items
            if placed is None:
                placed = packed.select("item", "bin", "place")
            break
        if placed is None:
            placed = packed.select("item", "bin", "place")
        else:
            moved = packed.select(F.col("item").alias("old"), F.col("bin").alias("new"), F.col("place").alias("shift"))
            placed = workspace.materialize(
                placed.join(moved, F.col("bin") == F.col("old"), "left").select(
                    "item", F.coalesce("new", "bin").alias("bin"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place")
                ),
                "placed",
            )
        if groups == 1:
            break
        items = packed.where(F.col("used") < capacity).groupBy("bin").agg(F.first("used").alias("length")).withColumnRenamed("bin", "item")
    if placed is None:
        return numbered.select(*rows.columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return numbered.join(placed, F.col("_item") == F.col("item")).select(
        *rows.columns, F.col("bin").alias("sequence_id"), F.col("place").alias("offset")
    )
