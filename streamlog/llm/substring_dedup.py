"""Substring deduplication with suffix automata of reference shards.

Candidates: every window of ``width`` words has a 64-bit hash. A task gathers
documents into batches, keeps the first place of each hash in the batch and
sends only these on, packed into one array per batch and hash range. So a line
that all documents share costs one entry per batch, and no range can run hot.
A range finds the first place of each hash and tells the batches of all others,
in one packed row each. There it becomes a pair: a window, and one place before it.

Passages: documents meet their pairs, consecutive windows with consecutive places
are joined to maximal spans, and the words of spans and of the places they refer
to are cut out, routed by the document referred to.

Automata: each shard of reference passages, bounded by ``SHARD_WORDS``, becomes a
suffix automaton. The spans routed to it are streamed for matching statistics; the
maximal spans in which they reach ``width`` are what is removed, nothing else is. Hashes
only propose what to stream, and where: equal windows always have equal hashes, so
nothing is missed. A proposed window that the automaton does not hold comes from equal hashes
of different words, which may hide a true first place; then everything is done again
with another hash.

Automata are sent to the tasks that stream the spans of their shard, not to all:
sending every shard to every document would make work grow with the square of
the corpus. The number of hash ranges follows the bytes of text, each range is placed in a
partition of its own, and a task holds one.

Defined results: a null text has no words; null ids come before all others; equal
ids are ordered by text, and rows repeated with id and text are one document;
an empty table has no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streamlog import workspace
from streamlog.llm import wordhash
from streamlog.llm.housekeeping import dropping_shuffles
from streamlog.llm.suffix_automaton import SuffixAutomaton

WIDTH = 20
BATCH_BYTES, SHARD_WORDS = 4 << 20, 100_000
#: Words that are streamed through one automaton; building it costs as much as streaming a few times its words.
PART_WORDS = 2_000_000
#: Bytes of text for each hash range; a task holds the hashes of one range.
RANGE_BYTES = 12 << 20


def _planes(numbers: np.ndarray) -> bytes:
    """Ascending integers as differences, bytes of equal weight together."""
    return np.ascontiguousarray(np.diff(numbers, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


def _pair_schema(kind: str) -> str:
    """Windows ``starts`` of a document that also stand earlier, at ``ref_starts`` of other documents; and windows it is ``wanted`` for."""
    return (f"doc_id {kind}, mark long, wanted binary, starts binary, ref_starts binary, ref_ids array<{kind}>,"
            " ref_marks array<bigint>")


#: Numbers of the four kinds of rows that the steps of ``candidates`` exchange.
BATCH, HASHES, PAIRS, WANTED = range(4)


def _packed_schema(kind: str) -> str:
    """``batch`` and ``what`` it is about: places in the batch, and lists of documents."""
    return f"batch long, what int, places binary, numbers binary, ids array<{kind}>, marks array<bigint>"


def _packed(rows: list[tuple], kind: pa.DataType, first: tuple[str, pa.DataType] | None = None) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(kind), pa.list_(pa.int64())]
    names = _names(_packed_schema("x"))
    if first:
        types, names = [first[1], *types], [first[0], *names]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _lists(values: pa.Array, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values)


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _grouped(doc: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    return np.concatenate((np.flatnonzero(np.diff(doc, prepend=-1)), [len(doc)]))


def _order(ids: pa.Array, marks: np.ndarray) -> np.ndarray:
    """Ranks of documents by id, null first, and then mark; equal ones share a rank."""
    if pa.types.is_integer(ids.type) and not ids.null_count:
        own = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((marks, own))
        new = (np.diff(own[order], prepend=own[order[:1]]) != 0) | (np.diff(marks[order], prepend=marks[order[:1]]) != 0)
        rank = np.empty(len(own), np.int64)
        rank[order] = np.cumsum(new)
        return rank
    keys = [(x is not None, x if x is not None else 0, m) for x, m in zip(ids.to_pylist(), marks.tolist(), strict=True)]
    rank = {k: n for n, k in enumerate(sorted(set(keys)))}
    return np.array([rank[k] for k in keys], np.int64)


def _firsts(hash_: np.ndarray, rank: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, leader): ``order`` sorts by hash and place; ``leader[i]`` is the first of the group of ``order[i]``."""
    order = np.lexsort((start, rank, hash_))
    cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], np.diff(hash_[order]) != 0))), [len(order)])) if len(order) else np.zeros(1, int)
    return order, order[np.repeat(cuts[:-1], np.diff(cuts))]


def _later(ids: pa.Array, marks: np.ndarray, hash_: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows that stand earlier too, their first places, the first places of all hashes)."""
    rank = _order(ids, marks)[doc] if len(doc) else doc
    order, leader = _firsts(hash_, rank, start)
    late = (rank[order] != rank[leader]) | (start[order] != start[leader])
    return order[late], leader[late], order[order == leader]


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, mark, text)``; the mark tells texts with one id apart, and is 0 where an id stands once."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    again = rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_again"))
    again = workspace.measured(again, "repeated-ids")
    if again.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("mark"), "text")
    mark = F.when(F.col("_again"), F.xxhash64("text")).otherwise(0)
    return rows.join(again, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", mark.cast("long").alias("mark"), "text")


def candidates(rows: DataFrame, width: int, salt: int, ranges: int) -> DataFrame:
    """Pairs of windows with equal hashes; see ``_pair_schema``.

    Batches send hashes to ranges; a range sends each batch one packed row of what
    it found for it; a batch turns these into rows for its documents.
    """
    kind, id_type = rows.schema["doc_id"].dataType.simpleString(), to_arrow_type(rows.schema["doc_id"].dataType)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for k, n in enumerate(pc.binary_length(batch.column(2)).to_pylist()):
                size += n
                if size >= BATCH_BYTES:
                    held.append(batch.slice(at, k + 1 - at))
                    yield sent(held, number)
                    held, size, at, number = [], 0, k + 1, number + 1
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield sent(held, number)

    def sent(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        ids = pa.concat_arrays([b.column(0) for b in held])
        marks = pa.concat_arrays([b.column(1) for b in held]).to_numpy()
        found = []
        for batch in held:
            for text in batch.column(2):
                data = text.as_py()
                found.append(wordhash.windows(wordhash.hashes(data, *wordhash.spans(data), salt), width, salt))
        sizes = np.array([len(x) for x in found])
        base, hash_ = np.concatenate(([0], np.cumsum(sizes))), np.concatenate(found)
        del found
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        start = (np.arange(len(hash_)) - base[doc]).astype(np.int32)
        late, leader, first = _later(ids, marks, hash_, doc, start)
        out = [(number % ranges, number, BATCH, _planes(base), None, ids.to_pylist(), marks.tolist())]
        if len(late):
            order = np.argsort(late)
            late, leader = late[order], leader[order]
            out.append((number % ranges, number, PAIRS, _planes(late), start[leader].astype("<i4").tobytes(),
                        ids.take(pa.array(doc[leader])).to_pylist(), marks[doc[leader]].tolist()))
            out.append((number % ranges, number, WANTED, _planes(np.unique(leader)), None, None, None))
        first = np.sort(first)
        bucket = ((hash_[first] >> np.uint64(33)) % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(ranges + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            at = first[order[cuts[b]:cuts[b + 1]]]
            used = np.unique(doc[at])
            out.append((b, number, HASHES, _planes(at) + _planes(base[used]), hash_[at].tobytes(),
                        ids.take(pa.array(used)).to_pylist(), marks[used].tolist()))
        return _packed(out, id_type, ("range", pa.int32()))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, marks, hashes, docs, starts, places, numbers, n = [], [], [], [], [], [], [], 0
        for batch in batches:
            hashed = np.array(batch.column(2)) == HASHES
            rest = batch.filter(pa.array(~hashed))
            if rest.num_rows:
                yield pa.RecordBatch.from_arrays(rest.columns[1:], names=_names(_packed_schema("x")))
            for row in np.flatnonzero(hashed).tolist():
                number, _, both, hash_, own, mark = (batch.column(c)[row] for c in range(1, 7))
                hash_, both = np.frombuffer(hash_.as_py(), np.uint64), both.as_py()
                at, base = _unplanes(both[:4 * len(hash_)]), _unplanes(both[4 * len(hash_):])
                doc = np.searchsorted(base, at, "right") - 1
                numbers.append(number.as_py())
                hashes.append(hash_)
                docs.append((doc + n).astype(np.int32))
                starts.append((at - base[doc]).astype(np.int32))
                places.append(at.astype(np.uint32))
                ids.append(own.values)
                marks.append(mark.values.to_numpy())
                n += len(base)
        if not hashes:
            return
        ids, marks = pa.concat_arrays(ids), np.concatenate(marks)
        batch_of = np.repeat(np.arange(len(numbers)), [len(h) for h in hashes])
        hash_, doc, start, place = (np.concatenate(x) for x in (hashes, docs, starts, places))
        del hashes, docs, starts, places
        late, leader, _ = _later(ids, marks, hash_, doc, start)
        order = np.lexsort((place[late], batch_of[late]))
        late, leader = late[order], leader[order]
        out, cuts = [], np.searchsorted(batch_of[late], np.arange(len(numbers) + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own, ref = late[cuts[b]:cuts[b + 1]], leader[cuts[b]:cuts[b + 1]]
            out.append((numbers[b], PAIRS, _planes(place[own].astype(np.int64)), start[ref].astype("<i4").tobytes(),
                        ids.take(pa.array(doc[ref])).to_pylist(), marks[doc[ref]].tolist()))
        wanted = np.unique(leader)
        wanted = wanted[np.lexsort((place[wanted], batch_of[wanted]))]
        cuts = np.searchsorted(batch_of[wanted], np.arange(len(numbers) + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            out.append((numbers[b], WANTED, _planes(place[wanted[cuts[b]:cuts[b + 1]]].astype(np.int64)), None, None, None))
        yield _packed(out, id_type)

    def spread(table: pa.Table) -> pa.Table:
        what = table["what"].to_numpy()
        (row,) = np.flatnonzero(what == BATCH).tolist()
        base, ids = _unplanes(table["places"][row].as_py()), table["ids"][row].values
        marks = table["marks"][row].values.to_numpy()
        pairs, wanted = np.flatnonzero(what == PAIRS).tolist(), np.flatnonzero(what == WANTED).tolist()
        empty = np.zeros(0, np.int64)
        at = np.concatenate([empty, *[_unplanes(table["places"][k].as_py()) for k in pairs]])
        order = np.argsort(at)
        at = at[order]
        ref_start = np.concatenate([empty.astype("<i4"), *[np.frombuffer(table["numbers"][k].as_py(), "<i4") for k in pairs]])[order]
        ref_id = pa.concat_arrays([pa.array([], id_type), *[table["ids"][k].values for k in pairs]]).take(pa.array(order))
        ref_mark = np.concatenate([empty, *[table["marks"][k].values.to_numpy() for k in pairs]])[order]
        doc = np.searchsorted(base, at, "right") - 1
        cuts = _grouped(doc)
        own = doc[cuts[:-1]]
        found = [
            ids.take(pa.array(own)), pa.array(marks[own]), pa.nulls(len(own), pa.binary()), _binaries((at - base[doc]).astype("<i4"), cuts),
            _binaries(ref_start, cuts), _lists(ref_id, cuts), _lists(pa.array(ref_mark), cuts),
        ]
        at = np.unique(np.concatenate([empty, *[_unplanes(table["places"][k].as_py()) for k in wanted]]))
        doc = np.searchsorted(base, at, "right") - 1
        cuts = _grouped(doc)
        own = doc[cuts[:-1]]
        n = len(own)
        asked = [
            ids.take(pa.array(own)), pa.array(marks[own]), _binaries((at - base[doc]).astype("<i4"), cuts), pa.nulls(n, pa.binary()),
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(id_type)), pa.nulls(n, pa.list_(pa.int64())),
        ]
        return pa.Table.from_arrays([pa.concat_arrays(x) for x in zip(found, asked, strict=True)], names=_names(_pair_schema("x")))

    packed = _packed_schema(kind)
    met = rows.mapInArrow(gather, f"range int, {packed}").repartitionById(ranges, "range").mapInArrow(meet, packed)
    return met.groupBy("batch").applyInArrow(spread, _pair_schema(kind))


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs in which every column rises by one."""
    n = len(columns[0])
    if not n:
        return []
    breaks = np.zeros(n - 1, bool)
    for c in columns:
        breaks |= np.diff(c) != 1
    cuts = [0, *(np.flatnonzero(breaks) + 1).tolist(), n]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def passages(rows: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Words to compare: spans of documents, and with ``is_ref`` the parts of documents they refer to.

    ``(doc_id, mark, at)`` is where a span starts; ``(key_id, key_mark)`` the document referred to.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    info = pairs.groupBy("doc_id", "mark").agg(
        F.collect_list("wanted").alias("wanted"),
        F.collect_list(F.when(F.col("starts").isNotNull(), F.struct("starts", "ref_starts", "ref_ids", "ref_marks"))).alias("found"),
    ).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "wanted", "found")
    met = rows.join(info, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))).select(
        "doc_id", "text", "mark", "wanted", "found"
    )
    schema = f"doc_id {kind}, mark long, at long, key_id {kind}, key_mark long, is_ref boolean, passage binary, n_words long"
    names = _names(schema)

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [batch.column(0).type, pa.int64(), pa.int64(), batch.column(0).type, pa.int64(), pa.bool_(), pa.binary(), pa.int64()]
            out, size = [], 0
            for k in range(batch.num_rows):
                doc, text, mark = (batch.column(c)[k].as_py() for c in range(3))
                out += one(doc, text, mark, batch.column(3)[k].as_py(), batch.column(4)[k])
                size += len(text)
                if size > 8 << 20:
                    yield made(out, kinds)
                    out, size = [], 0
            if out:
                yield made(out, kinds)

    def made(out: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def one(doc, text: bytes, mark: int, wanted: list[bytes], found) -> Iterator[tuple]:
        words = text.split()
        if len(found):
            parts = [(np.frombuffer(p["starts"].as_py(), "<i4"), np.frombuffer(p["ref_starts"].as_py(), "<i4"), p["ref_ids"].values, p["ref_marks"].values) for p in found]
            start, ref_start = (np.concatenate([p[c] for p in parts]).astype(np.int64) for c in (0, 1))
            ref_id, ref_mark = (pa.concat_arrays([p[c] for p in parts]) for c in (2, 3))
            order = np.argsort(start, kind="stable")
            start, ref_start, ref_id = start[order], ref_start[order], ref_id.take(pa.array(order))
            ref_mark = ref_mark.to_numpy()[order]
            # Both places rise by one inside a span, and the document stays: its number is added so that it rises as well.
            label = np.arange(len(start)) + np.unique(_order(ref_id, ref_mark), return_inverse=True)[1] * (len(start) + 1)
            for a, b in _runs(start, ref_start, label):
                own = words[start[a]:start[b - 1] + width]
                yield (doc, mark, int(start[a]), ref_id[a].as_py(), int(ref_mark[a]), False, b" ".join(own), len(own))
        if wanted:
            start = np.unique(np.concatenate([np.frombuffer(x, "<i4") for x in wanted]))
            for a, b in _runs(start):
                own = words[start[a]:start[b - 1] + width]
                yield (doc, mark, int(start[a]), doc, mark, True, b" ".join(own), len(own))

    return met.mapInArrow(cut_batches, schema)


def matched(found: DataFrame, width: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(doc_id, mark, start, stop, misses)``: maximal spans in which matching statistics reach ``width``.

    The passages referred to are shards of about ``shard_words`` words; each becomes one automaton.
    The spans of a shard are dealt in parts of about ``PART_WORDS`` words, each with an automaton of its own, so
    a passage that a third of all documents repeat keeps no task longer than others. ``misses``
    counts windows of a span that the automaton does not hold; such a row has an empty span.
    """
    kind = found.schema["doc_id"].dataType.simpleString()
    words = found.where("is_ref").agg(F.sum("n_words")).first()[0] or 0
    shards = max(-(-words // shard_words), 1)
    routed = found.withColumn("shard", F.pmod(F.xxhash64("key_id", "key_mark"), F.lit(shards)))
    load = routed.where("NOT is_ref").groupBy("shard").agg(F.ceil(F.sum("n_words") / PART_WORDS).cast("int").alias("parts"))
    load = workspace.measured(load, "shard-loads")
    dealt = routed.join(load, "shard").withColumn(
        "part",
        F.explode(F.when(F.col("is_ref"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("doc_id", "mark", "at"), F.col("parts")).cast("int"))
        )),
    )
    schema = f"doc_id {kind}, mark long, start long, stop long, misses long"
    names = _names(schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, automaton = None, None
        for batch in batches:
            out = []
            shard_, part_, ref_, texts, ids, marks, at = (c.to_pylist() for c in batch.columns)
            for k, (shard, part, is_ref) in enumerate(zip(shard_, part_, ref_, strict=True)):
                if (shard, part) != now:
                    now, automaton = (shard, part), SuffixAutomaton()
                run = texts[k].split()
                if is_ref:
                    automaton.add(run)
                elif automaton.holds_windows(run, width):  # as nearly always
                    out.append((ids[k], marks[k], at[k], at[k] + len(run), 0))
                else:
                    reached = np.fromiter(automaton.statistics(run), np.int64, len(run))[width - 1:] >= width
                    # Windows that start at a run of places cover the words from the first to the last one's end.
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], reached, [False])).astype(np.int8))).reshape(-1, 2)
                    out += [(ids[k], marks[k], at[k] + a, at[k] + b + width - 1, 0) for a, b in edges.tolist()]
                    out.append((ids[k], marks[k], 0, 0, int((~reached).sum())))
            if out:
                types = (batch.column(4).type, *[pa.int64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    tasks = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shards, 1 << 20))
    order = ["shard", "part", F.desc("is_ref")]
    columns = ["shard", "part", "is_ref", "passage", "doc_id", "mark", "at"]
    return dealt.select(*columns).repartition(tasks, "shard", "part").sortWithinPartitions(*order).mapInArrow(stream, schema)


def remove(rows: DataFrame, spans: DataFrame, finish: Callable[[bytes], str]) -> DataFrame:
    """``(doc_id, n_words, n_removed, removed, kept)``: every document without the words of its spans."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    packed = F.collect_list(F.array("start", "stop")).alias("spans")
    info = spans.where("stop > start").groupBy("doc_id", "mark").agg(packed).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "spans"
    )
    met = rows.join(info, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                words, removed = text.as_py().split(), []
                n, kept = len(words), words
                if spans:
                    cover = np.zeros(n + 1, np.int64)
                    edges = np.array(spans)
                    np.add.at(cover, edges[:, 0], 1)
                    np.add.at(cover, edges[:, 1], -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    removed = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).reshape(-1, 2).tolist()
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out.append((n, n - len(kept), removed, finish(b" ".join(kept))))
            if out:
                types = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string())
                made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return met.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, removed array<array<bigint>>, kept string"
    )


def deduplicate(docs: DataFrame, width: int = WIDTH, finish: Callable[[bytes], str] = bytes.decode, id_col: str = "doc_id",
                text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(id, n_words, n_removed, removed, kept)``; ``kept`` is ``finish`` of the words that stay, joined by spaces."""
    spark = docs.sparkSession
    rows = _marked(docs, id_col, text_col)
    ranges = max(-(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // range_bytes), 1)
    salt = 0
    while True:
        with dropping_shuffles(spark):
            with workspace.scratch(spark):
                pairs = workspace.materialize(candidates(rows, width, salt, ranges), "window-pairs")
                path = workspace.new_dir(spark, "matched-spans")
                found = workspace.materialize(passages(rows, pairs, width), "passages")
                spans = matched(found, width)
                spans.write.parquet(path)
            spans = spark.read.schema(spans.schema).parquet(path)
            misses = spans.agg(F.sum("misses")).first()[0]
        if not misses:
            break
        workspace.delete(spark, path)
        salt += 1
    out = remove(rows, spans, finish)
    return out.select(F.col("doc_id").alias(id_col), "n_words", "n_removed", "removed", "kept")
