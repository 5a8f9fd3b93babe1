"""A hashed maximum-entropy language model with a class-factored softmax.

Tokens are words, lower-cased in A-Z, and one end for each text. A word counts as
head if it makes up at least a ``1 / HEADS`` share of the training tokens: by
that bound there are never more than ``HEADS`` of them, so they can be broadcast.
All other words are the tail; none of them can be hot.

Model: P(token) = P(class | context) P(leaf | class, context) P(word | leaf).
There are 16 classes of 16 leaves. The most frequent heads have a leaf of their
own; other words share leaves by their ending. The first two factors are softmax
functions of weights of hashed features: the word before, the two words before,
and the word before the last (skip), besides a bias. The last factor is the
word's count in its leaf, smoothed with ``UNSEEN`` of the mass, which the leaf's
different training words and one class for all words never met share equally. These
words are counted exactly, so a leaf adds up to one at any size.

Training: biases come from leaf counts. Then, in each round, tasks compute the
gradient over their documents, gradients are summed by blocks of weights with a
shuffle, and the weights take one step, scaled by how often a row was seen.
Documents are dealt to the rounds by hash; every training document counts in one.

Scoring: numpy batches gather weight rows. Counts of tail words are looked up by
shuffle: each batch sends its distinct (document, word) pairs packed by hash
range; a range sums the counts over training documents and returns to each batch
one packed row of sums by document. Words are told apart by 56 bits of a hash and the leaf.

Defined results: a null or empty text is a single end; null ids hash as an empty
text; equal rows get equal scores; without training documents no word is known
and all leaves are alike. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streamlog import workspace
from streamlog.llm import wordhash

HEADS, CLASSES, OWN_LEAVES = 1 << 15, 16, 160
LEAVES = CLASSES * CLASSES
BITS, ROUNDS, STEP, PRIOR = 15, 2, 0.5, 4.0
UNSEEN = 0.05
#: A slice of tokens has its 16 logits each in the processor's cache.
BATCH_BYTES, SLICE, BLOCK = 8 << 20, 1 << 15, 1 << 10
#: Upper bits of a hash that choose where the search for a head begins.
HEAD_BITS = 18
FEATURES = 3
END, BEGIN = np.uint64(1), np.uint64(2)
_LOG10 = np.log(10.0)


@dataclass
class Model:
    """What tasks need; its size is bounded by HEADS and BITS."""

    heads: np.ndarray  # sorted hashes
    leaf_of_head: np.ndarray  # own leaf, or -1
    head_counts: np.ndarray | None = None
    leaf_counts: np.ndarray | None = None
    leaf_words: np.ndarray | None = None  # different training words in each shared leaf
    weights: np.ndarray | None = None  # (2 levels, 2^BITS, 16)

    def biases(self) -> np.ndarray:
        """(17, 16) logs: of the classes, then of the leaves of each class."""
        n = self.leaf_counts.reshape(CLASSES, CLASSES) + 0.5
        both = np.concatenate((n.sum(1)[None], n))
        return np.log(both / both.sum(1, keepdims=True)).astype(np.float32)

    def smoothing(self) -> np.ndarray:
        """Pseudo count of a leaf."""
        return UNSEEN * self.leaf_counts + 1.0

    def share(self) -> np.ndarray:
        """Pseudo count of each word of a leaf, and of its class of words never met."""
        return self.smoothing() / (self.leaf_words + 1.0)


@dataclass
class Tokens:
    """Tokens of a batch of texts, one end after each text."""

    word: np.ndarray  # hashes
    shared: np.ndarray  # the leaf of words without a leaf of their own
    doc: np.ndarray
    first: np.ndarray  # where each text begins

    def before(self, back: int) -> np.ndarray:
        out = np.concatenate((np.full(back, BEGIN), self.word[:-back]))
        for k in range(back):
            at = self.first + k
            out[at[at < np.append(self.first[1:], len(self.word))]] = BEGIN
        return out


def tokens(texts: pa.Array) -> Tokens:
    """All texts are hashed as one, a space apart; no word spans two."""
    data = b" ".join(texts.to_pylist()).lower()
    starts, ends = wordhash.spans(data)
    raw = np.frombuffer(data, np.uint8)
    # The last byte of a word, and the one before it if the word has one.
    last = raw[ends - 1].astype(np.int64) * 257 + np.where(ends - starts > 1, raw[ends - 2], 0)
    lengths = np.array(pc.binary_length(texts), np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    words = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    sizes = words + 1
    first = np.cumsum(sizes) - sizes
    at = np.arange(len(starts)) + np.repeat(np.arange(len(sizes)), words)
    word, shared = np.full(len(starts) + len(sizes), END), np.zeros(len(starts) + len(sizes), np.int64)
    word[at] = wordhash.hashes(data, starts, ends)
    shared[at] = OWN_LEAVES + last * 40_503 % 65_536 % (LEAVES - OWN_LEAVES)
    return Tokens(word, shared, np.repeat(np.arange(len(sizes)), sizes), first)


def _search(heads: np.ndarray, word: np.ndarray) -> np.ndarray:
    """``np.searchsorted`` for sorted hashes: few heads share their upper bits, so few steps lead from there to the place."""
    low = np.searchsorted(heads, np.arange(1 << HEAD_BITS, dtype=np.uint64) << np.uint64(64 - HEAD_BITS))
    at, ended = low[word >> np.uint64(64 - HEAD_BITS)], np.append(heads, np.uint64(0xFFFFFFFFFFFFFFFF))
    while (below := ended[at] < word).any():
        at += below
    return at


def lookup(model: Model, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(head number or -1, leaf) of each token."""
    at = _search(model.heads, t.word)
    at[at == len(model.heads)] = 0
    head = np.where(model.heads[at] == t.word, at, -1) if len(model.heads) else np.full(len(t.word), -1)
    own = np.where(head >= 0, model.leaf_of_head[np.maximum(head, 0)], -1) if len(model.heads) else head
    return head, np.where(own >= 0, own, t.shared)


def _leafed(word: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """What tells the words of shared leaves apart."""
    return word & ~np.uint64(0xFF) | leaf.astype(np.uint64)


def _ranges(word: np.ndarray, ranges: int) -> np.ndarray:
    return ((word >> np.uint64(33)) % np.uint64(ranges)).astype(np.int64)


def _rows(t: Tokens) -> list[np.ndarray]:
    """Feature hashes of each token's context."""
    one, two = t.before(1), t.before(2)
    return [wordhash.mix(one, 1), wordhash.mix(one * np.uint64(3) + wordhash.mix(two, 2), 3), wordhash.mix(two, 4)]


def _level(features: list[np.ndarray], parent: np.ndarray) -> list[np.ndarray]:
    """Weight rows for the features under a parent class (16: none)."""
    salt = (parent.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return [((f ^ salt) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int64) for f in features]


def _slices(model: Model, t: Tokens, leaf: np.ndarray) -> Iterator[tuple[slice, int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(tokens, level, weight rows, wanted digit, log probabilities of all 16 digits)."""
    features, bias = _rows(t), model.biases()
    for at in range(0, len(leaf), SLICE):
        part = slice(at, at + SLICE)
        own = [f[part] for f in features]
        high, low = np.divmod(leaf[part], CLASSES)
        for level, parent, digit in ((0, np.full(len(high), CLASSES), high), (1, high, low)):
            rows = _level(own, parent)
            logits = bias[0 if level == 0 else parent + 1] + np.zeros((len(high), 1), np.float32)
            if model.weights is not None:
                for r in rows:
                    logits += model.weights[level].take(r, 0)
            # A row for each digit: numpy then works along the tokens, not along 16 numbers at a time.
            logits = np.ascontiguousarray(logits.T)
            logits -= logits.max(0)
            logits -= np.log(np.exp(logits).sum(0))
            yield part, level, rows, digit, logits.T


def _batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BATCH_BYTES`` of text."""
    for batch in batches:
        at, size = 0, 0
        for k, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            size += n
            if size >= BATCH_BYTES:
                yield batch.slice(at, k + 1 - at)
                at, size = k + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


def _text(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text")


def find_heads(docs: DataFrame, text_col: str, heads: int = HEADS) -> tuple[Model, int]:
    """(model with heads, number of training tokens).

    A batch reports the words that make up a ``1 / (2 heads)`` share of it. What a
    word's reports miss is below that share of all tokens; so whatever makes up
    1 / heads of all has reports of 1 / (2 heads), and 2 * heads words at most do.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, 0):
            words, counts = np.unique(tokens(batch.column(0)).word, return_counts=True)
            often = counts * 2 * heads >= counts.sum()
            out = np.append(words[often], np.uint64(0)), np.append(counts[often], counts.sum())
            kind = np.append(np.ones(int(often.sum()), np.int32), 0).astype(np.int32)
            yield pa.record_batch([pa.array(kind), pa.array(out[0].view(np.int64)), pa.array(out[1])], ["kind", "word", "n"])

    found = docs.select(_text(docs, text_col)).mapInArrow(report, "kind int, word long, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    found = workspace.materialize(found, "head-reports")
    total = int(found.where("kind = 0").agg(F.sum("n")).first()[0] or 0)
    rows = found.where((F.col("kind") == 1) & (F.col("n") * 2 * heads >= total)).orderBy(F.desc("n"), "word").toPandas()
    word, order = rows["word"].to_numpy(np.int64).view(np.uint64), np.arange(len(rows))
    # The end always has a leaf of its own, number 0, as shared leaves begin at OWN_LEAVES.
    own = np.where(word == END, 0, np.cumsum(word != END))
    sort = np.argsort(word)
    return Model(word[sort], np.where(own < OWN_LEAVES, own, -1)[sort]), total


def _summed(parts: DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(sums of packed arrays by block, numbers of different words by leaf).

    Blocks below 0 hold packed words, a hash range each. The driver gets one row for each block.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        met: dict[int, list[np.ndarray]] = {}
        fresh: dict[int, int] = {}  # words that came since a range was made distinct
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block < 0:
                    own = met.setdefault(block, [np.zeros(0, np.uint64)])
                    own.append(np.frombuffer(data.as_py(), np.uint64))
                    fresh[block] = fresh.get(block, 0) + len(own[-1])
                    if fresh[block] > max(len(own[0]), 1 << 16):
                        met[block], fresh[block] = [np.unique(np.concatenate(own))], 0
                    continue
                own = np.frombuffer(data.as_py(), kind)
                sums[block] = sums[block] + own if block in sums else own.astype(np.float64)
        for block, own in met.items():
            leaf = (np.unique(np.concatenate(own)) & np.uint64(0xFF)).astype(np.int64)
            sums[block] = np.bincount(leaf, minlength=LEAVES).astype(np.float64)
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()])], ["block", "data"])

    rows = parts.repartition(max(1, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "block").mapInArrow(add, "block int, data binary").collect()
    own = [np.frombuffer(r["data"]) for r in sorted(rows, key=lambda r: r["block"]) if r["block"] >= 0]
    return np.concatenate(own) if own else np.zeros(0), sum((np.frombuffer(r["data"]) for r in rows if r["block"] < 0), np.zeros(LEAVES))


def _packed(total: np.ndarray, size: int, kind: str) -> Iterator[pa.RecordBatch]:
    for block, at in enumerate(range(0, len(total), size)):
        yield pa.record_batch([pa.array([block], pa.int32()), pa.array([total[at:at + size].astype(kind).tobytes()])], ["block", "data"])


def count_leaves(docs: DataFrame, text_col: str, model: Model) -> None:
    """Exact counts of heads and leaves, and of the different words in each shared leaf.

    These words meet by hash range; a batch sends each of its words once.
    """
    held, n = docs.sparkSession.sparkContext.broadcast(model), len(model.heads)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + LEAVES, np.int64)
        for batch in _batches(batches, 0):
            t = tokens(batch.column(0))
            head, leaf = lookup(held.value, t)
            total[:n] += np.bincount(head[head >= 0], minlength=n)
            total[n:] += np.bincount(leaf, minlength=LEAVES)
            shares = leaf >= OWN_LEAVES
            word = np.unique(_leafed(t.word[shares], leaf[shares]))
            bucket = _ranges(word, ranges)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(ranges + 1))
            sent = np.flatnonzero(np.diff(cuts)).tolist()
            yield pa.record_batch([pa.array([-1 - b for b in sent], pa.int32()),
                                   pa.array([word[order[cuts[b]:cuts[b + 1]]].tobytes() for b in sent], pa.binary())], ["block", "data"])
        yield from _packed(total, 1 << 13, "<f8")

    total, words = _summed(docs.select(_text(docs, text_col)).mapInArrow(count, "block int, data binary"), "<f8")
    total = total if len(total) else np.zeros(n + LEAVES)
    model.head_counts, model.leaf_counts = total[:n], total[n:]
    model.leaf_words = words


def add_gradient(model: Model, t: Tokens, total: np.ndarray) -> None:
    """Add the errors of the 16 digits, and how often a row was met, to ``total``: (2 levels, 17, 2^BITS)."""
    size = total.shape[2]
    for _, level, rows, digit, logs in _slices(model, t, lookup(model, t)[1]):
        error = -np.exp(logs.T).astype(np.float64)
        error[digit, np.arange(len(digit))] += 1
        for r in rows:
            total[level, CLASSES] += np.bincount(r, minlength=size)
            for c in range(CLASSES):
                total[level, c] += np.bincount(r, error[c], size)


def train(docs: DataFrame, text_col: str, model: Model, rounds: int = ROUNDS) -> None:
    """Gradient rounds; each uses the documents that hash to it."""
    model.weights = np.zeros((2, 1 << BITS, CLASSES), np.float32)
    size = 1 << BITS
    for turn in range(rounds):
        held = docs.sparkSession.sparkContext.broadcast(model)

        def gradient(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            model, total = held.value, np.zeros((2, CLASSES + 1, size))
            for batch in _batches(batches, 0):
                add_gradient(model, tokens(batch.column(0)), total)
            yield from _packed(total.transpose(0, 2, 1).ravel(), BLOCK * (CLASSES + 1), "<f4")

        own = docs.where(F.pmod(F.xxhash64(text_col), F.lit(rounds)) == turn).select(_text(docs, text_col))
        total, _ = _summed(own.mapInArrow(gradient, "block int, data binary"), "<f4")
        if len(total):
            total = total.reshape(2, size, CLASSES + 1)
            bias = np.exp(model.biases())
            # A row's own mean of p (1 - p) is not known; that of the bias stands for it.
            spread = np.stack((bias[0], bias[1:].mean(0)))
            scale = total[:, :, CLASSES:] * (spread * (1 - spread))[:, None] + PRIOR
            model.weights = model.weights + (STEP * total[:, :, :CLASSES] / scale).astype(np.float32)


def score(docs: DataFrame, model: Model, n_tokens: int, held_out, id_col: str = "doc_id", text_col: str = "text",
          ranges: int | None = None) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    held = spark.sparkContext.broadcast(model)
    text = _text(docs, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (~held_out).alias("trains"), text)
    # To a range: the (document, word) pairs of a batch. Back to the batch: their sums by document.
    sums = "n binary, known binary, logs binary, model binary"
    sent = f"range int, batch long, words binary, places binary, times binary, trained binary, ids array<{kind}>, {sums}"
    back = f"batch long, places binary, ids array<{kind}>, {sums}, distinct long"
    named = lambda schema: [x.split()[0] for x in schema.split(", ")]

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, base = held.value, TaskContext.get().partitionId() << 32
        smoothing, own_share = model.smoothing(), model.share()
        for number, batch in enumerate(_batches(batches, 2), base):
            ids, trains = batch.column(0), np.array(batch.column(1).to_pylist(), np.uint8)
            n, t = batch.num_rows, tokens(batch.column(2))
            head, leaf = lookup(model, t)
            share = np.zeros(len(leaf))
            for where, _, _, digit, logs in _slices(model, t, leaf):
                share[where] += logs[np.arange(len(digit)), digit]
            share /= _LOG10
            known = head >= 0
            count = model.head_counts[head[known]] if known.any() else np.zeros(0)
            shares = leaf >= OWN_LEAVES
            share[shares] -= np.log10(model.leaf_counts + smoothing)[leaf[shares]]
            both = known & shares
            share[both] += np.log10(model.head_counts[head[both]] + own_share[leaf[both]])
            own = (np.bincount(t.doc, minlength=n), np.bincount(t.doc[known], count > 0, n),
                   np.bincount(t.doc[known], np.log10(count + 0.1), n), np.bincount(t.doc, share, n))
            out = [(number % ranges, number, None, None, None, None, ids.to_pylist(), *(x.astype("<f8").tobytes() for x in own))]
            tail = ~known
            word, doc = _leafed(t.word[tail], leaf[tail]), t.doc[tail]
            order = np.lexsort((doc, word))
            word, doc = word[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(word) != 0) | (np.diff(doc) != 0)))) if len(word) else np.zeros(0, int)
            times, word, doc = np.diff(np.append(new, len(word))), word[new], doc[new]
            bucket = _ranges(word, ranges)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(ranges + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                at = order[cuts[b]:cuts[b + 1]]
                out.append((b, number, word[at].tobytes(), doc[at].astype("<u4").tobytes(), times[at].astype("<u4").tobytes(),
                            trains[doc[at]].tobytes(), None, None, None, None, None))
            types = (pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.list_(ids.type), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], names=named(sent))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_share, found, numbers = held.value.share(), [], []
        for batch in batches:
            packed = np.array(batch.column(2).is_valid())
            rest = batch.filter(pa.array(~packed))
            if rest.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [rest.column(1), pa.nulls(rest.num_rows, pa.binary()), *rest.columns[6:], pa.nulls(rest.num_rows, pa.int64())], names=named(back)
                )
            for row in np.flatnonzero(packed).tolist():
                word, place, times, trained = (batch.column(c)[row].as_py() for c in range(2, 6))
                found.append((np.frombuffer(word, np.uint64), np.frombuffer(place, "<u4"), np.frombuffer(times, "<u4"), np.frombuffer(trained, np.uint8)))
                numbers.append(batch.column(1)[row].as_py())
        if not found:
            return
        word, place, times, trained = (np.concatenate(x) for x in zip(*found, strict=True))
        distinct, at = np.unique(word, return_inverse=True)
        count = np.bincount(at, times * trained)
        leaf = (distinct & np.uint64(0xFF)).astype(np.int64)
        # An end too rare for a head comes here too; its leaf has no other word.
        in_leaf = np.where(leaf >= OWN_LEAVES, np.log10(count + own_share[leaf]), 0.0)
        each = [(times * x[at]) for x in (count > 0, np.log10(count + 0.1), in_leaf)]
        ends = np.cumsum([len(f[0]) for f in found])
        out = []
        for number, start, end in zip(numbers, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            docs_, inverse = np.unique(place[start:end], return_inverse=True)
            out.append((number, docs_.astype("<u4").tobytes(), None, None, *(np.bincount(inverse, x[start:end]).astype("<f8").tobytes() for x in each), None))
        out.append((-1, None, None, None, None, None, None, int((count > 0).sum())))
        types = (pa.int64(), pa.binary(), pa.list_(id_type), *[pa.binary()] * 4, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)], names=named(back))

    def gather(table: pa.Table) -> pa.Table:
        rows_ = table.to_pylist()
        if rows_[0]["batch"] == -1:
            own = ([None], [-1], [sum(r["distinct"] for r in rows_)], [0.0], [0.0])
        else:
            (whole,) = [r for r in rows_ if r["ids"] is not None]
            n, known, logs, share = (np.frombuffer(whole[c]).copy() for c in ("n", "known", "logs", "model"))
            for r in rows_:
                if r["places"] is not None:
                    at = np.frombuffer(r["places"], "<u4")
                    for total, c in ((known, "known"), (logs, "logs"), (share, "model")):
                        total[at] += np.frombuffer(r[c])
            own = (whole["ids"], n.astype(np.int64), known.astype(np.int64), logs, share)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(own, (id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)],
                                    names=["doc_id", "n", "known", "logs", "model"])

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    parts = rows.mapInArrow(evaluate, sent).repartition(ranges, "range").mapInArrow(meet, back)
    summed = parts.groupBy("batch").applyInArrow(gather, f"doc_id {kind}, n long, known long, logs double, model double")
    summed = workspace.materialize(summed, "lm-sums")
    tail = int(summed.where("n < 0").agg(F.sum("known")).first()[0] or 0)
    distinct = tail + int((model.head_counts > 0).sum())
    return summed.where("n >= 0").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n") * float(np.log10(n_tokens + 0.1 * (distinct + 1)))).alias("base_score"), F.col("model").alias("score"),
    )


def fit(docs: DataFrame, text_col: str = "text") -> tuple[Model, int]:
    """(model, number of training tokens)."""
    model, total = find_heads(docs, text_col)
    count_leaves(docs, text_col, model)
    train(docs, text_col, model)
    return model, total
