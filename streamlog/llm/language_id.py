"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and framed by spaces; their n-grams of 1 to 3 characters
are hashed to 2^15 buckets with numpy. Learning sums n-grams by language and
bucket inside each task first, then with Spark. The matrix of log probabilities,
(buckets + 1) x languages x 4 bytes, is what is broadcast: half a megabyte for
four languages, whatever the corpus. Scoring takes batches of about a million
characters: one gather of matrix rows and one segmented sum per n-gram length.
Long texts are cut into slices that overlap, so memory is bounded and every
n-gram of the whole text counts once.

Defined results: ``und`` with score 0 for a null text, a text without a letter
(a character of a Unicode category L; number signs like U+00BD are none), or if nothing could be learned; else the most probable language and its
probability; ties go to the smaller language by code point. A null id is hashed
as an empty text. Columns other than id, text and, for learning, the label are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, ORDERS, SLICE = 15, (1, 2, 3), 1 << 20
ALPHA = 0.5
UNKNOWN = "und"
_DOCS = -1
#: Odd multipliers of the n-gram hash.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def _slices(texts: list[str], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, start of each slice, its text, whether it ends the text), about ``most`` characters at a time.

    A slice repeats two characters of the next one, so that the n-grams which
    start in it are whole.
    """
    overlap, parts, owners, final, size = max(ORDERS) - 1, [], [], [], 0

    def gathered():
        stops = np.cumsum([len(p) for p in parts])
        return np.concatenate(parts), np.concatenate(([0], stops[:-1])), np.array(owners), np.array(final)

    for k, text in enumerate(texts):
        points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        for at in range(0, max(len(points) - overlap, 1), most):
            parts.append(points[at:at + most + overlap])
            owners.append(k)
            final.append(at + most + overlap >= len(points))
            size += len(parts[-1])
            if size >= most:
                yield gathered()
                parts, owners, final, size = [], [], [], 0
    if parts:
        yield gathered()


def _buckets(points: np.ndarray, starts: np.ndarray, final: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the bucket of the n-gram at each position; 2^BITS where none is counted."""
    wide, mixed = points.astype(np.uint64), np.zeros(len(points), np.uint64)
    stops = np.concatenate((starts[1:], [len(points)]))
    for order in ORDERS:
        mixed[:len(points) - order + 1] += wide[order - 1:] * _MIX[order - 1]
        bucket = ((mixed ^ mixed >> np.uint64(29)) * _MIX[0] >> np.uint64(64 - BITS)).astype(np.int64)
        for back in range(1, max(ORDERS)):
            bucket[(stops - back)[~final | (back < order)]] = 1 << BITS
        yield bucket


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, bucket, n)``: n-grams by language; bucket -1 counts documents."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string"), F.col(text_col).cast("string")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            langs, texts = (np.array(c.to_pylist(), object) for c in batch.columns)
            for lang in sorted(set(langs)):
                own = list(texts[langs == lang])
                docs_of[lang] = docs_of.get(lang, 0) + len(own)
                total = found.setdefault(lang, np.zeros((1 << BITS) + 1, np.int64))
                for points, starts, _, final in _slices(own, SLICE):
                    for bucket in _buckets(points, starts, final):
                        total += np.bincount(bucket, minlength=len(total))
        for lang, total in found.items():
            hit = np.flatnonzero(total[:-1])
            yield pa.record_batch(
                [pa.array([lang] * (len(hit) + 1)), pa.array(np.append(hit, _DOCS).astype(np.int32)),
                 pa.array(np.append(total[hit], docs_of[lang]))],
                ["lang", "bucket", "n"],
            )

    return rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log probabilities by bucket and language, log priors); at most (2^15 + 1) rows a language reach the driver."""
    table = counts(docs, text_col, lang_col).toPandas()
    langs = sorted(set(table["lang"]))
    place = {lang: k for k, lang in enumerate(langs)}
    matrix = np.full(((1 << BITS) + 1, len(langs)), ALPHA)
    columns, buckets, n = table["lang"].map(place).to_numpy(int), table["bucket"].to_numpy(), table["n"].to_numpy()
    grams = buckets != _DOCS
    matrix[buckets[grams], columns[grams]] += n[grams]
    prior = np.ones(len(langs))
    prior[columns[~grams]] += n[~grams]
    logs = np.log(matrix / matrix[:-1].sum(0)) if langs else matrix
    logs[-1] = 0
    return langs, logs.astype(np.float32), np.log(prior / prior.sum()) if langs else prior


def rate(texts: list[str | None], model: tuple[list[str], np.ndarray, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Languages and their probabilities for one batch."""
    langs, logs, prior = model
    most = max(SLICE * 4 // max(len(langs), 4), 1 << 12)
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rated = [k for k, t in enumerate(texts) if langs and t is not None and any(map(str.isalpha, t))]
    sums = np.tile(prior, (len(rated), 1))
    for points, starts, owners, final in _slices([texts[k] for k in rated], most):
        for bucket in _buckets(points, starts, final):
            np.add.at(sums, owners, np.add.reduceat(logs[bucket], starts, dtype=np.float64))
    if rated:
        own = np.exp(sums - sums.max(1, keepdims=True))
        for k, best, share in zip(rated, own.argmax(1), own.max(1) / own.sum(1), strict=True):
            names[k], scores[k] = langs[best], share
    return names, scores


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = rate(batch.column(1).to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)], names=[id_col, "lang_pred", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(scored, f"`{id_col}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], least: float = 0.0) -> DataFrame:
    """The documents whose language is told, with probability ``least`` or more, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def told(texts: pd.Series) -> pd.Series:
        names, scores = rate([t if isinstance(t, str) else None for t in texts], held.value)
        return pd.Series((np.array(names) != UNKNOWN) & (scores >= least))

    return docs.where(told(F.col("text").cast("string")))
