"""Token counts of texts by a public tokenizer, lengths only.

Texts pass through Arrow in one pass without a shuffle. A text longer than ``PIECE``
code points is cut where the tokenizer's own splitting has a boundary whatever stands
around: before white space that follows a letter, digit or one of ``.,;:!?)``; between
an ASCII letter and a digit; before ``.,;:!?)`` after an ASCII letter or digit; and
after full-width punctuation before a letter of an East Asian script. None of these
places lies inside a special string. Pieces then go to the tokenizer in batches of
about ``BATCH`` code points, so a batch costs the same for short and for long texts,
and only the number of tokens of a piece is kept, added up by text.

Defined results: a null or empty text has no bytes and no tokens; a stretch without any
such place (a word of many megabytes) is encoded whole; repeated rows are counted each;
an empty table gives no rows. Special strings inside a text are special tokens, as the
library does by default. Only id and text are read.

The tokenizer must split as byte-level BPE does: words, numbers and other signs with at
most one space before them. For another one pass ``piece=None``, then texts stay whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024
PIECE, BATCH = 1 << 16, 1 << 19
_BOUNDARY = regex.compile(
    r"(?<=[\p{L}\p{Nd}.,;:!?)])(?=[ \t\n\r])"
    r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z0-9])(?=[.,;:!?)])"
    r"|(?<=[。、，！？；：])(?=[一-鿿ぁ-ゖァ-ヺ가-힣])"
)


def pieces(text: str, piece: int | None = PIECE) -> Iterator[str]:
    """Parts of a text whose token counts add up to that of the whole."""
    at = 0
    while piece is not None and len(text) - at > piece:
        cut = _BOUNDARY.search(text, at + piece)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def batches_of(texts: Iterator[str], size: int, piece: int | None) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of pieces with the number of the text each is of; a batch ends when it has ``size`` code points."""
    owners, parts, held = [], [], 0
    for k, text in enumerate(texts):
        for part in pieces(text, piece):
            owners.append(k)
            parts.append(part)
            held += len(part)
            if held >= size:
                yield owners, parts
                owners, parts, held = [], [], 0
    if parts:
        yield owners, parts


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    limit: int = LIMIT, piece: int | None = PIECE, batch: int = BATCH,
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row."""

    def count(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer_path).encode_batch_fast
        for rows in arrow:
            lengths = np.zeros(rows.num_rows, np.int64)
            texts = (t.as_py() for t in rows.column(1))
            for owners, parts in batches_of(texts, batch, piece):
                found = [len(e) for e in encode(parts, add_special_tokens=False)]
                np.add.at(lengths, owners, found)
            yield pa.record_batch([rows.column(0), rows.column(2), pa.array(lengths)], [id_col, "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
