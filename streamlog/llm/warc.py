"""WARC archives: writing records of a table, and a reader that salvages damage.

Writing: each task packs its records into archives of about ``archive_bytes``;
one row is one archive, and Spark's text writer with one row a file puts them
into the folder. So files come through Spark's committer (a lost task leaves no
half archive behind) and any file system that Spark knows will do. The writer's
line separator ends each file as one empty gzip member, or as an empty line.
Of records with equal payloads one is a ``response``; the others are ``revisit``
records, which name it and keep its HTTP header with the payload's length.

Reading: an archive is read whole by one task (a gzip member cannot be entered in
the middle), so a task needs memory for one archive. A position must hold a gzip
member whose CRC, length and content check, or a version line with a header, a
block that ends in two line ends, and digests that match. After a failed check
the reader looks for the next version line or member that passes all checks; the
bytes in between come back as one row of kind ``gap`` with the reason. Records
after a gap are therefore never lost. If only a digest is wrong and the record
is otherwise well framed, exactly this record is quarantined. The content of a member
is searched in the same way; its records and gaps have the place of the member, and
the reason of a gap tells the place inside. So is what a damaged member gave before
it broke: these records pass their own checks only, their place runs up to the end of
the gap, and the gap is listed as well. Digests may be in base32 or hex.

Defined results: a header without an end before the next version line or within
``HEADER_BYTES``, and a length of more than 18 digits, are damage; an id of another writer
has no row id; Spark refuses an archive beyond 2 GB, so larger ones must be cut before; a null payload is empty; a null URI becomes ``urn:none``; a null
id has a reserved record id and reads back as null; repeated rows give repeated
records, and all rows with the largest id of a payload are responses; an empty
table gives no archive, and reading no archive gives no rows. Columns of the
input other than those named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import workspace

ARCHIVE_BYTES = 8 << 20
#: A header that is longer is damage; the bound keeps a search over damaged bytes linear.
HEADER_BYTES = 1 << 18
#: An empty gzip member.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" "0300" "00000000" "00000000")
MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
_BLANK = re.compile(rb"[\r\n]+")
_HEX = re.compile(r"[0-9a-fA-F]{40}")
_HTTP_LENGTH = re.compile(rb"(?i)\r\ncontent-length:[ ]*(\d+)")
SCHEMA = (
    "path string, kind string, offset long, length long, reason string, record_type string, record_id string,"
    " target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_ARROW = pa.schema(
    [(n, pa.string()) for n in ("path", "kind")] + [("offset", pa.int64()), ("length", pa.int64())]
    + [(n, pa.string()) for n in ("reason", "record_type", "record_id", "target_uri", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def record_id(row_id: int | None) -> str:
    """A version 8 UUID that carries a 64-bit row id; bit 0 marks a null."""
    bits = 0 if row_id is None else row_id & (1 << 64) - 1
    low = (bits & 0xF) << 58 | (row_id is None)
    return f"<urn:uuid:{uuid.UUID(int=bits >> 16 << 80 | 8 << 76 | (bits >> 4 & 0xFFF) << 64 | 2 << 62 | low)}>"


def row_id(record: str | None) -> int | None:
    if not record:
        return None
    try:
        n = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    except ValueError:  # an id of another writer
        return None
    if n & 1:
        return None
    bits = n >> 80 << 16 | (n >> 64 & 0xFFF) << 4 | n >> 58 & 0xF
    return bits - (1 << 64) if bits >> 63 else bits


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _base32(digest: str) -> str:
    """A sha1 digest in hex, 40 digits, as base32; others as they are."""
    return base64.b32encode(bytes.fromhex(digest)).decode() if _HEX.fullmatch(digest) else digest


def record_bytes(kind: str, own: str, uri: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '', uri)}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head[2:2] = [
            f"WARC-Refers-To: {refers_to}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"


def write(
    pages: DataFrame, path: str, id_col: str, uri_col: str, payload_col: str,
    archive_bytes: int = ARCHIVE_BYTES, gzip: bool = True,
) -> None:
    """Write one record per row into archives in the folder ``path``."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    # Only payloads that occur again need a join; their table has a row per group.
    again = workspace.measured(
        rows.groupBy("sha").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "equal-payloads",
    )
    marked = rows.join(again.withColumn("again", F.lit(True)), "sha", "left").select("id", "uri", "payload", "sha", "first", "again")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for batch in batches:
            for n, uri, payload, sha, first, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = "revisit" if again and n != first else "response"
                data = record_bytes(
                    kind, record_id(n), uri or "urn:none", payload, base64.b32encode(sha).decode(),
                    record_id(first) if kind == "revisit" else None,
                )
                if gzip:
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = pack.compress(data) + pack.flush()
                made.append(data)
                size += len(data)
                if size >= archive_bytes:
                    yield pa.record_batch([pa.array([b"".join(made)], pa.binary())], ["value"])
                    made, size = [], 0
        if made:
            yield pa.record_batch([pa.array([b"".join(made)], pa.binary())], ["value"])

    end = EMPTY_MEMBER.decode("latin-1") if gzip else "\r\n"
    (
        marked.mapInArrow(archives, "value binary").select(F.col("value").cast("string"))
        .write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", end).text(path)
    )


class Damage(Exception):
    """A failed check; ``end`` is where the record ends if its framing is intact.

    ``saved``: records of a damaged member; ``reach``: where reading it ended.
    """

    def __init__(self, reason: str, end: int | None = None, saved: list[dict] | None = None, reach: int = 0):
        super().__init__(reason)
        self.reason, self.end, self.saved, self.reach = reason, end, saved or [], reach


def _number(digits: bytes) -> int:
    """A length; one of more than 18 digits is beyond any archive."""
    if len(digits.lstrip(b"0")) > 18:
        raise Damage("length beyond any archive")
    return int(digits[-18:])


def _record(data: bytes, at: int) -> tuple[int, dict]:
    """The record at ``at`` and where it ends."""
    line = _LINE.match(data, at)
    if not line:
        raise Damage("no version line")
    # A header ends before the next version line and within its bound, so a search after damage reads each byte a few times at most.
    following = _LINE.search(data, line.end(), line.end() + HEADER_BYTES)
    limit = following.start() if following else line.end() + HEADER_BYTES
    ends = (data.find(b"\r\n\r\n", line.end() - 2, limit), data.find(b"\n\n", line.end() - 1, limit))
    head_end = min((m for m in ends if m >= 0), default=-1)
    if head_end < 0:
        raise Damage("header does not end")
    skip = 4 if data[head_end:head_end + 4] == b"\r\n\r\n" else 2
    fields: dict[bytes, bytes] = {}
    for entry in re.sub(rb"\r?\n[ \t]+", b" ", data[line.end():head_end]).splitlines():
        name, colon, value = entry.partition(b":")
        if not colon or not name.strip():
            raise Damage("malformed header")
        fields[name.strip().lower()] = value.strip()
    if not {b"warc-type", b"warc-record-id"} <= fields.keys() or not fields.get(b"content-length", b"").isdigit():
        raise Damage("header lacks a field")
    start = head_end + skip
    stop = start + _number(fields[b"content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damage("block does not end where its length says")
    end, block = stop + 4, data[start:stop]
    framed = end if end == len(data) or _START.match(data, end) else None

    def verify(name: bytes, content: bytes) -> str | None:
        label, _, digest = fields.get(name, b"").partition(b":")
        digest = _base32(digest.decode("latin-1"))
        if label.lower() == b"sha1" and digest_of(content) != digest.upper():
            raise Damage(f"{name.decode()} does not match", framed)
        return digest or None

    verify(b"warc-block-digest", block)
    kind, payload, size, digest = fields[b"warc-type"].decode("latin-1"), block, len(block), None
    if b"application/http" in fields.get(b"content-type", b""):
        head, blank, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit" and (told := _HTTP_LENGTH.search(head)):
            size = _number(told[1])
    if kind == "revisit":
        digest = _base32(fields.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode("latin-1")) or None
    else:
        digest = verify(b"warc-payload-digest", payload) or digest_of(payload)
    text = lambda name: fields[name].decode("utf-8", "replace") if name in fields else None
    return end, {
        "record_type": kind, "record_id": text(b"warc-record-id"), "target_uri": text(b"warc-target-uri"),
        "refers_to": text(b"warc-refers-to"), "payload_digest": digest, "payload_bytes": size, "payload": payload,
    }


def _salvage(content: bytes) -> Iterator[dict]:
    """Records and gaps of inflated bytes, in order; offsets are those in ``content``."""
    at, bad, reason = 0, None, ""
    while at < len(content):
        skipped = _BLANK.match(content, at) if bad is None else None
        if skipped:
            at = skipped.end()
            continue
        try:
            end, record = _record(content, at)
        except Damage as damage:
            if bad is None:
                bad, reason = at, damage.reason
            line = None if damage.end else _LINE.search(content, at + 1)
            at = damage.end or (line.start() if line else len(content))
            if damage.end:  # this record only
                yield {"kind": "gap", "offset": bad, "length": at - bad, "reason": reason}
                bad = None
            continue
        if bad is not None:
            yield {"kind": "gap", "offset": bad, "length": at - bad, "reason": reason}
            bad = None
        yield {"kind": "record", "offset": at, "length": end - at, **record}
        at = end
    if bad is not None:
        yield {"kind": "gap", "offset": bad, "length": len(content) - bad, "reason": reason}


def _inflated(data: bytes, at: int) -> tuple[int, bytes, str]:
    """(where reading the gzip member at ``at`` ended, all that could be inflated, what is wrong)."""
    inflate, parts, end = zlib.decompressobj(31), [], at
    while not inflate.eof and end < len(data):
        step = data[end:end + 65_536]
        try:
            parts.append(inflate.decompress(step))
        except zlib.error as error:
            return end + len(step), b"".join([*parts, _before_error(data, at, end, step)]), f"member does not inflate: {error}"
        end = min(end + 65_536, len(data)) - len(inflate.unused_data)
    return end, b"".join(parts), "" if inflate.eof else "member is cut off"


def _before_error(data: bytes, at: int, end: int, step: bytes) -> bytes:
    """What ``step`` gives up to its error; zlib drops the output of a call that fails."""
    inflate, parts = zlib.decompressobj(31), []
    for k in range(at, end, 65_536):
        inflate.decompress(data[k:k + 65_536])
    while len(step) > 1:
        before, half = inflate.copy(), len(step) // 2
        try:
            parts.append(inflate.decompress(step[:half]))
            step = step[half:]
        except zlib.error:
            inflate, step = before, step[:half]
    return b"".join(parts)


def _member(data: bytes, at: int) -> tuple[int, list[dict]]:
    """Records and gaps of the gzip member at ``at``, with its place, and where it ends."""
    end, content, wrong = _inflated(data, at)
    found = list(_salvage(content))
    if wrong:
        raise Damage(wrong, saved=[r for r in found if r["kind"] == "record"], reach=end)
    for row in found:
        if row["kind"] == "gap":
            row["reason"] = f"in member, {row['length']} bytes at {row['offset']}: {row['reason']}"
        row["offset"], row["length"] = at, end - at
    return end, found


def parse(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive, in order."""
    at, bad, reason = 0, None, ""
    saved: list[dict] = []  # records of damaged members in the open gap
    given, reach = Counter(), 0  # the same, until the bytes they came from are passed
    key = lambda r: (r["record_id"], r["payload_digest"], r["payload"])

    def gap(to: int) -> Iterator[dict]:
        for record in saved:
            yield {**record, "length": to - record["offset"]}
        saved.clear()
        yield {"kind": "gap", "offset": bad, "length": to - bad, "reason": reason}

    while at < len(data):
        skipped = _BLANK.match(data, at) if bad is None else None
        if skipped:
            at = skipped.end()
            continue
        if at >= reach:
            given.clear()
        try:
            if data.startswith(MEMBER, at):
                end, found = _member(data, at)
            else:
                end, record = _record(data, at)
                found = [{"kind": "record", "offset": at, "length": end - at, **record}]
        except Damage as damage:
            if bad is None:
                bad, reason = at, damage.reason
            for record in damage.saved:
                if at < reach and given[key(record)] > 0:
                    given[key(record)] -= 1
                    continue
                saved.append({**record, "offset": at})
            if damage.saved:
                given, reach = given + Counter(map(key, damage.saved)), max(reach, damage.reach)
            start = None if damage.end else _START.search(data, at + 1)
            at = damage.end or (start.start() if start else len(data))
            if damage.end:  # this record only
                yield from gap(at)
                bad = None
            continue
        fresh = []
        for row in found:
            # The bytes of a damaged member are searched again, and stored blocks show their records a second time.
            if row["kind"] == "record" and given[key(row)] > 0:
                given[key(row)] -= 1
            else:
                fresh.append(row)
        if found and not fresh:
            if bad is None:
                bad, reason = at, "records of a damaged member"
        else:
            if bad is not None:
                yield from gap(at)
                bad = None
            yield from fresh
        at = end
    if bad is not None:
        yield from gap(len(data))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives below ``path``; see ``SCHEMA``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def salvage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for row in parse(data.as_py()):
                    rows.append({"path": name, **row})
                    size += len(row.get("payload") or b"")
                    if size > ARCHIVE_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return files.mapInArrow(salvage, SCHEMA)


def row_ids(records: DataFrame, **columns: str) -> DataFrame:
    """Adds columns with the row ids that record ids carry: ``new_name="record_id"``."""
    names = list(columns)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [pa.array([row_id(x) for x in batch.column(columns[n]).to_pylist()], pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *ids], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)
    return records.mapInArrow(decode, schema + "".join(f", {n} long" for n in names))
