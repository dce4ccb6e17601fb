"""Web archives: writing pages as WARC records, and reading them back whole.

Records whose block is longer than a segment are written as a first record and continuation records (type
``continuation``, with the first one's id as ``WARC-Segment-Origin-ID``, their number, and on the last one the
total length). Bodies are framed as chunked transfer coding, and segments cut through that framing wherever they
end, so a payload can be had only from a whole record. The reader groups continuations by origin, orders them by
number, checks that none is missing and that the lengths add up to the total, and then decodes the chunks.

Pages with equal payloads are stored once: the page with the smallest id is a ``response``, the others are
``revisit`` records that name it by its record id and digest.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, stored
from tidemark.session import scratch_path
from tidemark.sources.archives import open_filesystem

SEGMENT_BYTES = 32 << 10
FILE_BYTES = 256 << 20
CHUNK_BYTES = 8 << 10
BATCH_BYTES = 8 << 20
READ_BYTES = 64 << 10
REVISIT_FROM = 100
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer coding."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer coding; ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line_end = body.find(b"\r\n", at)
        if line_end < 0:
            raise ValueError("no chunk size")
        size = int(body[at:line_end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = line_end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        parts.append(body[line_end + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response: its body without headers and transfer coding."""
    head, _, body = block.partition(b"\r\n\r\n")
    coded = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n")[1:])
    return unchunked(body) if coded else body


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page} {digest}')}>"


def record(headers: dict[str, object], block: bytes) -> bytes:
    lines = [f"{k}: {' '.join(str(v).split())}" for k, v in headers.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def page_records(
    page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment_bytes: int
) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or the first segment of a response and its continuations."""
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page, digest),
        "WARC-Date": _DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "Page-Key": page,
    }
    if refers_to is not None:
        extra = {"WARC-Profile": _PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "Refers-To-Page-Key": refers_to}
        yield record(headers | extra, b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = _HTTP + chunked(payload)
    if len(block) <= segment_bytes:
        yield record(headers, block)
        return
    yield record(headers | {"WARC-Segment-Number": 1}, block[:segment_bytes])
    places = range(segment_bytes, len(block), segment_bytes)
    for number, at in enumerate(places, 2):
        more = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": record_id(page, f"{digest}/{number}"),
            "WARC-Date": _DATE,
            "WARC-Target-URI": url,
            "WARC-Segment-Origin-ID": headers["WARC-Record-ID"],
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if number == len(places) + 1 else None,
        }
        yield record(more, block[at : at + segment_bytes])


def write_pages(
    pages: DataFrame,
    folder: str | None = None,
    *,
    page: str = "page_id",
    url: str = "url",
    html: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """All pages as gzipped WARC files (a member per record); a stored row ``path, records, bytes`` for each file.

    Payloads of at least 100 bytes that occur again become revisits of the page with the smallest id. NULL html is
    an empty payload. Rows that repeat the smallest id with the same payload are responses too; rows without an id
    revisit if any row of the payload has one and are responses otherwise. Only digests and ids are grouped, map
    side first, so a payload that a third of the pages share is one row of the join. No pages: no files.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    picked = pages.select(F.col(page).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    keyed = picked.withColumn("digest", F.sha2("payload", 256))
    groups = keyed.where(F.octet_length("payload") >= REVISIT_FROM).groupBy("digest")
    shared = groups.agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    shared = shared.select(F.col("digest").alias("shared_digest"), "first")
    joined = keyed.join(shared, F.col("digest") == F.col("shared_digest"), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    rows = joined.select("page", "url", "payload", "digest", refers.alias("refers_to"))

    def write(batches: Batches) -> Batches:
        part, number, out, size, records, done = TaskContext.get().partitionId(), 0, None, 0, 0, []
        filesystem, root = open_filesystem(folder)
        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    name = f"pages-{part:06d}-{number:04d}-{uuid.uuid4().hex}.warc.gz"
                    filesystem.create_dir(root, recursive=True)
                    out, size, records = filesystem.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                for one in page_records(*values, segment_bytes):
                    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = squeeze.compress(one) + squeeze.flush()
                    out.write(member)
                    size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", records, size))
                    number, out = number + 1, None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["path", "records", "bytes"])

    return stored(rows.mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-files")


def members(stream, path: str) -> Iterator[bytes]:
    """The records of a WARC file, gzipped by record or plain, one by one."""
    held = stream.read(READ_BYTES)
    if held[:2] != b"\x1f\x8b":
        yield from _plain_records(held, stream, path)
        return
    while held:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not held:
                raise ValueError(f"{path} ends within a record")
            parts.append(inflate.decompress(held))
            held = inflate.unused_data if inflate.eof else stream.read(READ_BYTES)
        yield b"".join(parts)
        held = held or stream.read(READ_BYTES)


def _plain_records(held: bytes, stream, path: str) -> Iterator[bytes]:
    while held.strip() or (held := stream.read(READ_BYTES)):
        while (end := held.find(b"\r\n\r\n")) < 0 or len(held) < end + 8 + _length(held[:end]):
            more = stream.read(READ_BYTES)
            if not more:
                raise ValueError(f"{path} ends within a record")
            held += more
        whole = end + 8 + _length(held[:end])
        yield held[:whole]
        held = held[whole:]


def _length(head: bytes) -> int:
    return next(int(x[15:]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))


_FIELDS = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("url", pa.string()),
        ("page", pa.int64()),
        ("refers_to", pa.int64()),
        ("header_digest", pa.string()),
        ("origin", pa.string()),
        ("segment", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
    ]
)


def parse(raw: bytes) -> tuple:
    """The fields of one record in the order of ``_FIELDS``."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    pairs = (x.partition(b":") for x in head.split(b"\r\n")[1:])
    of = {k.lower().decode(): v.strip().decode() for k, _, v in pairs}
    number = lambda k: int(of[k]) if k in of else None
    return (
        of.get("warc-type"),
        of.get("warc-record-id"),
        of.get("warc-target-uri"),
        number("page-key"),
        number("refers-to-page-key"),
        of.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        of.get("warc-segment-origin-id"),
        number("warc-segment-number"),
        number("warc-segment-total-length"),
        rest[: int(of["content-length"])],
    )


def _read(segmented: bool):
    """Reads the files of a batch and keeps the records that are parts of longer ones, or the others."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, name = open_filesystem(path)
                with filesystem.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for raw in members(stream, path):
                        if (b"\r\nWARC-Segment-Number:" in raw[: raw.find(b"\r\n\r\n")]) == segmented:
                            rows.append(parse(raw))
                            size += len(raw)
                        if size >= BATCH_BYTES:
                            yield _record_batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _record_batch(rows)

    return run


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)


def _payloads(batches: Batches) -> Batches:
    """Joins a record's segments, checks them, and decodes the payload. What is broken or missing is marked."""
    for batch in batches:
        payloads, sound = [], []
        more, totals = batch.column("more").to_pylist(), batch.column("whole").to_pylist()
        numbers, kinds = batch.column("segment").to_pylist(), batch.column("record_type").to_pylist()
        for block, number, rest, total, kind in zip(batch.column("block").to_pylist(), numbers, more, totals, kinds):
            payload, good = None, kind == "revisit"
            if kind == "response":
                rest = sorted(rest or [], key=lambda x: x["segment"])
                whole = b"".join([block, *(x["block"] for x in rest)])
                in_turn = [x["segment"] for x in rest] == list(range(2, len(rest) + 2))
                if in_turn and (number is None or (number == 1 and total == len(whole))):
                    try:
                        payload, good = payload_of(whole), True
                    except ValueError:
                        pass
            payloads.append(payload)
            sound.append(good)
        keep = [batch.column(c) for c in ("record_type", "record_id", "url", "page", "refers_to", "header_digest")]
        yield pa.RecordBatch.from_arrays(
            [*keep, pa.array(payloads, pa.binary()), pa.array(sound)],
            names=["record_type", "record_id", "url", "page_id", "refers_to", "header_digest", "payload", "sound"],
        )


def read_pages(files: DataFrame) -> DataFrame:
    """``record_type, record_id, url, page_id, refers_to, header_digest, payload, sound`` of all pages in the files.

    Revisits have no payload of their own. ``sound`` is false, and the payload NULL, where a segment is missing or
    doubled, the lengths do not add up, or the chunk framing is broken. A continuation without its first record
    yields no row. Only continuations and the first segments they belong to are shuffled.
    """
    count, fields = max(1, files.count()), ", ".join(f"{f.name} {_SPARK[f.type]}" for f in _FIELDS)
    paths = files.select("path").repartition(count)
    first, later = F.col("record_type").isin("response", "revisit"), F.col("record_type") == "continuation"
    single = paths.mapInArrow(_read(False), fields).where(first)
    single = single.withColumn("more", F.lit(None).cast("array<struct<segment:bigint,block:binary>>")).withColumn("whole", F.col("total"))
    parts = paths.mapInArrow(_read(True), fields).groupBy(F.coalesce("origin", "record_id").alias("of"))
    parts = parts.agg(
        F.collect_list(F.when(first, F.struct(*_FIELDS.names))).alias("firsts"),
        F.collect_set(F.when(later, F.struct("segment", "block"))).alias("more"),
        F.max("total").alias("whole"),
    )
    joined = parts.select(F.explode("firsts").alias("one"), "more", "whole").select("one.*", "more", "whole")
    return single.unionByName(joined).mapInArrow(
        _payloads,
        "record_type string, record_id string, url string, page_id bigint, refers_to bigint, header_digest string, "
        "payload binary, sound boolean",
    )


_SPARK = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}


def digests(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``, revisits filled in from what they refer to."""
    own = pages.select(
        "page_id",
        F.octet_length("payload").cast("bigint").alias("bytes"),
        F.coalesce(F.sha2("payload", 256), F.col("header_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    own = stored(own, "warc-pages")
    targets = own.where("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.max("bytes").alias("there"))
    targets = targets.select(F.col("page_id").alias("to_page"), F.col("payload_digest").alias("to_digest"), "there")
    same = (F.col("refers_to") == F.col("to_page")) & (F.col("payload_digest") == F.col("to_digest"))
    return own.join(targets, same, "left").select(
        "page_id", F.coalesce("bytes", "there").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
