"""WARC archives: write pages as records, read records back, reassemble segmented ones.

Writing: equal payloads are stored once. The page with the smallest id has the ``response`` record, the others have ``revisit``
records that point to it. A response's HTTP body is framed in chunks (``Transfer-Encoding: chunked``). A record block longer than
``segment_bytes`` is cut: the first part stays in the response (segment 1), the rest follows in ``continuation``
records that name their origin, and the last one states the total length. Each record is a gzip member of its own.

Reading: continuation records are grouped by origin, ordered by segment number, checked for gaps and for the total length,
joined, and the chunk framing is decoded. A record that fails a check is returned with ``error`` set and no payload. What is
no WARC record, or can't be unpacked, is a row with only the file's path (as ``record_id``) and ``error``: a member that is no record costs that
member, a file that is cut short or no archive costs the rest of that file, and a file with fewer members than its manifest says is reported too.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.textcols import slices
from linkloom.session import stored

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
PAGE_URN = "urn:linkloom:page:"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 16  # each record's member leaves the rest of what was read, which is copied
BATCH_BYTES = 1 << 20

MANIFEST = "path string, n_records long, n_bytes long"
SEGMENT = "record_id string, record_type string, url string, refers_to string, digest string, number int, total long, block binary"
PAYLOAD = "record_id string, record_type string, url string, refers_to string, digest string, payload binary, error string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP/1.1 chunk framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunk-framed body; raises ValueError if the framing is broken. Chunk extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is missing")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response with its transfer framing removed."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("HTTP header doesn't end")
    head, body = block[:end].lower(), block[end + 4 :]
    framed = any(line.startswith(b"transfer-encoding:") and b"chunked" in line for line in head.split(b"\r\n")[1:])
    return unchunked(body) if framed else body


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with a record."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    raw = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _header_value(text: str | None) -> str:
    return "".join(c if c not in "\r\n" else f"%{ord(c):02X}" for c in text or "")


def page_records(page_id: int, url: str | None, payload: bytes, first: int, segment_bytes: int) -> Iterator[bytes]:
    """The records of a page: a revisit, or a response and its continuations."""
    name = f"<{PAGE_URN}{page_id}>"
    common = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", _header_value(url)), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")]
    kind = [("Content-Type", "application/http; msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if first != page_id:
        refer = [("WARC-Refers-To", f"<{PAGE_URN}{first}>"), ("WARC-Profile", REVISIT_PROFILE)]
        yield record([("WARC-Type", "revisit"), *common, *refer, *kind], head)
        return
    block = head + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *common, *kind], block)
        return
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield record([("WARC-Type", "response"), *common, *kind, ("WARC-Segment-Number", "1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        own = [("WARC-Record-ID", f"<{PAGE_URN}{page_id}:segment:{n}>"), ("WARC-Date", DATE), ("WARC-Target-URI", _header_value(url))]
        yield record([("WARC-Type", "continuation"), *own, ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n)), *last], part)


def members(path: str) -> Iterator[bytes]:
    """The gzip members of a file, one at a time. Raises ValueError or zlib.error where the file is cut short or no gzip file."""
    store, where = arrow_fs.FileSystem.from_uri(path)
    with store.open_input_stream(where, compression=None) as f:
        rest, unpack, out = b"", zlib.decompressobj(31), []
        while True:
            data = rest or f.read(READ_BYTES)
            if not data:
                break
            out.append(unpack.decompress(data))
            rest = unpack.unused_data
            if unpack.eof:
                yield b"".join(out)
                unpack, out = zlib.decompressobj(31), []
        if out:
            raise ValueError(f"{path} ends inside a record")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record. Raises ValueError if it is none."""
    end = raw.find(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if end < 0 or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    if missing := {"content-length", "warc-type", "warc-record-id"} - headers.keys():
        raise ValueError(f"record has no {min(missing)}")
    block = raw[end + 4 : end + 4 + int(headers["content-length"])]
    if len(block) != int(headers["content-length"]):
        raise ValueError("record is cut short")
    return headers, block


def write_archives(pages: DataFrame, folder: str, *, segment_bytes: int = SEGMENT_BYTES, min_revisit: int = 0) -> DataFrame:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as gzip-compressed WARC files below ``folder``, one a task; returns the
    stored manifest of the files.

    A null html is an empty payload; payloads below ``min_revisit`` bytes are responses always. Rows that repeat an id count
    once (of different texts, that with the smallest digest), rows without one are left out. The page text moves once, by (id, digest), so a
    payload that many pages share is no hot key; which page comes first is settled on ids and digests alone. A task that
    runs again writes a file of its own, and only the attempt that succeeded is in the manifest.
    """
    rows = pages.where("page_id is not null").select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    small = F.octet_length("html") < min_revisit
    one = rows.select("page_id", "sha", small.alias("small")).groupBy("page_id").agg(F.min(F.struct("sha", "small")).alias("s")).select("page_id", "s.*")
    # Grouped by one column more than the join: both sides are shuffled for it, and AQE can split a hot digest.
    first = one.groupBy("sha", F.substring("sha", 1, 2).alias("_apart")).agg(F.min("page_id").alias("first")).drop("_apart")
    placed = one.join(first, "sha").select("page_id", "sha", F.when(F.col("small"), F.col("page_id")).otherwise(F.col("first")).alias("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        name, out, n, size = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in slices(batches, "html"):
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            for row in batch.to_pylist():
                for raw in page_records(row["page_id"], row["url"], row["html"].encode(), row["first"], segment_bytes):
                    out.write(raw)
                    n, size = n + 1, size + len(raw)
        if out is not None:
            out.close()
            yield pa.record_batch({"path": [f"{folder.rstrip('/')}/{name}"], "n_records": [n], "n_bytes": [size]})

    joined = rows.join(placed, ["page_id", "sha"]).dropDuplicates(["page_id", "sha"]).select("page_id", "url", "html", "first")
    return stored(joined.mapInArrow(write, MANIFEST), "warc-manifest")[0]


def _arrow(columns: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])


_READ, _RESULT = _arrow(SEGMENT), _arrow(PAYLOAD)


def file_records(path: str, n_records: int | None) -> Iterator[dict]:
    """The records of a file; what can't be read as one has only ``record_id`` (the path) and ``error``."""
    seen = 0
    try:
        for raw in members(path):
            seen += 1
            try:
                headers, block = parsed(raw)
                yield {
                    "record_id": headers.get("warc-segment-origin-id", headers["warc-record-id"]).strip("<>"),
                    "record_type": headers["warc-type"],
                    "url": headers.get("warc-target-uri"),
                    "refers_to": headers.get("warc-refers-to", "").strip("<>") or None,
                    "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                    "number": int(headers["warc-segment-number"]) if "warc-segment-number" in headers else None,
                    "total": int(headers["warc-segment-total-length"]) if "warc-segment-total-length" in headers else None,
                    "block": block,
                }
            except ValueError as e:
                yield {"record_id": path, "error": f"member {seen}: {e}"}
    except (ValueError, zlib.error) as e:
        yield {"record_id": path, "error": f"after {seen} members: {e}"}
    else:
        if seen < (n_records or 0):
            yield {"record_id": path, "error": f"{seen} members instead of {n_records}"}


def decoded(row: dict) -> dict:
    """A whole record with its payload in place of its block; only responses have one."""
    payload, error = None, row.get("error")
    if error is None and row["record_type"] == "response":
        try:
            payload = http_payload(row["block"])
            if row["digest"] is not None and sha1_base32(payload) != row["digest"]:
                payload, error = None, "payload digest differs"
        except ValueError as e:
            error = str(e)
    kept = {k: row.get(k) for k in ("record_id", "record_type", "url", "refers_to", "digest")}
    return {**kept, "payload": payload, "error": error}


def _in_batches(rows: Iterator[dict], field: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get(field) or b"")
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _stored_records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for path, n in zip(*(batch.column(c).to_pylist() for c in ("path", "n_records"))):
            for row in file_records(path, n):
                if "error" in row or row["record_type"] in ("response", "revisit", "continuation"):
                    yield row


def _files(manifest: DataFrame) -> DataFrame:
    return manifest.select("path", "n_records").repartition(max(1, manifest.count()))


def read_whole(manifest: DataFrame) -> DataFrame:
    """Records that are no segments, decoded where they are read, and what could not be read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (decoded(r) for r in _stored_records(batches) if r.get("number") is None)
        yield from _in_batches(rows, "payload", _RESULT)

    return _files(manifest).mapInArrow(read, PAYLOAD)


def read_segments(manifest: DataFrame) -> DataFrame:
    """Records that are segments of a longer one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches((r for r in _stored_records(batches) if r.get("number") is not None), "block", _READ)

    return _files(manifest).mapInArrow(read, SEGMENT)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "block"):
        yield from _in_batches(map(decoded, batch.to_pylist()), "payload", _RESULT)


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per response or revisit of the archives, segmented ones reassembled. A revisit has no payload of its own.

    Parts of one record meet by its id, so what is gathered is one record's block. Parts that occur twice count once.
    """
    parts = read_segments(manifest)
    once = parts.groupBy("record_id", "number").agg(
        *(F.max(k).alias(k) for k in ("url", "digest", "total")), F.min_by("record_type", F.when(F.col("number") == 1, 0).otherwise(1)).alias("record_type"), F.first("block").alias("block")
    )
    gathered = once.groupBy("record_id").agg(
        F.expr("listagg(block) within group (order by number)").alias("block"),  # in time linear in the block
        *(F.max(k).alias(k) for k in ("url", "digest", "total")),
        F.max(F.when(F.col("number") == 1, F.col("record_type"))).alias("record_type"),
        F.min("number").alias("low"), F.max("number").alias("high"), F.count("*").alias("n"),
    )
    error = (
        F.when((F.col("low") != 1) | (F.col("high") != F.col("n")), F.lit("a segment is missing"))
        .when(F.col("total").isNull(), F.lit("the last segment is missing"))
        .when(F.octet_length("block") != F.col("total"), F.lit("total length differs"))
    )
    joined = gathered.select(
        "record_id", F.coalesce("record_type", F.lit("response")).alias("record_type"), "url", F.lit(None).cast("string").alias("refers_to"), "digest",
        "block", error.alias("error"),
    )
    return read_whole(manifest).unionByName(joined.mapInArrow(_payloads, PAYLOAD))
