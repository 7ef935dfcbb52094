"""Zstandard WARC archives: a writer, and a reader that trusts nothing it has not checked.

An archive is a leading skippable frame that holds a dictionary and then one frame per record. The reader loads the
dictionary, decodes frame after frame, and checks version, mandatory fields, block length, closing line ends and
payload digest of each record; what fails is returned with the error it made, and the reader goes on where it can.

Archives travel as rows (archive, content) with some MB each, as ``spark.read.format("binaryFile")`` also gives them,
because only Spark's readers and writers reach a cluster's shared storage.

Results for odd input: a null or empty page has an empty payload; a null url is written as ``urn:none``; a page
without an id revisits an equal page that has one and is itself never referred to; equal rows with the largest id are
all responses; no pages give no archives and no rows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, shared_dir, staged

MIN_REVISIT = 1000
#: Bytes of records in one archive, and of samples for its dictionary.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 4 << 20, 256 << 10, 16 << 10
DICTIONARY_FRAME = 0x184D2A5D
MANDATORY = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")
ARCHIVED = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record: the whole response, or for a revisit its HTTP headers alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {ARCHIVED}"]
    head += [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._') if url else 'urn:none'}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes], level: int = 3) -> bytes:
    import zstandard as z

    samples, size = [], 0
    for r in records:
        samples.append(r[:8192])
        size += len(samples[-1])
        if size > SAMPLE_BYTES:
            break
    try:
        dictionary = z.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except z.ZstdError:  # too few samples: the first record's start is the dictionary
        dictionary = records[0][:DICTIONARY_BYTES]
    c = z.ZstdCompressor(level=level, dict_data=z.ZstdCompressionDict(dictionary), write_checksum=True)
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary + b"".join(map(c.compress, records))


def frames(content: bytes) -> Iterator[tuple[bytes | None, str | None]]:
    """(data, error) of every frame after the dictionary's."""
    import zstandard as z

    if len(content) < 8 or struct.unpack_from("<I", content)[0] != DICTIONARY_FRAME:
        yield None, "no dictionary frame"
        return
    size = struct.unpack_from("<I", content, 4)[0]
    if 8 + size > len(content):
        yield None, "dictionary frame is cut off"
        return
    dictionary = content[8 : 8 + size]
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
        dictionary = z.ZstdDecompressor().decompressobj().decompress(dictionary)
    d = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(dictionary)) if dictionary else z.ZstdDecompressor()
    at, view = 8 + size, memoryview(content)
    while at < len(content):
        if at + 8 <= len(content) and 0x184D2A50 <= struct.unpack_from("<I", content, at)[0] <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            continue
        one, out = d.decompressobj(), []
        try:
            while not one.eof and at < len(content):
                chunk = view[at : at + 65_536]
                out.append(one.decompress(chunk))
                at += len(chunk) - len(one.unused_data)
        except z.ZstdError as e:
            yield None, f"bad frame: {e}"
            return
        yield (b"".join(out), None) if one.eof else (None, "frame is cut off")


def checked(data: bytes) -> dict:
    """The fields of one record, with ``error`` set if anything in it is wrong."""
    out: dict = {"error": None}
    end = data.find(b"\r\n\r\n")
    lines = data[: max(end, 0)].split(b"\r\n")
    if end < 0 or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return out | {"error": "no WARC header"}
    fields: dict[bytes, bytes] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return out | {"error": "header line without a colon"}
        fields.setdefault(name.strip().lower(), value.strip())
    out |= {"record_id": fields.get(b"warc-record-id", b"").decode("utf-8", "replace"), "type": fields.get(b"warc-type", b"").decode("utf-8", "replace"), "uri": fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), "refers_to": fields[b"warc-refers-to"].decode("utf-8", "replace") if b"warc-refers-to" in fields else None}
    if missing := [m for m in MANDATORY if not fields.get(m)]:
        return out | {"error": f"no {missing[0].decode()}"}
    if not fields[b"content-length"].isdigit():
        return out | {"error": "content-length is no number"}
    size, block = int(fields[b"content-length"]), data[end + 4 :]
    if len(block) != size + 4 or block[size:] != b"\r\n\r\n":
        return out | {"error": "content-length is wrong"}
    http, gap, payload = block[:size].partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
    if not gap or not stated:
        return out | {"error": "no HTTP header"}
    digest = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:")
    try:
        digest = base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower()
    except ValueError:
        return out | {"error": "payload digest is unreadable"}
    out |= {"payload_bytes": int(stated[1]), "payload_digest": digest, "payload": None}
    if out["type"] == "revisit":
        return out | ({"error": "revisit has a payload"} if payload else {} if out["refers_to"] else {"error": "revisit of nothing"})
    if len(payload) != out["payload_bytes"]:
        return out | {"error": "payload length is wrong"}
    if hashlib.sha1(payload).hexdigest() != digest:
        return out | {"error": "payload digest is wrong"}
    return out | {"payload": payload}


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, k = [], 0, TaskContext.get().partitionId() << 33

    def full() -> pa.RecordBatch:
        nonlocal k, size
        out = pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([archive(held)], pa.binary())], names=["archive", "content"])
        k, size = k + 1, 0
        held.clear()
        return out

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to", "revisit")), strict=True):
            held.append(record(*row))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield full()
    if held:
        yield full()


def _reader(with_payload: bool):
    columns = {"record_id": pa.string(), "type": pa.string(), "uri": pa.string(), "refers_to": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "error": pa.string()} | ({"payload": pa.binary()} if with_payload else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [{"error": error} if data is None else checked(data) for data, error in frames(content.as_py() or b"")]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in columns.items()], names=list(columns))

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(archive, content): archives with one record per page. Pages with equal payloads of ``min_revisit`` bytes or more revisit that with the largest id."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    same = p.where(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL").drop("n")
    p = p.join(broadcast_if_small(staged(same, "equal-payloads")), "digest", "left").withColumn("revisit", F.coalesce(~F.col("id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull(), F.lit(False)))
    return p.select("id", "url", "payload", "digest", "refers_to", "revisit").mapInArrow(_writer, "archive long, content binary")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the column ``content``; ``error`` is null for records in which everything was right."""
    return archives.select("content").mapInArrow(_reader(with_payload), "record_id string, type string, uri string, refers_to string, payload_bytes long, payload_digest string, error string" + (", payload binary" if with_payload else ""))


def op7_zstd_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    shared_dir(spark)
    records = read_archives(staged(write_archives(pages), "archives"))
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1) AS bigint)")
    right = F.when(F.col("error").isNull(), F.col("record_id")).otherwise(F.raise_error(F.concat(F.lit("bad record: "), F.coalesce("error", F.lit("")))))
    return records.withColumn("record_id", right).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM t
"""
