"""WARC archives of pages: written with an index first, read by ranges of bytes.

Pages with equal payloads (of ``min_bytes`` or more) have one response record,
that of the smallest page id, and revisit records that refer to it. Digests
are grouped with partial aggregation and only groups of two or more are joined
back, so a payload that a third of all pages share costs one row per task.

Each task writes its pages, sorted by id, to archives of at most about
``FILE_BYTES``, one gzip member a record. The index, a Parquet table, has file,
offset, length, page id, URL, digest and type of each record. Reading takes any
selection of the index: the rows are dealt by file and offset, and records
that lie near each other are fetched by one read.

Defined cases: a null html is an empty payload; a null url is written as
``urn:page:<id>`` and read back as null; control characters in a URL are
percent-encoded in the header; rows that repeat the smallest page id with the
same payload are all responses; null page ids come last; an empty table gives
no archive and an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.scratch import Scratch, parallelism, ship_package
from transitlens.llm.shared_files import new_file, open_fs

FILE_BYTES = 256 << 20   # an archive is closed beyond this
GAP_BYTES = 64 << 10     # records this far apart are still fetched by one read
READ_BYTES = 8 << 20     # a read is not extended beyond this
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("payload_digest", pa.string()), ("record_type", pa.string())])


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _headers(pairs: list[tuple[str, str]], first: str) -> bytes:
    return "\r\n".join([first, *[f"{k}: {v}" for k, v in pairs], "", ""]).encode()


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """One record, compressed, and its payload digest; a revisit has the HTTP headers but no payload."""
    name = digest(payload)
    http = _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
                    "HTTP/1.1 200 OK")
    block = http if refers_to is not None else http + payload
    uri = f"urn:page:{page_id}" if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{name}"),
            ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(_headers(head, "WARC/1.1") + block + b"\r\n\r\n") + z.flush(), name


def parse_record(member: bytes) -> dict:
    """The fields of one compressed record, its block checked against the digests."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or f"sha1:{digest(block)}" != h["WARC-Block-Digest"]:
        raise ValueError(f"broken record {h.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    name = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if h["WARC-Type"] == "response" and digest(payload) != name:
        raise ValueError(f"broken payload {h['WARC-Record-ID']}")
    number = lambda k: int(h[k]) if k in h else None
    uri = h["WARC-Target-URI"]
    return {"page_id": number("X-Page-ID"), "url": None if uri.startswith("urn:page:") else uri,
            "payload_bytes": int(inner["Content-Length"]), "payload_digest": name, "record_type": h["WARC-Type"],
            "refers_to": number("X-Refers-To-Page-ID"),
            "payload": payload if h["WARC-Type"] == "response" else None}


def with_referred(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the smallest page id with the same payload, null where it is the row's own."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("key", F.sha2(F.encode("html", "UTF-8"), 256))
    keys = p.filter(F.octet_length("html") >= min_bytes).select("page_id", "key")
    groups = keys.groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    revisits = keys.join(groups.filter("n > 1 and first is not null"), "key") \
        .filter(~F.col("page_id").eqNullSafe(F.col("first"))) \
        .select(F.col("page_id").alias("__id"), F.col("key").alias("__key"), "first").distinct()
    # the payloads are shuffled by page id, which is even, never by digest
    return p.join(revisits, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left") \
        .select("page_id", "url", "html", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in ``folder`` and return the index."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, at = None, None, 0
        for batch in batches:
            rows = []
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    uri, at = new_file(folder, ".warc.gz"), 0
                    f, p = open_fs(uri)
                    out = f.open_output_stream(p, compression=None)
                raw, name = build_record(r[0], r[1], r[2].encode(), r[3])
                out.write(raw)
                rows.append((uri, at, len(raw), r[0], r[1], name, "response" if r[3] is None else "revisit"))
                at += len(raw)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)
        if out is not None:
            out.close()

    ship_package(pages.sparkSession)
    rows = with_referred(pages, min_bytes).sortWithinPartitions(F.col("page_id").asc_nulls_last())
    index = rows.mapInArrow(write, "file string, offset long, length long, page_id long, url string, "
                                   "payload_digest string, record_type string")
    return scratch.write(index, "index")


def fetch(file, ranges: list[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes of sorted (offset, length) ranges of one open file, near ones by one read."""
    i = 0
    while i < len(ranges):
        start, end, j = ranges[i][0], ranges[i][0] + ranges[i][1], i + 1
        while j < len(ranges) and ranges[j][0] - end <= GAP_BYTES and ranges[j][0] + ranges[j][1] - start <= READ_BYTES:
            end, j = max(end, ranges[j][0] + ranges[j][1]), j + 1
        raw = memoryview(file.read_at(end - start, start))
        for offset, length in ranges[i:j]:
            yield bytes(raw[offset - start:offset - start + length])
        i = j


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the rows of an index name: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, where asked for, the payload of responses."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file = None, None
        for batch in batches:
            names = batch.column("file").to_pylist()
            ranges = list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist()))
            a = 0
            while a < len(names):
                b = a
                while b < len(names) and names[b] == names[a] and b - a < 500:
                    b += 1
                if names[a] != uri:
                    if file is not None:
                        file.close()
                    uri = names[a]
                    f, p = open_fs(uri)
                    file = f.open_input_file(p)
                rows = [parse_record(x) for x in fetch(file, ranges[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields], schema=schema)
                a = b
        if file is not None:
            file.close()

    ship_package(index.sparkSession)
    rows = index.select("file", "offset", "length").repartitionByRange(
        parallelism(index.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long" + ", payload binary" * payloads)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages under the checkpoint folder and read every record back by its place in the index."""
    scratch = Scratch(pages.sparkSession, "warc")
    index = write_archives(pages, scratch.path("archives"), scratch, min_bytes)
    return read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
