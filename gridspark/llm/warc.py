"""WARC archives: writing captures and assembling transactions.

``write_archives`` writes each page as three records -- request, response (or
revisit of an equal payload) and metadata -- tied together by
WARC-Concurrent-To; ``read_records`` parses archives into one row a record;
``assemble`` joins the records of a transaction through those identifiers
into one nested row a capture.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.sources.files import shared_uri

from .common import filesystem, run_dir, small_or_shuffled, stage

#: An archive file is closed once it holds this many bytes.
FILE_BYTES = 64 << 20
#: Payloads below this many bytes are always stored.
MIN_REVISIT = 1000
GZIP_LEVEL = 3
READ_BYTES = 1 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- records ---------------------------------------------------------------

def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One gzip member that holds the record; headers of None are left out."""
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in [*headers, ("Content-Length", str(len(block)))] if v is not None)
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(VERSION + b"\r\n" + head + b"\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    rest = b""
    while rest or (rest := stream.read(READ_BYTES)):
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if not rest and not (rest := stream.read(READ_BYTES)):
                raise ValueError("the archive ends within a record")
            parts.append(z.decompress(rest))
            rest = z.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(headers.get("content-length", len(rest)))
    if not lines[0].startswith("WARC/") or len(rest) < n:
        raise ValueError("not a whole WARC record")
    return headers, rest[:n]


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(repr(parts).encode()).digest()[:16])}>"


def _control(url: str) -> str:
    """The URL with control characters percent-encoded, so that it stays one header line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def capture(key: object, row_id: int, url: str | None, payload: bytes, digest: str,
            refers: tuple[object, int] | None, date: str) -> bytes:
    """The three records of a capture; ``refers`` is the (key, row id) of the response it revisits."""
    b32 = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    main, uri = _urn("capture", key, row_id), None if url is None else _control(url)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    common = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    out = [record([("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", key, row_id)), *common,
                   ("WARC-Concurrent-To", main), ("Content-Type", "application/http; msgtype=request")],
                  f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode())]
    head = [("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", b32),
            ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        out.append(record([("WARC-Type", "response"), *head], http + payload))
    else:
        out.append(record([("WARC-Type", "revisit"), *head, ("WARC-Profile", PROFILE),
                           ("WARC-Refers-To", _urn("capture", *refers))], http))
    out.append(record([("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", key, row_id)), *common,
                       ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")],
                      b"" if key is None else f"page-id: {key}\r\n".encode()))
    return b"".join(out)


# ---- writing -----------------------------------------------------------------

def _write(root: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        fs, folder = filesystem(root)
        fs.create_dir(folder, recursive=True)
        done, out, n, size = [], None, 0, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("key", "rid", "url", "payload", "digest", "to_key", "to_rid")]
            for values in zip(*columns):
                key, rid, url, payload, digest, to_key, to_rid = (v.as_py() for v in values)
                if out is None:
                    name = f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{len(done):05d}.warc.gz"
                    out, n, size = fs.open_output_stream(f"{folder}/{name}", compression=None), 0, 0
                raw = capture(key, rid, url, payload, digest, None if to_rid is None else (to_key, to_rid), date)
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    done.append((name, n, size))
        if out is not None:
            out.close()
            done.append((name, n, size))
        cols = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
                                         ["file", "n_captures", "n_bytes"])
    return run


def write_archives(pages: DataFrame, id_col: str, url_col: str, html_col: str, root: str | None = None,
                   min_revisit: int = MIN_REVISIT, date: str = "2024-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write ``pages`` as WARC files in the shared folder; (folder, manifest of the files that count).

    The payload is the html in UTF-8, null as empty.  Of the rows with equal
    payloads of ``min_revisit`` bytes or more the one with the largest id is
    the response (of rows with that id the last in the stored order) and the others
    revisit it; all other rows are responses.  Null ids and repeated rows are
    captures of their own, other columns are not read, an empty table gives an
    empty manifest.  The html is never shuffled while the repeated payloads
    number at most 200,000: then their winners are broadcast.  Rows are told
    apart by their place, which is stored with them before winners are chosen
    and files written, so both see the same; a repeated task writes files of
    another name, which no manifest lists."""
    root = shared_uri(pages.sparkSession, root) if root else run_dir(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = stage(pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), payload.alias("payload"),
                              F.monotonically_increasing_id().alias("rid"), F.sha1(payload).alias("digest")), "pages")
    winners = (rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
               .agg(F.count("*").alias("n"), F.max(F.struct("key", "rid")).alias("to")).filter("n > 1")
               .select("digest", "to"))
    joined = rows.join(small_or_shuffled(winners, "winners", 200_000), "digest", "left")
    own = F.col("to").eqNullSafe(F.struct("key", "rid"))
    planned = joined.select("key", "rid", "url", "payload", "digest",
                            F.when(~own, F.col("to.key")).alias("to_key"), F.when(~own, F.col("to.rid")).alias("to_rid"))
    manifest = planned.mapInArrow(_write(root, date), "file string, n_captures long, n_bytes long")
    return root, stage(manifest, "warcs")


# ---- reading -----------------------------------------------------------------

_RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
           "content_type string, payload_bytes long, payload_digest string, valid boolean, block binary")


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, body = headers.get("warc-type"), block
    digest, valid, size = None, None, len(block)
    if kind in ("response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        said = headers.get("warc-payload-digest", "")
        if said.lower().startswith("sha1:"):
            digest = base64.b32decode(said[5:].upper()).hex()
        if kind == "response":
            size, own = len(body), hashlib.sha1(body).hexdigest()
            valid, digest = digest in (None, own), own
        else:
            m = re.search(rb"(?im)^content-length:\s*(\d+)", head)
            size = int(m[1]) if m else None
        body = body if with_payload else None
    return (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
            headers.get("warc-target-uri"), headers.get("content-type"), size, digest, valid, body)


def _read(root: str, with_payload: bool):
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(root)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{folder}/{file}", compression=None) as f:
                    for raw in members(f):
                        rows.append(_row(*parse(raw), with_payload))
                        held += len(rows[-1][-1] or b"")
                        if len(rows) >= 4096 or held >= 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)
    return run


def read_records(spark: SparkSession, root: str, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row a record of the manifest's files.  ``payload_digest`` (bare hex
    SHA-1) and ``payload_bytes`` are those of the full payload: recomputed for
    a response (``valid`` tells whether its header agrees), from the headers
    for a revisit.  ``block`` holds the content of requests and metadata, and
    of responses the payload only ``with_payload``."""
    files = manifest.select("file")
    return files.repartition(max(1, 2 * files.count()), "file").mapInArrow(_read(root, with_payload), _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: its response or revisit record with the
    request and metadata records whose concurrent-to names it.

    Should several requests or metadata records name one capture, the one of
    the smallest record id is nested and ``n_requests`` / ``n_metadata`` count
    them all; records that name a capture which the archives lack form a row
    with a null ``response``.  Of records that repeat a record id one counts.
    Records of other types, without a record id, or requests and metadata
    without concurrent-to belong to no capture.  One shuffle by transaction
    id, combined in the tasks before it."""
    main = F.col("type").isin("response", "revisit")
    side = F.col("type").isin("request", "metadata") & F.col("concurrent_to").isNotNull()
    whole = F.struct("record_id", "type", "refers_to", "target_uri", "content_type", "payload_bytes", "payload_digest",
                     "valid", "block")
    return (records.filter(F.col("record_id").isNotNull() & (main | side))
            .groupBy(F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id"))
            .agg(F.min(F.when(F.col("type") == "request", whole)).alias("request"),
                 F.min(F.when(main, whole)).alias("response"),
                 F.min(F.when(F.col("type") == "metadata", whole)).alias("metadata"),
                 F.count_if(F.col("type") == "request").alias("n_requests"),
                 F.count_if(F.col("type") == "metadata").alias("n_metadata")))


def captures_of_pages(captures: DataFrame) -> DataFrame:
    """Per assembled capture of a page: page_id (from its metadata record),
    payload_bytes, payload_digest, record_type, refers_to (the page_id of the
    response it revisits) and the capture and target ids."""
    page = F.regexp_extract(F.decode("metadata.block", "UTF-8"), r"(?m)^page-id: (-?\d+)\r?$", 1)
    flat = stage(captures.filter(F.col("response").isNotNull()).select(
        F.nullif(page, F.lit("")).cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), F.col("response.target_uri").alias("target_uri"),
        "capture_id", F.col("response.refers_to").alias("target_id")), "captures")
    # the responses that are revisited, few; only they meet the revisits
    wanted = flat.filter(F.col("target_id").isNotNull()).select(F.col("target_id").alias("capture_id")).distinct()
    targets = (flat.filter(F.col("record_type") == "response").join(wanted, "capture_id", "left_semi")
               .select(F.col("capture_id").alias("target_id"), F.col("page_id").alias("refers_to")))
    return flat.join(small_or_shuffled(targets, "targets", 200_000), "target_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "capture_id", "target_uri")
