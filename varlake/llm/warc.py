"""WARC archives: a writer with payload dedup and a sequential reader.

Writer: each task writes its rows as gzip members, one per record, into archives
of its own, named by a fresh id.  It reports the finished archives; only those
in that report count, so the archives of a failed or repeated task are never
read.  Of equal payloads from ``min_revisit`` bytes on, the row with the largest
key becomes a response and the others revisits that refer to it; which is which
is found by a grouped maximum over a SHA-256, so a payload that a third of all
rows share is no hot spot.

Reader: each task streams its archives in chunks, decompresses member by member,
frames each record by its Content-Length, and verifies the block digest and, for
responses, the payload digest.

Archives are opened through Arrow's file systems, so the folder can be a shared
mount, S3, GCS or HDFS.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, ddl, pick, shared_folder, stored, text_or_empty

MIN_REVISIT = 1_000  #: bytes
ARCHIVE_BYTES = 256 << 20  #: a new archive begins beyond this size
CHUNK = 1 << 20
DATE = "2020-01-01T00:00:00Z"
#: Fixed value: the profile of revisits by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- records
def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str | None, sha256: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{sha256}')}>"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member.  Fields that are None are left out; line
    breaks and other controls in a value are percent-encoded."""
    clean = lambda v: "".join(urllib.parse.quote(c) if c < " " or c == "\x7f" else c for c in v)
    head = [f"{k}: {clean(v)}\r\n" for k, v in [*fields, ("WARC-Block-Digest", sha1_label(block)), ("Content-Length", str(len(block)))] if v is not None]
    return gzip_member(b"WARC/1.1\r\n" + "".join(head).encode() + b"\r\n" + block + b"\r\n\r\n")


def page_record(key: str | None, url: str | None, payload: bytes, sha256: str, refers_to: str | None) -> bytes:
    """A response, or a revisit if ``refers_to`` (the response's key) is given:
    then the block has the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key, sha256)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", sha1_label(payload)),
        ("X-Record-Key", None if key is None else urllib.parse.quote(key)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha256)), ("X-Refers-To-Key", urllib.parse.quote(refers_to))]
    return record(fields, http + payload if refers_to is None else http)


class WarcError(ValueError):
    """An archive that breaks off, is framed wrongly or fails a digest."""


def read_records(stream: BinaryIO) -> Iterator[dict]:
    """The records of an archive, one after the other: their fields (lower-case
    names) under "fields", and the "block".  One record is held at a time, and a
    member is inflated by ``CHUNK`` bytes at most before its length is compared."""
    rest, n = b"", 0
    while rest or (rest := stream.read(CHUNK)):
        n += 1
        member, data = zlib.decompressobj(31), bytearray()
        fields: dict[str, str] | None = None
        need = -1
        while True:
            try:
                part = member.decompress(rest, CHUNK)
            except zlib.error as e:
                raise WarcError(f"record {n}: {e}") from e
            data += part
            rest = member.unconsumed_tail
            if fields is None and (end := data.find(b"\r\n\r\n")) >= 0:
                version, *lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")
                if not version.startswith("WARC/"):
                    raise WarcError(f"record {n}: it doesn't begin with a WARC version")
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                try:
                    need = int(fields["content-length"])
                except (KeyError, ValueError) as e:
                    raise WarcError(f"record {n}: no valid Content-Length") from e
                del data[: end + 4]
            if need >= 0 and len(data) > need + 4:
                raise WarcError(f"record {n}: the member is longer than its record")
            if member.eof:
                rest = member.unused_data
                break
            # a full part may have more behind it without further input
            if not rest and len(part) < CHUNK and not (rest := stream.read(CHUNK)):
                raise WarcError(f"record {n}: the archive breaks off")
        if fields is None or len(data) != need + 4 or data[need:] != b"\r\n\r\n":
            raise WarcError(f"record {n}: its length is not as stated")
        block = bytes(data[:need])
        if (label := fields.get("warc-block-digest")) and label != sha1_label(block):
            raise WarcError(f"record {n}: wrong block digest")
        yield {"fields": fields, "block": block}


def read_page(rec: dict) -> dict | None:
    """What a response or revisit says; None for other records."""
    f = rec["fields"]
    kind = f.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = rec["block"].partition(b"\r\n\r\n")
    label = f.get("warc-payload-digest", "")
    if kind == "response" and label and label != sha1_label(payload):
        raise WarcError(f"wrong payload digest in {f.get('warc-record-id')}")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    own = lambda name: urllib.parse.unquote(f[name]) if name in f else None
    return {
        "key": own("x-record-key"),
        "record_type": kind,
        "record_id": f.get("warc-record-id"),
        "target_uri": f.get("warc-target-uri"),
        "payload_digest": base64.b32decode(label[5:]).hex() if label.startswith("sha1:") else hashlib.sha1(payload).hexdigest(),
        "payload_bytes": len(payload) if kind == "response" else int(http.get("content-length", 0)),  # of the full payload
        "refers_to_id": f.get("warc-refers-to"),
        "refers_to": own("x-refers-to-key"),
        "payload": payload if kind == "response" else None,
    }


# ---- DataFrames
def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def write_warc(df: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row and returns the finished archives: (path, records,
    bytes).  The payload is the column's text in UTF-8, null counting as empty,
    or its bytes.

    Of rows with equal payloads of at least ``min_revisit`` bytes, the largest id
    is the response (each of them, if that row is repeated); rows with a null id
    revisit it, or are responses if no row of the group has an id.  An empty
    table gives no archives; further columns are ignored."""
    spark = df.sparkSession
    root = (folder or shared_folder(spark)).rstrip("/")
    rows = pick(df, key=id_col, payload=payload_col, **({"url": url_col} if url_col else {}))
    payload = F.coalesce("payload", F.lit(b"")) if ddl(rows, "payload") == "binary" else text_or_empty(rows.payload).cast("binary")
    rows = rows.select("key", (F.col("url").cast("string") if url_col else F.lit(None).cast("string")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    long_enough = F.length("payload") >= min_revisit
    last = rows.where(long_enough).groupBy("sha256").agg(F.max("key").alias("last"))
    small = rows.where(~long_enough).withColumn("refers_to", F.lit(None).cast("string"))
    large = rows.where(long_enough).join(last, "sha256").withColumn("refers_to", F.when(~F.col("key").eqNullSafe(F.col("last")), F.col("last").cast("string"))).drop("last")
    columns = [F.col("key").cast("string").alias("key"), "url", "payload", "sha256", "refers_to"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(root)
        out, name, records, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for key, url, payload, sha256, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    size += out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                size += out.write(page_record(key, url, payload, sha256, refers_to))
                records += 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    archives = small.select(*columns).unionByName(large.select(*columns))
    return stored(arrow_map(archives, run, "path string, records long, bytes long"))


def read_warc(archives: DataFrame, path_col: str = "path", with_payload: bool = True) -> DataFrame:
    """(key, record_type, record_id, target_uri, payload_digest, payload_bytes,
    refers_to_id, refers_to[, payload]) of the responses and revisits in the
    archives whose paths a column names; null paths are passed over.  A damaged
    archive ends the job with a WarcError."""
    schema = "key string, record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, refers_to_id string, refers_to string" + ", payload binary" * with_payload
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = _place(path)
                rows, size = [], 0
                with fs.open_input_stream(place, compression=None) as stream:
                    for rec in read_records(stream):
                        if row := read_page(rec):
                            rows.append(row)
                            size += 500 + len(rec["block"]) * with_payload
                            if size > 8 << 20:
                                yield batch_of(rows)
                                rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    paths = pick(archives, path=path_col).where("path is not null")
    return arrow_map(paths.repartition(max(1, paths.count())), run, schema)
