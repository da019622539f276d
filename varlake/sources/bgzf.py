"""Lines of gzip files, block-gzip ones in ranges.

A block-gzip file is a row of gzip members whose header states the member's size
in a ``BC`` field.  Its compressed bytes are cut into ranges, which separate tasks
inflate: a task looks for the first member that begins in its range, skips the
rest of a line that began before, and reads on to the end of the line that is open
where its range ends.  So each line comes from one range, and a file of any size
from as many tasks as it has ranges.  Other gzip files are read whole by the task
of their first range, since nothing in them says where to start.

Files are opened through Arrow's file systems (mounts, S3, GCS, HDFS).
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20  #: compressed bytes of a range
MAX_TASKS = 100_000
CHUNK = 1 << 20  #: bytes read at a time
BATCH_LINES = 4_096
BATCH_BYTES = 8 << 20
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no installed package
MEMBER = b"\x1f\x8b\x08\x04"  #: a gzip member with extra fields


def opened(file: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(quote(file, safe="/:"))


def can_open(file: str) -> bool:
    """Whether Arrow knows the file system of a path."""
    try:
        opened(file)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def gzip_ranges(spark: SparkSession, files: list[str], range_bytes: int | None = None) -> DataFrame:
    """(file, start, stop) of every range of the files, dealt out evenly."""
    step = range_bytes or RANGE_BYTES
    listed = spark.read.format("binaryFile").load(files).select("path", "length")
    ranges = listed.select(F.col("path").alias("file"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(step).cast("long"))).alias("start"))
    ranges = ranges.withColumn("stop", F.col("start") + F.lit(step).cast("long"))
    return ranges.repartition(min(MAX_TASKS, max(1, ranges.count())))


def member_size(head: bytes) -> int:
    """The size of the block-gzip member that ``head`` begins with; 0 if it
    doesn't, -1 if ``head`` is too short to say."""
    if len(head) < 12:
        return -1 if MEMBER.startswith(head[:4]) else 0
    if head[:4] != MEMBER:
        return 0
    extra = struct.unpack_from("<H", head, 10)[0]
    if len(head) < 12 + extra:
        return -1
    at = 12
    while at + 4 <= 12 + extra:
        kind, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"BC" and size == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


def first_member(read_at, size: int, start: int, stop: int) -> int | None:
    """Where the first member in [start, stop) begins; None if none does.
    Bytes that look like a member's begin count if another one, or the file's
    end, follows where it says, and its content is as its trailer says."""
    if start == 0:
        return 0
    at = start
    while at < stop:
        data = read_at(at, 1 << 17)  # a member has 64 KB at most
        found = data.find(MEMBER)
        while found >= 0 and at + found < stop:
            whole = data[found:] if len(data) - found >= 1 << 16 else read_at(at + found, 1 << 16)
            n = member_size(whole)
            if n > 0 and (at + found + n == size or member_size(read_at(at + found + n, 1 << 16)) > 0):
                try:
                    inflated(whole[:n])
                    return at + found
                except (zlib.error, ValueError):
                    pass
            found = data.find(MEMBER, found + 1)
        at += max(1, len(data) - len(MEMBER) + 1)
        if at >= size:
            break
    return None


def inflated(member: bytes) -> bytes:
    extra = struct.unpack_from("<H", member, 10)[0]
    data = zlib.decompress(member[12 + extra : -8], -15)
    crc, size = struct.unpack("<II", member[-8:])
    if zlib.crc32(data) != crc or len(data) & 0xFFFFFFFF != size:
        raise ValueError("damaged block-gzip member")
    return data


def _members(f, size: int, at: int) -> Iterator[tuple[int, bytes]]:
    """(where it begins, content) of each member from ``at`` on."""
    held, begins = b"", at
    while begins < size:
        n = member_size(held)
        if n == 0 and held:
            raise ValueError(f"no block-gzip member at byte {begins}")
        if n <= 0 or len(held) < n:
            more = f.read_at(CHUNK, begins + len(held))
            if not more:
                raise ValueError(f"block-gzip file ends inside the member at byte {begins}")
            held += bytes(more)
            continue
        yield begins, inflated(held[:n])
        held, begins = held[n:], begins + n


def _plain(f, size: int) -> Iterator[bytes]:
    """The content of an ordinary gzip file, of one member or several."""
    at, z = 0, zlib.decompressobj(31)
    while at < size:
        data = bytes(f.read_at(CHUNK, at))
        at += len(data)
        while data:
            if z.eof:
                z = zlib.decompressobj(31)
            yield z.decompress(data, BATCH_BYTES)
            while z.unconsumed_tail:
                yield z.decompress(z.unconsumed_tail, BATCH_BYTES)
            data = z.unused_data if z.eof else b""
    if size and not z.eof:
        raise ValueError("gzip file ends inside a member")


def _split(contents: Iterable[bytes]) -> Iterator[bytes]:
    held: list[bytes] = []
    for data in contents:
        *lines, rest = data.split(b"\n")
        if lines:
            yield b"".join([*held, lines[0]])
            yield from lines[1:]
            held = []
        held.append(rest)
    if last := b"".join(held):
        yield last


def range_lines(f, size: int, start: int, stop: int) -> Iterator[bytes]:
    """The lines of the range [start, stop) of an open file."""
    if size == 0:
        return
    if member_size(bytes(f.read_at(1 << 16, 0))) <= 0:
        if start == 0:
            yield from _split(_plain(f, size))
        return
    at = first_member(lambda a, n: bytes(f.read_at(n, a)), size, start, stop)
    if at is None:
        return

    def contents() -> Iterator[bytes]:
        for begins, data in _members(f, size, at):
            if begins >= stop:
                # the line that is open, or that begins right here, ends this range
                end = data.find(b"\n")
                yield data if end < 0 else data[: end + 1]
                if end >= 0:
                    return
            else:
                yield data

    lines = _split(contents())
    if start > 0:
        next(lines, None)  # it began in the range before, or at this one's first byte
    yield from lines


def gzip_lines(ranges: DataFrame, header_only: bool = False) -> DataFrame:
    """(value, file_path): the lines of the ranges; or only the lines that begin
    with # at the head of each file."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = opened(row["file"])
                lines: list[bytes] = []
                held = 0

                def out() -> pa.RecordBatch:
                    values = pa.array(lines, pa.binary())
                    try:
                        values = values.cast(pa.string())
                    except pa.ArrowInvalid:
                        values = pa.array([x.decode(errors="replace") for x in lines], pa.string())
                    return pa.RecordBatch.from_arrays([values, pa.array([row["file"]] * len(lines), pa.string())], ["value", "file_path"])

                with fs.open_input_file(path) as f:
                    for line in range_lines(f, f.size(), row["start"], row["stop"]):
                        if header_only and not line.startswith(b"#"):
                            break
                        lines.append(line.removesuffix(b"\r"))
                        held += len(line)
                        if len(lines) >= BATCH_LINES or held >= BATCH_BYTES:
                            yield out()
                            lines, held = [], 0
                if lines:
                    yield out()

    if header_only:
        ranges = ranges.where("start = 0").withColumn("stop", F.lit((1 << 63) - 1))
    return ranges.mapInArrow(run, "value string, file_path string")
