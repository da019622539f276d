"""Best-fit packing with exact-complement hashing.

Documents become token ids plus an end id, cut into pieces of at most
``capacity`` tokens.  What to pack together is decided from the histogram of
piece lengths alone, which has at most ``capacity`` entries whatever the number
of documents, so only it goes to the driver:

1. For each length, longest first, the gap that it leaves is looked up among the
   lengths themselves, then among their pair sums, then their triple sums; a
   combination that fills the gap exactly is consumed as often as the counts
   allow.
2. What remains is packed best-fit, longest first, in bulk: all pieces of a
   length go to the fullest open sequences that can take them.

The plan is a list of patterns (lengths, how often).  Each piece then finds its
sequence by its rank among the pieces of its length.  Ranks are counted within
the task that encodes the piece and shifted by the totals of earlier tasks, so a
length that a third of all pieces share needs no window or task of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varlake.llm.codec import codec, grouped
from varlake.llm.common import arrow_map, ddl, pick, stored, strings, text_or_empty

CAPACITY = 2048
Pattern = tuple[tuple[int, ...], int]  #: lengths in order of their place, number of sequences


def _fill(gap: int, left: np.ndarray, own: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that sum to ``gap``; ``own`` is the
    length whose gap it is (one of it is taken)."""
    have = left[: gap + 1].copy()
    if own <= gap:
        have[own] -= 1
    if have[gap] > 0:
        return (gap,)

    def pair(total: int, have: np.ndarray) -> tuple[int, int] | None:
        """Two available lengths with this sum, the larger first."""
        small = np.arange(1, total // 2 + 1)
        ok = (have[small] > 0) & (have[total - small] > 0)
        if total % 2 == 0 and total:
            ok[-1] &= have[total // 2] > 1
        hit = np.flatnonzero(ok)
        return (total - int(small[hit[0]]), int(small[hit[0]])) if len(hit) else None

    if got := pair(gap, have):
        return got
    for a in (np.flatnonzero(have[1:gap] > 0) + 1)[::-1].tolist():
        have[a] -= 1
        if got := pair(gap - a, have):
            return (a, *got)
        have[a] += 1
    return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up ``counts`` (length: number of pieces), lengths from
    1 to ``capacity``.  Memory and time depend on the distinct lengths only."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece has {length} tokens; sequences hold 1 to {capacity}")
        left[length] += n
    plan: list[Pattern] = []
    if left[capacity]:
        plan.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while left[length] and (parts := _fill(capacity - length, left, length)):
            used = np.bincount([length, *parts], minlength=capacity + 1)
            times = int((left[used > 0] // used[used > 0]).min())
            plan.append(((length, *parts), times))
            left -= times * used
    # best fit: open sequences by the room that they have, in bulk
    open_by_room: dict[int, list[Pattern]] = {}
    for length in range(capacity - 1, 0, -1):
        todo = int(left[length])
        while todo:
            room = min((r for r in open_by_room if r >= length), default=None)
            if room is None:
                per = capacity // length
                full, rest = divmod(todo, per)
                for times, k in ((full, per), (1 if rest else 0, rest)):
                    if times:
                        open_by_room.setdefault(capacity - k * length, []).append(((length,) * k, times))
                todo = 0
                continue
            parts, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
            k = room // length  # as many into each as go in
            whole = min(times, todo // k)
            if whole:
                open_by_room.setdefault(room - k * length, []).append((parts + (length,) * k, whole))
                todo -= whole * k
            spare = times - whole
            if spare and todo:  # fewer than k are left for one more
                open_by_room.setdefault(room - todo * length, []).append((parts + (length,) * todo, 1))
                spare, todo = spare - 1, 0
            if spare:
                open_by_room.setdefault(room, []).append((parts, spare))
    return plan + [p for group in open_by_room.values() for p in group]


def pieces_of(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, task, nth[, ids]): the pieces of
    each text, where ``nth`` numbers the pieces of a length within a task.  Null
    text counts as empty: one piece of the end id alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at = 0
            for group in grouped(strings(batch.column(1))):
                rows: list[tuple] = []
                for i, ids in enumerate(c.encode(group), at):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a : a + 4 * capacity]
                        n = len(part) // 4
                        rows.append((i, k, a // 4, n, zlib.crc32(part), task, int(seen[n]), part))
                        seen[n] += 1
                at += len(group)
                cols = list(zip(*rows, strict=True))
                out = [batch.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()), *(pa.array(x, pa.int64()) for x in cols[2:5]), pa.array(cols[5], pa.int32()), pa.array(cols[6], pa.int64())]
                if with_ids:
                    ends = np.cumsum([0, *cols[3]]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(cols[7]), "<i4"))))
                yield pa.RecordBatch.from_arrays(out, [f"c{i}" for i in range(len(out))])

    rows = pick(df, key=id_col, text=text_col)
    rows = rows.select("key", text_or_empty(rows.text).alias("text"))
    kinds = f"key {ddl(rows, 'key')}, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<int>" * with_ids
    return arrow_map(rows, run, kinds)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with length, task and nth) plus sequence_id
    and offset.  The offsets of a sequence have no gaps and start at 0."""
    per_task = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    first, runs = 0, {}
    for lengths, times in plan_packing(counts, capacity):
        at = 0
        for length in lengths:
            runs.setdefault(length, []).append((times, first, at))
            at += length
        first += times
    table = {}
    for length, rows in runs.items():
        times, firsts, ats = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        table[length] = (np.cumsum(times), np.cumsum(times) - times, firsts, ats)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = pieces.join(shift, ["length", "task"]).withColumn("nth", F.col("nth") + F.col("shift")).drop("shift")
    kept = [c for c in ranked.columns if c not in ("task", "nth")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("length", "nth"))
            seq, off = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            for n in np.unique(length).tolist():
                ends, starts, firsts, ats = table[n]
                own = np.flatnonzero(length == n)
                run_no = np.searchsorted(ends, nth[own], side="right")
                seq[own] = firsts[run_no] + nth[own] - starts[run_no]
                off[own] = ats[run_no]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(seq), pa.array(off)], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {ddl(ranked, c)}" for c in kept) + ", sequence_id long, offset long"
    return arrow_map(ranked, run, schema)


def pack_documents(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset): every
    token of every document in exactly one sequence of at most ``capacity``.

    Null text counts as empty (the end id alone); repeated rows are packed each;
    an empty table gives no rows; further columns are ignored."""
    pieces = stored(pieces_of(df, path, end_id, capacity, id_col, text_col, with_ids))
    packed = pack_pieces(pieces, capacity)
    columns = ["key", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset"]
    return packed.select(*columns).withColumnRenamed("key", id_col)
