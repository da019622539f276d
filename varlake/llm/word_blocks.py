"""Texts as streams of word numbers, a block of documents at a time, and counts
over all blocks.

A block has the documents that a task reads one after the other, up to
``BLOCK_BYTES`` of text (a longer document is a block of its own).  Its distinct
words are numbered, the most frequent first, so a block tells and asks of the
whole corpus once per distinct word.  Both travel as compressed arrays: each block
deals its words to parts, a part sums the counts of its words over all blocks and
answers each block for the words that it dealt.  Parts have about ``PART`` words.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, stored

BLOCK_BYTES = 8 << 20
STRETCH = 1 << 20  #: bytes of a text split at a time
PART = 500_000


class Numbers(dict):
    """Numbers for words, in order of appearance from 1; ``taken`` lists what
    has one, and may be shared by several of these."""

    def __init__(self, taken: list, group: Hashable = None):
        self.taken, self.group = taken, group

    def __missing__(self, word: bytes) -> int:
        self.taken.append((self.group, word))
        self[word] = n = len(self.taken)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def stretches(data: bytes, at: bytes = b" ") -> Iterator[bytes]:
    """The bytes of a text, cut before one of ``at`` if they are many."""
    start = 0
    while len(data) - start > STRETCH:
        cut = min((p for c in at if (p := data.find(c, start + STRETCH)) >= 0), default=len(data))
        yield data[start:cut]
        start = cut
    yield data[start:]


def by_frequency(stream: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stream (numbers up to n, zero for none) renumbered by frequency, with
    the old number, less one, at each new one and its count."""
    counts = np.bincount(stream, minlength=n + 1)[1:]
    old = np.argsort(-counts, kind="stable")
    new = np.zeros(n + 1, np.int32)
    new[old + 1] = np.arange(1, n + 1, dtype=np.int32)
    return new[stream], old, counts[old]


def squeezed(values: np.ndarray) -> bytes:
    """Integers, compressed: the lowest bytes of all, then the next."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes, dtype: type = np.int32) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(dtype)


def joined(parts: Iterable[np.ndarray], dtype: type = np.int32) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *parts])


def parts_for(entries: int | None) -> int:
    return -(-(entries or 0) // PART) or 1


def cells(batch: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield [c[i].as_py() for c in batch.columns]


#: One for each group of a block: its words, their numbers in the block less one, and how often each occurs.
VOCAB = "array<struct<g: string, words: binary, at: binary, n: binary>>"
_VOCAB = pa.struct([("g", pa.string()), ("words", pa.binary()), ("at", pa.binary()), ("n", pa.binary())])


def vocabulary(words: list[tuple[str, bytes]], counts: np.ndarray) -> pa.Array:
    """A cell of the type VOCAB for the (group, word) at each number, less one."""
    groups: dict[str, list[int]] = {}
    for i, (g, _) in enumerate(words):
        groups.setdefault(g, []).append(i)
    pack = zstandard.ZstdCompressor(level=1).compress
    entry = [{"g": g, "words": pack(b" ".join([words[i][1] for i in at])), "at": squeezed(np.array(at, np.int32)), "n": squeezed(counts[at].astype(np.int64))} for g, at in groups.items()]
    return pa.array([entry], pa.list_(_VOCAB))


def counted_words(blocks: DataFrame, entries: int | None, least: int) -> DataFrame:
    """What all ``blocks`` (block, vocab) with that many vocabulary entries say:
    rows (g, w, number, f) of the words that occur at least ``least`` times, each
    with a number of its own, and answers (block, at, number, f: compressed arrays)
    of these to each block.  The columns of the other kind are null; ``total`` is
    the sum of the counts of all words that a part has of g, in a row of its own."""
    parts = parts_for(entries)
    unpack = zstandard.ZstdDecompressor

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, vocab in cells(batch):
                rows = []
                for entry in vocab:
                    data = unpack().decompress(entry["words"])
                    words = data.split(b" ")
                    part = np.fromiter((crc32(w) for w in words), np.int64, len(words)) % parts
                    at, n = unsqueezed(entry["at"]), unsqueezed(entry["n"], np.int64)
                    order = np.argsort(part, kind="stable")
                    ends = np.searchsorted(part[order], np.arange(parts + 1))
                    for p in np.flatnonzero(np.diff(ends)).tolist():
                        own = order[ends[p] : ends[p + 1]]
                        pack = zstandard.ZstdCompressor(level=1).compress
                        rows.append((p, entry["g"], block, pack(b" ".join([words[i] for i in own.tolist()])), squeezed(at[own]), squeezed(n[own])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["part", "g", "block", "words", "at", "n"])

    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["block", "at", "numbers", "counts", "g", "w", "number", "f", "total"]

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, groups, taken, told = None, {}, [], []

        def out() -> Iterator[pa.RecordBatch]:
            if part is None:
                return
            total = np.zeros(len(taken), np.int64)
            for _, _, which, _, n in told:
                total[which] += n  # the words of one block differ
            frequent = total >= least
            number = (np.cumsum(frequent) - 1) * parts + part
            rows: list[tuple] = []
            for block, _, which, at, _ in told:
                if (has := frequent[which]).any():
                    mine = which[has]
                    rows.append((block, squeezed(at[has]), squeezed(number[mine]), squeezed(total[mine]), None, None, None, None, None))
            sums: dict[str, int] = {}
            for _, g, _, _, n in told:
                sums[g] = sums.get(g, 0) + int(n.sum())
            rows += [(None, None, None, None, g, None, None, None, n) for g, n in sums.items()]
            rows += [(None, None, None, None, taken[i][0], taken[i][1].decode(), int(number[i]), int(total[i]), None) for i in np.flatnonzero(frequent).tolist()]
            for a in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 20_000], strict=True), kinds, strict=True)], names)

        for batch in batches:
            for p, g, block, words, at, n in cells(batch):
                if p != part:
                    yield from out()
                    part, groups, taken, told = p, {}, [], []
                own = groups.setdefault(g, Numbers(taken, g))
                which = own.of(unpack().decompress(words).split(b" ")) - 1
                told.append((block, g, which, unsqueezed(at), unsqueezed(n, np.int64)))
        yield from out()

    dealt = arrow_map(blocks.select("block", "vocab"), deal, "part long, g string, block long, words binary, at binary, n binary")
    dealt = dealt.repartition("part").sortWithinPartitions("part")
    return stored(arrow_map(dealt, gather, "block long, at binary, numbers binary, counts binary, g string, w string, number long, f long, total long"))


def answers(counted: DataFrame) -> DataFrame:
    """(block, told: all answers to the block) of ``counted_words``."""
    return counted.where(F.col("block").isNotNull()).groupBy("block").agg(F.collect_list(F.struct("at", "numbers", "counts")).alias("told"))
