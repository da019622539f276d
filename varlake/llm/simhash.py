"""SimHash near-duplicates with deletion-variant signatures.

Two fingerprints that differ in at most ``max_bits`` bits, cut into
``max_bits // 2 + 1`` segments, have a segment in which they differ in at most
one bit.  So each distinct fingerprint is indexed once per bit: under the value
of that bit's segment with the bit left out.  Fingerprints that meet under a key
are compared; what differs in at most ``max_bits`` bits is linked, and linked
fingerprints form classes.

Only distinct fingerprints are indexed, so copies, however many, count once.
Keys are dealt out by hash and sorted; a task runs through its keys and emits,
for a key with many fingerprints, a spanning forest of the links instead of all
pairs: a found fingerprint leaves the list that is searched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.codec import grouped
from varlake.llm.common import arrow_map, ddl, pick, stored, strings, text_or_empty
from varlake.llm.components import connected_components

SEED = 42
STRETCH = 2_000_000  #: bytes of a text handled at a time
#: Fingerprints of one block of a key that very many have.
BLOCK = 20_000
SMALL_KEY = 32  #: keys with up to this many fingerprints are compared pair by pair in numpy


def _hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a text, in stretches."""
    data = text.encode().lower()  # of bytes: A-Z only
    words: list[bytes] = []
    at, seen = 0, False
    while at < len(data):
        end = len(data)
        if end - at > STRETCH:
            cut = [p for c in b" \t\n\r\x0b\x0c" if (p := data.find(c, at + STRETCH)) >= 0]
            end = min(cut, default=end)
        words += data[at:end].split()  # at \x20 and \x09-\x0D
        at = end
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.append(0, ends[: -size] + 1).tolist()
            digest = xxhash.xxh64_intdigest
            yield np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)), np.uint64, len(starts))
            words, seen = words[len(words) - size + 1 :], True
    if words and not seen:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)


def _bit_counts(parts: list[np.ndarray]) -> np.ndarray:
    """How many hashes of each part have each bit: (parts, 64)."""
    sizes = np.array([len(p) for p in parts])
    flat = np.concatenate(parts)
    # sums of up to 255 hashes fit a byte; eight bits of a hash are summed at once
    runs = -(-sizes // 255)
    first = np.cumsum(runs) - runs
    starts = np.repeat(np.cumsum(sizes) - sizes - 255 * first, runs) + 255 * np.arange(runs.sum())
    out = np.zeros((len(parts), 64), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(bit)) & np.uint64(0x0101010101010101), starts)
        out[:, bit::8] = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
    return out


def fingerprint_texts(texts: list[str], size: int) -> np.ndarray:
    """The 64-bit fingerprint of each text; zero where there are no words."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    rows: list[int] = []
    parts: list[np.ndarray] = []

    def flush() -> None:
        if parts:
            np.add.at(ones, rows, _bit_counts(parts))
            np.add.at(total, rows, [len(p) for p in parts])
            rows.clear()
            parts.clear()

    held = 0
    for i, text in enumerate(texts):
        for h in _hashes(text, size):
            rows.append(i)
            parts.append(h)
            held += len(h)
            if held > 1_000_000:
                flush()
                held = 0
    flush()
    return ((2 * ones > total[:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(df: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, fingerprint long): the SimHash of each text's word shingles.

    Null text counts as empty; texts with fewer words than a shingle give the
    hash of all their words; texts without words give zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_texts(group, shingle) for group in grouped(strings(batch.column(batch.num_columns - 1)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(found).view(np.int64))], [*batch.schema.names[:-1], "fingerprint"])

    names = [f"k{i}" for i in range(len(keep))]
    rows = pick(df, key=id_col, **dict(zip(names, keep, strict=True)), text=text_col)
    rows = rows.select("key", *names, text_or_empty(rows.text).alias("text"))
    kinds = ", ".join(f"{n} {ddl(rows, n)}" for n in ("key", *names))
    return arrow_map(rows, run, f"{kinds}, fingerprint long").toDF(id_col, *keep, "fingerprint")


def _forest(values: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among these fingerprints."""
    left = values
    while len(left) > 1:
        front, left = [left[:1]], left[1:]
        while front and len(left):
            group = front.pop()
            for v in group:
                near = np.bitwise_count(left ^ v) <= max_bits
                if near.any():
                    hit, left = left[near], left[~near]
                    front.append(hit)
                    yield np.full(len(hit), v), hit
                    if not len(left):
                        break


def _links(keys: np.ndarray, values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of each key; both arrays sorted by key."""
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(start, len(keys)))
    small = np.repeat(size <= SMALL_KEY, size)
    ks, vs = keys[small], values[small]
    for step in range(1, min(SMALL_KEY, int(size.max(initial=1)))):
        at = np.flatnonzero(ks[:-step] == ks[step:])
        if not len(at):
            break
        x, y = vs[at], vs[at + step]
        near = np.bitwise_count(x ^ y) <= max_bits
        a.append(x[near])
        b.append(y[near])
    for i in np.flatnonzero(size > SMALL_KEY).tolist():
        for x, y in _forest(values[start[i] : start[i] + size[i]], max_bits):
            a.append(x)
            b.append(y)
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def _split_hot(keyed: DataFrame, block: int) -> DataFrame:
    """The keys with those that more than two blocks of fingerprints have cut
    up: their fingerprints are dealt to blocks, and each two blocks meet under a
    key of their own, so every two fingerprints of a key still meet."""
    hot = stored(keyed.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block))
    if hot.isEmpty():
        return keyed
    blocks = F.ceil(F.col("n") / block).cast("int")
    parts = keyed.join(hot, "k").select("k", "fingerprint", F.pmod(F.xxhash64(F.lit(block), "fingerprint"), blocks).cast("int").alias("x"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("y"))
    parts = parts.where(F.col("x") != F.col("y")).select(F.xxhash64("k", F.least("x", "y"), F.greatest("x", "y")).alias("k"), "fingerprint")
    return keyed.join(hot, "k", "left_anti").unionByName(parts)


def near_links(distinct: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect distinct fingerprints (column fingerprint)
    within ``max_bits`` bits.  No task holds more than about two blocks of the
    fingerprints of a key."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    variants = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        for bit in range(lo, hi):
            mask = ((1 << hi) - (1 << lo)) & ~(1 << bit)
            variants.append(F.struct(F.lit(bit).alias("bit"), F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long").alias("mask")))
    keyed = distinct.select("fingerprint", F.explode(F.array(*variants)).alias("v")).select(F.xxhash64("v.bit", F.col("fingerprint").bitwiseAND(F.col("v.mask"))).alias("k"), "fingerprint")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_v = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
            x, y = _links(keys, values, max_bits)
            if len(x):
                pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64))], ["a", "b"])

        for batch in batches:  # sorted by key; the last key may go on in the next batch
            keys = np.concatenate([held_k, batch.column(0).to_numpy()])
            values = np.concatenate([held_v, batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1]))
            held_k, held_v = keys[cut:], values[cut:]
            yield from out(keys[:cut], values[:cut])
        yield from out(held_k, held_v)

    if distinct.count() > 2 * block:  # else no key can have as many
        keyed = _split_hot(keyed, block)
    dealt = keyed.repartition("k").sortWithinPartitions("k", "fingerprint")
    return arrow_map(dealt, run, "a long, b long")


def near_dup_classes(df: DataFrame, shingle: int = 5, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, fingerprint long, component_id): for each row the smallest id
    of its class.  Rows with equal fingerprints are one class, also those
    without words; ids that are null are not the smallest (null where a class
    has no other); repeated rows are rows of their class; an empty table gives
    no rows."""
    rows = stored(fingerprints(df, shingle, id_col, text_col, keep).withColumnRenamed(id_col, "__id"))
    first = stored(rows.groupBy("fingerprint").agg(F.min("__id").alias("first")))
    links = stored(near_links(first.select("fingerprint"), max_bits))
    found = connected_components(links).withColumnRenamed("node", "fingerprint")
    linked = first.join(found, "fingerprint")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    classes = first.join(found, "fingerprint", "left").join(least, "component", "left")
    classes = classes.select("fingerprint", F.coalesce("least", "first").alias("component_id"))
    return rows.join(classes, "fingerprint").select(F.col("__id").alias(id_col), *keep, "fingerprint", "component_id")


def near_dedup(df: DataFrame, shingle: int = 5, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, without those that have a near-duplicate
    with a smaller id; of rows with one id, the one that is read first stays.
    ``df`` is read twice and must give the same partitions each time, as a
    stored table does."""
    names = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("uid", F.monotonically_increasing_id())
    own = pick(df, key=id_col, text=text_col).withColumn("uid", F.monotonically_increasing_id())
    # the pair (id, uid) orders the rows of a class; a null id comes last
    order = F.struct(F.col("key").isNull().alias("n"), F.col("key").alias("i"), F.col("uid").alias("u"))
    classes = near_dup_classes(own.withColumn("order", order), shingle, max_bits, "order", "text")
    stay = classes.select(F.col("component_id.u").alias("uid")).distinct()
    return plain.join(stay, "uid", "left_semi").drop("uid").toDF(*names)
