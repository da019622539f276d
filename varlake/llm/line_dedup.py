"""Fuzzy line dedup: MinHash banding, exact Jaccard, distributed union-find.

A line is what stands between newlines, without white space at its ends; blank
lines are never removed.  Lines are alike if the Jaccard similarity of their
sets of character shingles is at least ``threshold`` (a line shorter than a
shingle is like itself only).  Of each component of alike lines the first in
order of (document id, place) stays, over the whole corpus.

1. Each distinct line is signed (``BANDS`` x ``ROWS`` minima); a pair at 0.8
   shares a band with probability 0.998, at 0.9 with over 0.9999.  A line is
   identified by a 64-bit hash of its text.  Its sketch are two bits of each of
   ``SKETCH`` minima, which differ with probability 0.75 (1 - J).  The places of
   all lines are noted on the way and dealt out with the keys, many in a row; of a
   line that is very common only two a task go by the line's hash.
2. Keys are dealt into buckets, many in a row.  Under a key that at most FEW lines
   have, every two lines are held against each other, by their sketches first.
   Lines that are left, and those of the other keys, are read once more for their texts.
3. Of a key that more lines have, every line is held against one of them (linear, and
   split by Spark if a key is hot); their sketches are of further minima.
   All links give components.
4. Under such keys that still hold several components, lines outside that one's
   component are held against all others of another component; a found link
   joins two components, so no further pair of them is looked at.  All lines of
   a large key are dealt into blocks, and two blocks at a time meet in a task.  No
   pair of a key is left out, so n lines outside cost n * n / 2 comparisons, spread
   over the pairs of blocks; keys that hold the same lines are looked at once.
   Groups of at most FEW lines are compared many at once, all their pairs.
5. Components again, then the first line of each: its document by the documents'
   numbers in order, its place in there when lines are taken out.

Pairs are held against each other in two steps.  Numbers of shingles that differ
too much rule a pair out for certain, and sketches that differ in more than
``SKETCH_APART`` minima do but for one pair of 0.8 in 50,000; only texts of lines
that are left travel, and those are compared exactly.

Lines are identified by 64-bit hashes: among n distinct lines about n * n / 2**65
pairs share one by chance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, ddl, pick, stored, strings, text_or_empty
from varlake.llm.components import connected_components

SHINGLE = 5  #: characters
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
BLOCK = 2_000  #: lines of a hot key, of two of which the lines are compared in one task at a time
BLOCK_CHARS = 100_000  #: characters signed at a time, so that the arrays stay in the cache
SKETCH, SKETCH_APART = 32, 14  #: at 0.8, 4.8 minima differ on average
BITMAP = 2_048  #: bits; a power of two
FEW = 32  #: lines of a group that is compared together with others
PAIRS = 1_000  #: whose texts are compared at a time
AT_ONCE = 30_000  #: pairs whose sketches are held against each other at a time
BUCKET_BITS = 12  #: of a key or line hash, by which it is dealt out
ONLY, FIRST, FURTHER = range(3)
AGAIN = 2 << BUCKET_BITS  #: the first bucket of places of lines that occur again for certain
SIGNED = 500_000  #: keys of lines that are put together by bucket, 24 bytes each
HELD = 250_000  #: keys from which whole buckets are settled together
SEEN_LINES = 200_000  #: line hashes that a task remembers so as not to sign a line again
_MULTIPLIERS = (np.random.default_rng(20).integers(0, 2**32, BANDS * ROWS + SKETCH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def lines_of(text: str) -> list[str]:
    return [x.strip() for x in text.split("\n")]


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode()) - (1 << 63)


def shingle_hashes(codes: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the SHINGLE (5) characters from each place on."""
    h = codes
    for width, by in ((1, 0x9E3779B1), (2, 0x85EBCA6B)):
        h = h[:-width] * np.uint32(by) + h[width:]
    h = h[:-1] * np.uint32(0xC2B2AE35) + codes[4:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(13))


def _spans(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of lines, one line's after the other's, and the places
    where each line's start."""
    hashes = shingle_hashes(np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32))
    lens = np.fromiter(map(len, lines), np.int64, len(lines))
    return hashes[_within(lens)], np.cumsum(lens - SHINGLE + 1) - lens + SHINGLE - 1


def _within(lens: np.ndarray) -> np.ndarray:
    """Of the shingles of lines put together, which don't cross lines."""
    ends = np.cumsum(lens)
    within = np.ones(ends[-1], bool)
    for i in range(1, SHINGLE):
        within[ends - i] = False
    return within[: 1 - SHINGLE]


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(lines, BANDS) int64 keys, and an int64 of two bits of each of SKETCH of the
    keys' own minima; each line has at least SHINGLE characters."""
    hashes, starts = _spans(lines)
    product = np.empty_like(hashes)
    keys, sketch = np.empty((len(lines), BANDS), np.uint64), np.zeros(len(lines), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for row in range(ROWS):
            least = np.minimum.reduceat(np.multiply(hashes, _MULTIPLIERS[band * ROWS + row], out=product), starts)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
            if (place := row * BANDS + band) < SKETCH:
                sketch |= _two_bits(least, place)
        keys[:, band] = key
    return keys.view(np.int64), sketch.view(np.int64)


def _two_bits(least: np.ndarray, place: int) -> np.ndarray:
    return ((least >> np.uint32(11) ^ least) & np.uint32(3)).astype(np.uint64) << np.uint64(2 * place)


def sketches(lines: list[str]) -> np.ndarray:
    """An int64 for each line: two bits of each of SKETCH minima."""
    hashes, starts = _spans(lines)
    product = np.empty_like(hashes)
    out = np.zeros(len(lines), np.uint64)
    for i, by in enumerate(_MULTIPLIERS[BANDS * ROWS :]):
        least = np.minimum.reduceat(np.multiply(hashes, by, out=product), starts)
        out |= _two_bits(least, i)
    return out.view(np.int64)


def _shingle_numbers(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each line, sorted: its place in the list, then the
    shingle's five characters in a byte each.  And the places of the lines that
    have other characters than Latin-1, of which the numbers say nothing."""
    text, lens = "".join(lines), np.fromiter(map(len, lines), np.int64, len(lines))
    data, wide = text.encode("latin-1", "replace"), np.empty(0, np.int64)
    if not text.isascii():
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        wide = np.unique(np.searchsorted(np.cumsum(lens), np.flatnonzero(codes > 255), "right"))
    # the eight bytes from each place on, less the last three
    packed = np.ndarray(len(data) - SHINGLE + 1, "<u8", data + bytes(8 - SHINGLE), strides=(1,))[_within(lens)]
    packed &= np.uint64((1 << 8 * SHINGLE) - 1)
    packed |= np.repeat(np.arange(len(lines), dtype=np.uint64) << np.uint64(8 * SHINGLE), lens - SHINGLE + 1)
    packed.sort()
    return packed[np.append(True, packed[1:] != packed[:-1])], wide


def _per_line(packed: np.ndarray, n: int) -> np.ndarray:
    """How many of the sorted numbers each of n lines has."""
    return np.diff(np.searchsorted(packed, np.arange(n + 1, dtype=np.uint64) << np.uint64(8 * SHINGLE)))


def distinct_shingles(lines: list[str]) -> np.ndarray:
    """How many different shingles each line has."""
    packed, wide = _shingle_numbers(lines)
    out = _per_line(packed, len(lines)).astype(np.int32)
    out[wide] = [len(shingles(lines[i])) for i in wide.tolist()]
    return out


def alike(x: list[str], y: list[str], threshold: float) -> np.ndarray:
    """For each pair of lines whether they are alike, a stretch of pairs at once."""
    out = np.empty(len(x), bool)
    ends = np.cumsum(np.fromiter(map(len, x), np.int64, len(x)) + np.fromiter(map(len, y), np.int64, len(y))) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), len(x)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        (one, wide), (other, also) = _shingle_numbers(x[a:b]), _shingle_numbers(y[a:b])
        merged = np.concatenate([one, other])
        merged.sort(kind="stable")  # two sorted runs are merged
        both = _per_line(merged[1:][merged[1:] == merged[:-1]], b - a)
        out[a:b] = both / (_per_line(one, b - a) + _per_line(other, b - a) - both) >= threshold
        for i in np.union1d(wide, also).tolist():
            out[a + i] = jaccard(shingles(x[a + i]), shingles(y[a + i])) >= threshold
    return out


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many minima sketches differ."""
    d = x ^ y
    return np.bitwise_count((d | d >> np.uint64(1)) & np.uint64(0x5555555555555555))


def near(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, threshold: float) -> np.ndarray:
    """Whether lines may be alike, by their sketches and numbers of shingles."""
    return (apart(x, y) <= SKETCH_APART) & (np.minimum(m, n) >= threshold * np.maximum(m, n))


def jaccard(a: frozenset | set, b: frozenset | set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def shingles(line: str) -> frozenset[str]:
    return frozenset([line[i : i + SHINGLE] for i in range(len(line) - SHINGLE + 1)])


def packed_shingles(line: str) -> np.ndarray | None:
    """The distinct shingles of a Latin-1 line, each as its five bytes in one
    number, sorted; None for other lines."""
    try:
        data = line.encode("latin-1")
    except UnicodeEncodeError:
        return None
    # the eight bytes from each place on, less the last three
    out = np.ndarray(len(data) - SHINGLE + 1, "<u8", data + bytes(8 - SHINGLE), strides=(1,)) & np.uint64((1 << 8 * SHINGLE) - 1)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


class Line:
    """A line to be compared.  A bitmap of its shingles' hashes bounds the
    similarity from above, so that only what passes is compared exactly."""

    __slots__ = ("_bits", "_packed", "_set", "places", "text")

    def __init__(self, text: str):
        self.text, self.places = text, len(text) - SHINGLE + 1
        self._bits: int | None = None
        self._set: frozenset[str] | None = None
        self._packed: np.ndarray | None = packed_shingles(text)

    def bits(self) -> int:
        if self._bits is None:
            marks = np.zeros(BITMAP, bool)
            marks[shingle_hashes(np.frombuffer(self.text.encode("utf-32-le"), np.uint32)) & np.uint32(BITMAP - 1)] = True
            self._bits = int.from_bytes(np.packbits(marks).tobytes())
        return self._bits

    def set(self) -> frozenset[str]:
        if self._set is None:
            self._set = shingles(self.text)
        return self._set

    def similarity(self, other: Line) -> float:
        """The Jaccard similarity of the shingle sets."""
        a, b = self._packed, other._packed
        if a is None or b is None:
            return jaccard(self.set(), other.set())
        merged = np.concatenate([a, b])
        merged.sort()
        both = int((merged[1:] == merged[:-1]).sum())
        return both / (len(a) + len(b) - both)

    def may_be_alike(self, other: Line, threshold: float) -> bool:
        """False only if the similarity is below the threshold: a bit that one
        has and the other lacks stands for a shingle of which the same is true."""
        mine, theirs = (self.bits() & ~other.bits()).bit_count(), (other.bits() & ~self.bits()).bit_count()
        both = min(self.places - mine, other.places - theirs)
        return both >= threshold * (both + mine + theirs)


def _by_bucket(rows: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """(bucket, signed): the rows, three int64 each, of a bucket as one value."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(start, len(rows)).astype(np.int32) * np.int32(24)
    values = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(rows)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[start].astype(np.int32)), values], ["bucket", "signed"])


def _places_by_bucket(rows: np.ndarray) -> pa.RecordBatch:
    """``rows``: (line hash, uid, line_no).  Buckets of lines come after those of keys.
    Of each line two places at most, by which it is known to occur again, go to the
    bucket of its hash; the others go to the buckets from AGAIN on, by document."""
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    h = rows[:, 0]
    beyond = np.append([False, False], h[2:] == h[:-2])[: len(h)]
    bucket = (h.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16) + np.uint16(1 << BUCKET_BITS)
    bucket[beyond] = AGAIN + rows[beyond, 1] % (1 << BUCKET_BITS)
    return _by_bucket(rows, bucket)


def _signed(rows: DataFrame, places: bool = False) -> DataFrame:
    """(bucket, signed): each line of the texts under its band keys, once a task or so;
    the (key, line hash, sketch) of many lines whose keys fall into a bucket as the
    int64 of one value.  With ``places``, also each place of each line that is not
    blank; then ``rows`` has the documents' uid."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        placed: list[np.ndarray] = []

        def sign(lines: list[str], hashes: list[int]) -> None:
            keys, sketch = signatures(lines)
            out = np.empty((len(lines), BANDS, 3), np.int64)
            out[..., 0], out[..., 1], out[..., 2] = keys, np.array(hashes, np.int64)[:, None], sketch[:, None]
            held.append(out.reshape(-1, 3))

        def dealt() -> Iterator[pa.RecordBatch]:
            if held:
                rows = np.concatenate(held)
                held.clear()
                yield _by_bucket(rows, (rows[:, 0].view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16))
            if placed:
                rows = np.concatenate(placed)
                placed.clear()
                yield _places_by_bucket(rows)

        lines: list[str] = []
        hashes: list[int] = []
        chars = 0
        for batch in batches:
            h_of: list[int] = []
            no: list[int] = []
            n: list[int] = []
            for text in strings(batch.column(0)):
                before = len(no)
                for i, line in enumerate(lines_of(text)):
                    if not line:
                        continue
                    h = line_hash(line)
                    h_of.append(h)
                    no.append(i)
                    if len(line) >= SHINGLE and h not in seen:
                        if len(seen) >= SEEN_LINES:
                            seen.clear()
                        seen.add(h)
                        lines.append(line)
                        hashes.append(h)
                        chars += len(line)
                        if chars > BLOCK_CHARS:
                            sign(lines, hashes)
                            lines, hashes, chars = [], [], 0
                n.append(len(no) - before)
            if places and no:
                uid = np.repeat(batch.column(1).to_numpy(), n)
                placed.append(np.stack([np.array(h_of, np.int64), uid, np.array(no, np.int64)], axis=1))
            if sum(map(len, held)) + sum(map(len, placed)) >= SIGNED:
                yield from dealt()
        if lines:
            sign(lines, hashes)
        yield from dealt()

    return arrow_map(rows.select("text", "uid") if places else rows.select("text"), run, "bucket int, signed binary")


def _in_order(parts: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    """The different (key, line hash, sketch), sorted, of keys that several rows or ``hot`` have."""
    rows = np.concatenate(parts)
    rows = rows[np.argsort(rows[:, 0])]
    k = rows[:, 0]
    same = k[1:] == k[:-1]
    rows = rows[np.append(same, False) | np.append(False, same) | (np.isin(k, hot) if len(hot) else False)]
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]]


def _of_many(rows: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which of ``_in_order``'s rows have a key that more than FEW lines have, or a ``hot`` one."""
    start = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])[: len(rows)])
    lines = np.diff(np.append(start, len(rows)))
    return np.repeat((lines > FEW) | np.isin(rows[start, 0], hot), lines)


def _pairs_of_few(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every two lines under a key that may be alike, by their sketches, as line
    hashes; ``rows``: as ``_in_order`` gives them, of keys that few lines have."""
    k, h, sketch = rows[:, 0], rows[:, 1], rows[:, 2].view(np.uint64)
    found = [np.empty((2, 0), np.int64)]
    a = np.arange(len(rows))
    for step in range(1, FEW):
        a = a[: np.searchsorted(a, len(rows) - step)]
        a = a[k[a] == k[a + step]]
        if not len(a):
            break
        hit = a[apart(sketch[a], sketch[a + step]) <= SKETCH_APART]
        found.append(np.stack([h[hit], h[hit + step]]))
    x, y = np.concatenate(found, axis=1)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)]  # several keys bring the same two lines together
    return x[new], y[new]


def _met(signed: DataFrame) -> DataFrame:
    """(k, h, other) of lines that share a key: without k, two lines that may be
    alike of a key that at most FEW lines have; without ``other``, each line of
    a key that more have, which may be told more than once.  And (h, u, l, place),
    the places of lines; ``place``: ONLY, FIRST of several (one of them, not the first
    in order) or FURTHER.

    Buckets are sorted and gone through one after the other.  Of a bucket that
    is large, keys of many lines are passed on as they come, so that FEW lines
    of a key are held at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        types = {"k": pa.int64(), "h": pa.int64(), "other": pa.int64(), "u": pa.int64(), "l": pa.int32(), "place": pa.int32()}

        def out(n: int, **columns: np.ndarray) -> pa.RecordBatch:
            given = {c: pa.array(x) for c, x in columns.items()}
            return pa.RecordBatch.from_arrays([given.get(c, pa.nulls(n, t)) for c, t in types.items()], list(types))

        def told(rows: np.ndarray) -> pa.RecordBatch:
            return out(len(rows), k=rows[:, 0], h=rows[:, 1])

        def located(parts: list[np.ndarray], again: bool) -> pa.RecordBatch:
            """Of whole buckets."""
            rows = np.concatenate(parts)
            place = np.full(len(rows), FURTHER, np.int32)
            if not again:
                rows = rows[np.argsort(rows[:, 0], kind="stable")]
                same = rows[1:, 0] == rows[:-1, 0]
                place[~np.append(False, same)] = FIRST
                place[~(np.append(False, same) | np.append(same, False))] = ONLY
            return out(len(rows), h=rows[:, 0], u=rows[:, 1], l=rows[:, 2].astype(np.int32), place=place)

        def settled(parts: list[np.ndarray], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
            rows = _in_order(parts, hot)
            many = _of_many(rows, hot)
            if many.any():
                yield told(rows[many])
            x, y = _pairs_of_few(rows[~many])
            if len(x):
                yield out(len(x), h=x, other=y)

        parts: list[np.ndarray] = []
        last, held, most, hot = None, 0, 4 * HELD, none
        places: list[np.ndarray] = []
        last_placed, held_places = 0, 0
        for batch in batches:
            for bucket, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = np.frombuffer(value.as_buffer(), np.int64).reshape(-1, 3)
                if bucket >= 1 << BUCKET_BITS:
                    if held_places >= HELD and (bucket != last_placed or bucket >= AGAIN) or (bucket >= AGAIN > last_placed and held_places):
                        yield located(places, last_placed >= AGAIN)
                        places, held_places = [], 0
                    last_placed = bucket
                    places.append(rows)
                    held_places += len(rows)
                    continue
                if bucket != last and held >= HELD:
                    yield from settled(parts, hot)
                    parts, held, most, hot = [], 0, 4 * HELD, none
                elif held >= most:  # nothing but what may still be met is held on to
                    whole = np.concatenate(parts)
                    whole = whole[np.lexsort((whole[:, 1], whole[:, 0]))]
                    whole = whole[np.append(True, (whole[1:, :2] != whole[:-1, :2]).any(axis=1))]
                    many = _of_many(whole, hot)
                    if many.any():
                        yield told(whole[many])
                        hot = np.union1d(hot, whole[many, 0])
                    parts = [whole[~many]]
                    held = len(parts[0])
                    most = max(4 * HELD, 2 * held)
                last = bucket
                parts.append(rows)
                held += len(rows)
        if parts:
            yield from settled(parts, hot)
        if places:
            yield located(places, last_placed >= AGAIN)

    dealt = signed.repartition("bucket").sortWithinPartitions("bucket")
    return arrow_map(dealt, run, "k long, h long, other long, u long, l int, place int")


def _indexed(met: DataFrame) -> DataFrame:
    """(k, h): the lines of keys that many have."""
    return met.where("other is null").select("k", "h")


def _shared_keys(indexed: DataFrame) -> DataFrame:
    """(k, h, rep): the lines of each key that more than one line has, each with
    one and the same of them, which is among them.  Keys are dealt out by hash,
    sorted and run through, so a key of any size takes no memory; a line may be
    told more than once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rep = None, 0
        for batch in batches:
            k, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same = k[1:] == k[:-1]
            wanted = np.append(same, True) | np.append(key is not None and k[0] == key, same)  # and the last: its key may go on
            k, h = k[wanted], h[wanted]
            order = np.lexsort((h, k))
            k, h = k[order], h[order]
            goes_on = key is not None and k[0] == key
            new_key = np.append(not goes_on, k[1:] != k[:-1])
            keys, reps = k[new_key], h[new_key]
            if goes_on:
                keys, reps = np.append(key, keys), np.append(rep, reps)
            group = np.cumsum(new_key) - (0 if goes_on else 1)
            other = h != reps[group]
            other[1:] &= (h[1:] != h[:-1]) | new_key[1:]  # once a batch
            if other.any():
                shared = np.unique(group[other])
                columns = np.concatenate([k[other], keys[shared]]), np.concatenate([h[other], reps[shared]]), np.concatenate([reps[group[other]], reps[shared]])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "h", "rep"])
            key, rep = keys[-1], reps[-1]

    dealt = indexed.repartition("k").sortWithinPartitions("k")
    return arrow_map(dealt, run, "k long, h long, rep long")


def _texts(rows: DataFrame, firsts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, line) of the wanted line hashes."""
    found = firsts.select("h", "u", "l").join(wanted, "h")
    found = found.groupBy(F.col("u").alias("uid")).agg(F.collect_list(F.struct(F.col("l").alias("line_no"), "h")).alias("at"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1)
            ends, (nos, hashes) = at.value_lengths().to_numpy().cumsum(), at.flatten().flatten()
            nos, start, chars = nos.to_pylist(), 0, 0
            found: list[str] = []

            def out(start: int) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([hashes.slice(start, len(found)), pa.array(found, pa.string())], ["h", "line"])

            for text, end in zip(strings(batch.column(0)), ends.tolist(), strict=True):
                lines = text.split("\n")
                for no in nos[start + len(found) : end]:
                    line = lines[no].strip()
                    found.append(line)
                    chars += len(line)
                    if chars > BLOCK_CHARS:
                        yield out(start)
                        start, chars = start + len(found), 0
                        found.clear()
            if found:
                yield out(start)

    # the plan of many documents at every size: what is wanted grows with them
    return arrow_map(rows.join(found.hint("merge"), "uid").select("text", "at"), run, "h long, line string")


def _sketched(texts: DataFrame) -> DataFrame:
    """(h, sketch, size: number of shingles) of lines (h, line)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, chars = 0, 0
            lines: list[str] = []

            def out(start: int) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(lines)), pa.array(sketches(lines)), pa.array(distinct_shingles(lines))], ["h", "sketch", "size"])

            for line in strings(batch.column(1)):
                lines.append(line)
                chars += len(line)
                if chars > BLOCK_CHARS:
                    yield out(start)
                    start, chars = start + len(lines), 0
                    lines.clear()
            if lines:
                yield out(start)

    return arrow_map(texts.select("h", "line"), run, "h long, sketch long, size int")


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, x, y) whose texts x and y are alike."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAIRS):
                batch = whole.slice(start, PAIRS)
                keep = alike(batch.column(2).to_pylist(), batch.column(3).to_pylist(), threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return arrow_map(pairs.select("a", "b", "x", "y"), run, "a long, b long")


def _may_be_alike(a: str, b: str, threshold: float) -> Column:
    """By the numbers of shingles and the sketches of two lines, in columns."""
    one, other = F.col(f"{a}.size"), F.col(f"{b}.size")
    differ = F.col(f"{a}.sketch").bitwiseXOR(F.col(f"{b}.sketch"))
    near = F.bit_count(differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))) <= SKETCH_APART
    return near & (F.least(one, other) >= threshold * F.greatest(one, other))


def _whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (k, block), a group of which has the rows of two blocks at
    most: as they come, but so that no group is cut."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        k, block = rows.column("k").to_numpy(), rows.column("block").to_numpy()
        cut = int(np.flatnonzero((k != k[-1]) | (block != block[-1])).max(initial=-1)) + 1
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _with_partners(members: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``members`` (k, block, here, h, component, sketch, size), with
    ``near``: whether one may be alike to one of another component in its group (k, block)."""

    def partners(group: np.ndarray, component: np.ndarray, sketch: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``group``: in order from 0 on."""
        has = np.zeros(len(group), bool)
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        rows = np.diff(np.append(start, len(group)))
        few = np.flatnonzero((rows <= FEW)[group])
        for step in range(1, min(FEW, int(rows.max()))):  # small groups all at once
            a, b = few[:-step], few[step:]
            same = group[a] == group[b]
            if not same.any():
                break
            a, b = a[same], b[same]
            hit = (component[a] != component[b]) & near(sketch[a], sketch[b], size[a], size[b], threshold)
            has[a[hit]] = has[b[hit]] = True
        for g in np.flatnonzero(rows > FEW).tolist():
            own = slice(start[g], start[g] + rows[g])
            for i in range(own.start, own.stop, many := max(1, AT_ONCE // int(rows[g]))):
                some = slice(i, min(i + many, own.stop)), None
                hit = (component[own] != component[some]) & near(sketch[own], sketch[some], size[own], size[some], threshold)
                has[some[0]] = hit.any(axis=1)
        return has

    names = ["k", "block", "here", "h", "component", "sketch", "size"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            k, block, component, sketch, size = (rows.column(c).to_numpy() for c in ("k", "block", "component", "sketch", "size"))
            group = np.cumsum(np.append(False, (k[1:] != k[:-1]) | (block[1:] != block[:-1])))
            has = partners(group, component, sketch.view(np.uint64), size.astype(np.int64))
            yield from rows.select(names).append_column("near", pa.array(has)).combine_chunks().to_batches()

        for rows in _whole_groups(batches):
            yield from out(rows)

    dealt = members.repartition("k", "block").sortWithinPartitions("k", "block").select(*names)
    return arrow_map(dealt, run, "k long, block long, here boolean, h long, component long, sketch long, size int, near boolean")


def _in_blocks(members: DataFrame) -> DataFrame:
    """``members``, (k, h, component, main), dealt so that every two lines under
    a key of which one is not ``main`` meet in one group (k, block), which has the
    lines of at most two blocks of the key: (k, block, here, h, component).

    The blocks of main lines are numbered first, then those of the others.  The
    group of blocks i <= j is i * 2**32 + j; ``here`` marks the lines of j, which
    are never main.  They meet those of i, and each other where i is 0."""
    sizes = members.groupBy("k").agg(F.count_if("main").alias("inside"), F.count_if(~F.col("main")).alias("outside"))
    sizes = sizes.select("k", *(F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("inside", "outside")))
    mark = F.xxhash64("h")
    own = F.when(F.col("main"), F.pmod(mark, F.greatest(F.lit(1), "inside"))).otherwise(F.col("inside") + F.pmod(mark, F.greatest(F.lit(1), "outside"))).cast("int")
    first = F.when(F.col("main"), F.col("inside")).otherwise(F.lit(0))
    dealt = members.join(sizes, "k").where("outside > 0").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(first, F.col("inside") + F.col("outside") - 1))).where("own != other or own = 0")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    block = F.shiftleft(low.cast("long"), 32) + high
    return dealt.select("k", block.alias("block"), (F.col("own") == high).alias("here"), "h", "component")


def _cross_links(members: DataFrame, threshold: float) -> DataFrame:
    """Links between components under the same key.  ``members``: (k, block, h,
    component, here, sketch, size, line), the groups of ``_in_blocks``; a line that has
    no partner in its group comes without its text."""

    def few(group: np.ndarray, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Links of small groups, of all at once; ``group``: the group of each row, in order."""
        here = rows.column("here").to_numpy()
        h, component, sketch, size, block = (rows.column(c).to_numpy() for c in ("h", "component", "sketch", "size", "block"))
        sketch, found = sketch.view(np.uint64), []
        for step in range(1, FEW):
            a = np.arange(len(group) - step)
            a = a[group[a] == group[a + step]]
            if not len(a):
                break
            b = a + step
            meet = np.where(block[a] >> 32 == 0, here[a] | here[b], here[a] != here[b])
            hit = meet & (component[a] != component[b]) & near(sketch[a], sketch[b], size[a], size[b], threshold)
            found.append(np.stack([a[hit], b[hit]]))
        if found and (pairs := np.concatenate(found, axis=1)).size:
            ends = np.sort(h[pairs], axis=0)  # several keys bring the same two lines together
            order = np.lexsort(ends)
            ends = ends[:, order]
            pairs = pairs[:, order[np.append(True, (ends[:, 1:] != ends[:, :-1]).any(axis=0))]]
            lines = rows.column("line")
            for start in range(0, pairs.shape[1], PAIRS):
                a, b = pairs[:, start : start + PAIRS]
                keep = alike(lines.take(pa.array(a)).to_pylist(), lines.take(pa.array(b)).to_pylist(), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(h[a[keep]]), pa.array(h[b[keep]])], ["a", "b"])

    def many(block: int, rows: list[tuple[int, int, bool, int, int, str]]) -> Iterator[tuple[int, int]]:
        """Links of one group of (h, component, here, sketch, size, line)."""
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while (p := parent.get(c, c)) != c:
                parent[c] = c = parent.get(p, p)
            return c

        made: dict[int, Line] = {}

        def line(i: int) -> Line:
            if i not in made:
                made[i] = Line(rows[i][5])
            return made[i]

        here = [i for i, r in enumerate(rows) if r[2]]
        # the lines of a block meet each other where it is dealt with the first
        there = [i for i, r in enumerate(rows) if not r[2]] + (here if block >> 32 == 0 else [])
        known = len(there) - (len(here) if block >> 32 == 0 else 0)
        if not here or not there:
            return
        component, sketch, size = (np.array([r[c] for r in rows], np.int64) for c in (1, 3, 4))
        sketch, theirs = sketch.view(np.uint64), np.array(there)
        for first in range(0, len(here), many := max(1, AT_ONCE // len(there))):
            mine = np.array(here[first : first + many])[:, None]
            hit = (component[theirs] != component[mine]) & near(sketch[theirs], sketch[mine], size[theirs], size[mine], threshold)
            if block >> 32 == 0:
                hit &= np.arange(len(there)) < known + first + np.arange(len(mine))[:, None]
            for n, j in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
                i, j = here[first + n], there[j]
                h, c, g, d = *rows[i][:2], *rows[j][:2]
                if (p := root(c)) != (q := root(d)) and line(i).may_be_alike(line(j), threshold) and line(i).similarity(line(j)) >= threshold:
                    parent[p] = q
                    yield h, g

    def linked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of whole groups."""
        k, block = rows.column("k").to_numpy(), rows.column("block").to_numpy()
        new = np.append(True, (k[1:] != k[:-1]) | (block[1:] != block[:-1]))
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(new)))
        group = np.cumsum(new) - 1
        small = np.flatnonzero((size <= FEW)[group])
        if len(small):
            yield from few(group[small], rows.take(pa.array(small)))
        for g in np.flatnonzero(size > FEW).tolist():
            own = rows.slice(start[g], size[g]).select(["h", "component", "here", "sketch", "size", "line"])
            if pairs := list(many(int(block[start[g]]), list(zip(*(c.to_pylist() for c in own.columns), strict=True)))):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["a", "b"])

    dealt = members.where("line is not null").repartition("k", "block").sortWithinPartitions("k", "block")
    dealt = dealt.select("k", "block", "h", "component", "here", "sketch", "size", "line")
    return arrow_map(dealt, lambda batches: (x for rows in _whole_groups(batches) for x in linked(rows)), "a long, b long")


def _components(rows: DataFrame, firsts: DataFrame, threshold: float, met: DataFrame | None = None) -> DataFrame:
    """(h, component) of every line that is like another one.  ``firsts``: (h,
    u, l) of each line, one of its places; ``met``: see ``_met``."""
    shared = stored(_shared_keys(_indexed(rows if met is None else met)))
    wanted = shared.select("h")
    if met is not None:
        few = stored(met.where("other is not null").select(F.col("h").alias("a"), F.col("other").alias("b")).distinct())
        wanted = wanted.unionByName(few.select(F.col("a").alias("h"))).unionByName(few.select(F.col("b").alias("h")))
    texts = stored(_texts(rows, firsts, wanted.distinct()))
    # not in the same tasks: each would hold two Python workers
    sketched = stored(_sketched(texts.join(shared.select("h").distinct(), "h", "left_semi")))
    sketch = sketched.select("h", F.struct("sketch", "size").alias("s"))
    pairs = shared.where("h != rep").select(F.col("h").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.join(sketch.toDF("a", "s"), "a").join(sketch.toDF("b", "t"), "b").where(_may_be_alike("s", "t", threshold)).select("a", "b")
    if met is not None:
        pairs = pairs.unionByName(few)
    text = texts.select("h", "line")
    pairs = pairs.join(text.toDF("a", "x"), "a").join(text.toDF("b", "y"), "b")
    links = stored(_verified(pairs, threshold))
    found = stored(connected_components(links).toDF("h", "component"))
    # keys that still hold several components, beside the representative: it has met all others
    named = shared.join(found, "h", "left").select("k", "h", "rep", F.coalesce("component", "h").alias("component"))
    is_rep = F.col("h") == F.col("rep")
    other = F.when(~is_rep, F.col("component"))
    mark = F.xxhash64("h")
    mixed = named.groupBy("k").agg(
        F.count("*").alias("n"),
        F.min(other).alias("low"),
        F.max(other).alias("high"),
        F.max(F.when(is_rep, F.col("component"))).alias("rep_component"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("s"),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("t"),
    )
    # bands often bring the same lines together: one key of equal ones is enough
    mixed = mixed.where("low != high").groupBy("n", "s", "t").agg(F.min_by(F.struct("k", "rep_component"), "k").alias("one")).select("one.k", "one.rep_component")
    members = named.where(~is_rep).join(mixed, "k").select("k", "h", "component", (F.col("component") == F.col("rep_component")).alias("main"))
    members = _in_blocks(stored(members)).join(sketched, "h")
    members = stored(_with_partners(members, threshold))
    partnered, rest = (members.where(c).drop("near") for c in ("near", "not near"))
    more = stored(_cross_links(partnered.join(text, "h").unionByName(rest.withColumn("line", F.lit(None).cast("string"))), threshold))
    if more.isEmpty():
        return found
    return connected_components(found.toDF("a", "b").unionByName(more)).toDF("h", "component")


def dedup_lines(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, with the text less its removed lines,
    plus n_lines and n_removed (of the text as it came).

    The lines that stay keep their text and order.  Null text stays null, with
    no lines; an empty text has one blank line, which stays.  Of equal ids the
    row that is read first comes first, and null ids come last.  A column of
    ``df`` that is called n_lines or n_removed is replaced.  ``df`` is read
    several times and must give the same partitions each time, as a stored table
    does."""
    names = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("uid", F.monotonically_increasing_id())
    at = names.index(text_col)
    own = pick(df, key=id_col, text=text_col).withColumn("uid", F.monotonically_increasing_id())
    own = own.select("key", "uid", text_or_empty(own.text).alias("text"))

    rows = own.select("uid", "text")
    met = stored(_met(_signed(rows, places=True)))
    places, met = met.where("u is not null").select("h", "u", "l", "place"), met.where("u is null").select("k", "h", "other")
    found = _components(rows, places.where(F.col("place") != FURTHER), threshold, met)
    # the documents in order; their texts are asked for so that the same columns are read as above
    order = stored(own.where(F.octet_length("text") >= 0).select("key", "uid")).orderBy(F.col("key").isNull(), "key", "uid")
    order = stored(order.select(F.col("uid").alias("u"), F.monotonically_increasing_id().alias("at")))
    # the places of lines that occur again or are like others, each with its component
    occur = places.join(found, "h", "left").where((F.col("place") != ONLY) | F.col("component").isNotNull())
    occur = stored(occur.select("u", "l", F.coalesce("component", "h").alias("component")).join(order, "u"))
    # stored, so that Spark may split the places of a component that has very many
    first = stored(occur.groupBy("component").agg(F.min("at").alias("first")))
    # in its first document a component keeps a line: the first of those that name it
    gone = occur.join(first, "component").select("u", "l", F.when(F.col("at") == F.col("first"), F.col("component")).alias("keeps"))
    gone = stored(gone.groupBy(F.col("u").alias("uid")).agg(F.collect_list(F.struct("l", "keeps")).alias("gone")))
    joined = plain.join(gone.hint("merge"), "uid", "left").drop("uid")  # as above

    def removed_of(gone: pa.ListArray) -> list[list[int]]:
        """The numbers of the lines that each row loses, in order."""
        n = gone.value_lengths().fill_null(0).to_numpy()
        no, keeps = gone.flatten().flatten()
        row, no = np.repeat(np.arange(len(n)), n), no.to_numpy()
        named, keeps = keeps.is_valid().to_numpy(zero_copy_only=False), keeps.fill_null(0).to_numpy()
        by = np.lexsort((no, keeps, named, row))
        row, no, keeps, named = row[by], no[by], keeps[by], named[by]
        stays = named & np.append(True, (row[1:] != row[:-1]) | (keeps[1:] != keeps[:-1]) | ~named[:-1])[: len(row)]
        row, no = row[~stays], no[~stays].tolist()
        ends = np.searchsorted(row, np.arange(len(n) + 1)).tolist()
        return [no[a:b] for a, b in zip(ends, ends[1:])]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, removed = [], [], []
            for text, gone in zip(strings(batch.column(at)), removed_of(batch.column(batch.num_columns - 1)), strict=True):
                lines = text.split("\n") if text is not None else []
                total.append(len(lines))
                removed.append(len(gone))
                if gone:
                    out = set(gone)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(text)
            columns = [*batch.columns[:-1], pa.array(total, pa.int64()), pa.array(removed, pa.int64())]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_lines", "n_removed"])

    kinds = ", ".join(f"c{i} {'string' if i == at else ddl(plain, f'c{i}')}" for i in range(len(names)))
    result = arrow_map(joined, cut, f"{kinds}, n_lines long, n_removed long").toDF(*names, "n_lines ", "n_removed ")
    clash = [n for n in names if n.lower() in ("n_lines", "n_removed")]
    return result.drop(*clash).withColumnsRenamed({"n_lines ": "n_lines", "n_removed ": "n_removed"})
