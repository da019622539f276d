"""Phrase collocations from sorted count streams.

Phrases of one to ``max_words`` words are counted, those that occur at least
``min_count`` times are kept in two streams, one in prefix order and one in
suffix order, and each stream is walked once, in lockstep with the shorter
phrases that begin it:

1. Texts become blocks of word numbers (``word_blocks``).  Word counts over all
   blocks number the frequent words, and each block is told those of its words.
2. Length by length, a block counts the phrases whose two parts (all but the last
   word, all but the first) are frequent.  A phrase is never more frequent than its
   parts, so none is missed.  Counts are dealt to parts and summed there by sorting,
   and each block is told which of its own phrases are frequent.
3. In prefix order (words by their numbers), a phrase stands right after the phrases that begin it, so a
   stack of at most ``max_words`` open phrases gives the counts of all first parts
   of a phrase, and to each phrase the highest count among its extensions by a word
   to the right.  The same over reversed phrases, in suffix order, gives last parts
   and extensions to the left.  Streams are cut every ``STEP`` phrases by their
   place, however many begin alike; the open phrases at a cut are put before it.

A phrase inside a longer one is inside one that is longer by one word and no less
frequent than that, so extensions by one word tell whether it is absorbed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, pick, stored, strings, text_or_empty
from varlake.llm.word_blocks import BLOCK_BYTES, VOCAB, Numbers, answers, by_frequency, cells, counted_words, joined, parts_for, squeezed, stretches, unsqueezed, vocabulary
from varlake.operators.joins import with_row_index

STEP = 20_000  #: phrases of a stream walked at a time
#: What ends a piece, and what stands between words.
ENDS, BETWEEN = b".,;:!?\n\x0b\x0c\r", b" \t"
BREAK = b"\xff"  #: stands for the end of a piece; no UTF-8 text has this byte
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS + BETWEEN, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(ENDS) + b" " * len(BETWEEN))


def pieces(text: str) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased in A-Z, with BREAK at the end of each piece."""
    for part in stretches(text.encode().translate(_PLAIN)):
        yield part.replace(b"\n", b" " + BREAK + b" ").split()


def _blocks(df: DataFrame, text_col: str, group_col: str, unnamed: str) -> DataFrame:
    """(block, stream, vocab, entries: of the vocabulary)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        groups: dict[str, Numbers] = {}
        taken: list[tuple[str, bytes]] = []
        streams: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            stream, old, counts = by_frequency(joined(streams), len(taken))
            vocab = vocabulary([taken[i] for i in old.tolist()], counts)
            columns = [pa.array([task << 32 | seq], pa.int64()), pa.array([squeezed(stream)], pa.binary()), vocab, pa.array([len(old)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["block", "stream", "vocab", "entries"])

        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                if group not in groups:
                    groups[group] = Numbers(taken, group)
                    groups[group][BREAK] = 0
                for words in pieces(text):
                    streams.append(groups[group].of(words))
                streams.append(np.zeros(1, np.int32))
                held += len(text)
                if held > BLOCK_BYTES:
                    yield out()
                    seq, held = seq + 1, 0
                    groups.clear(), taken.clear(), streams.clear()
        if streams:
            yield out()

    rows = pick(df, grp=group_col, text=text_col)
    rows = rows.select(F.coalesce(F.col("grp").cast("string"), F.lit(unnamed)).alias("grp"), text_or_empty(rows.text).alias("text"))
    return arrow_map(rows, run, f"block long, stream binary, vocab {VOCAB}, entries long")


def _thinned(wanted: np.ndarray) -> np.ndarray:
    """Which places to keep: the wanted, and one after each run of them."""
    return wanted | np.append(False, wanted[:-1])


_STATE = "block long, stream binary, numbers binary, starts binary, entries long"


def _state(block: int, stream: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([x], pa.binary()) for x in (squeezed(stream), squeezed(numbers), np.packbits(starts).tobytes())]
    entries = int((starts[:-1] & starts[1:]).sum())
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *columns, pa.array([entries], pa.int64())], ["block", "stream", "numbers", "starts", "entries"])


def _with_frequent_words(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """Blocks with only their frequent words: the stream of words numbered within
    the block, the corpus-wide number of each, where a frequent word stands, and
    how many phrases of two words there are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, told in cells(batch):
                at, numbers = joined(unsqueezed(x["at"]) for x in told), joined((unsqueezed(x["numbers"], np.int64) for x in told), np.int64)
                order = np.argsort(at)
                at, numbers = at[order], numbers[order]
                stream = unsqueezed(data)
                own = np.zeros(max(int(stream.max(initial=0)), int(at[-1]) + 1) + 1, np.int32)
                own[at + 1] = np.arange(1, len(at) + 1)
                stream = own[stream]
                stream = stream[_thinned(stream > 0)]
                yield _state(block, stream, numbers, stream > 0)

    return arrow_map(blocks.select("block", "stream").join(found, "block"), run, _STATE)


def _opened(stream: bytes, numbers: bytes, starts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = unsqueezed(stream)
    return words, unsqueezed(numbers, np.int64), np.unpackbits(np.frombuffer(starts, np.uint8), count=len(words)).view(bool)


def _numbered(columns: Iterable[np.ndarray]) -> np.ndarray:
    """A number for each row of these columns, equal for equal rows and in order from 0 on."""
    which = None
    for column in columns:
        own = np.unique(column, return_inverse=True)[1]
        which = own if which is None else np.unique(which << 32 | own, return_inverse=True)[1]
    return which


def _phrases(stream: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of ``size`` words stand whose two parts are frequent, and a
    number for each, equal for equal phrases and in order from 0 on."""
    at = np.flatnonzero(starts[:-1] & starts[1:])
    which = stream[at].astype(np.int64)
    for i in range(1, size):
        which = np.unique(which << 32 | stream[at + i], return_inverse=True)[1]
    return at, which


def _counted_phrases(state: DataFrame, size: int, least: int) -> DataFrame:
    """As ``counted_words``, for the phrases of ``size`` words whose two parts are
    frequent: rows (w, f), and answers (block, told: which of its phrases)."""
    parts = parts_for(state.agg(F.sum("entries")).first()[0])

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *row in cells(batch):
                stream, numbers, starts = _opened(*row)
                at, which = _phrases(stream, starts, size)
                n = np.bincount(which)
                one = np.zeros(len(n), np.int64)
                one[which] = at
                words = [numbers[stream[one + i] - 1] for i in range(size)]
                mixed = np.zeros(len(n), np.uint64)
                for w in words:
                    mixed = (mixed ^ w.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(32)
                part = (mixed % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                ends = np.searchsorted(part[order], np.arange(parts + 1))
                rows = []
                for p in np.flatnonzero(np.diff(ends)).tolist():
                    own = order[ends[p] : ends[p + 1]]
                    rows.append((p, block, squeezed(np.concatenate([w[own] for w in words])), squeezed(n[own]), squeezed(own.astype(np.int32))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["part", "block", "words", "n", "which"])

    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            words = [joined((h[1][i] for h in held), np.int64) for i in range(size)]
            number = _numbered(words)
            total = np.zeros(int(number.max(initial=-1)) + 1, np.int64)
            ends = np.cumsum([0, *(len(h[2]) for h in held)]).tolist()
            for (_, _, n, _), a, b in zip(held, ends, ends[1:], strict=False):
                total[number[a:b]] += n  # the phrases of one block differ
            frequent = total >= least
            rows: list[tuple] = []
            for (block, _, _, which), a, b in zip(held, ends, ends[1:], strict=False):
                if (has := frequent[number[a:b]]).any():
                    rows.append((block, squeezed(which[has]), None, None))
            one = np.zeros(len(total), np.int64)
            one[number] = np.arange(len(number))
            at = one[frequent]
            rows += [(None, None, w, f) for w, f in zip(np.stack([w[at] for w in words], axis=1).tolist(), total[frequent].tolist(), strict=True)]
            for a in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 20_000], strict=True), kinds, strict=True)], ["block", "told", "w", "f"])

        for batch in batches:
            for p, block, words, n, which in cells(batch):
                if p != part:
                    yield from out()
                    part, held = p, []
                held.append((block, unsqueezed(words, np.int64).reshape(size, -1), unsqueezed(n, np.int64), unsqueezed(which)))
        yield from out()

    dealt = arrow_map(state.select("block", "stream", "numbers", "starts"), deal, "part long, block long, words binary, n binary, which binary")
    dealt = dealt.repartition("part").sortWithinPartitions("part")
    return stored(arrow_map(dealt, gather, "block long, told binary, w array<long>, f long"))


def _with_frequent_phrases(state: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """Blocks with only the places of frequent phrases of ``size`` words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *row, told in cells(batch):
                stream, numbers, starts = _opened(*row)
                at, which = _phrases(stream, starts, size)
                frequent = np.zeros(int(which.max(initial=0)) + 1, bool)
                frequent[joined(unsqueezed(x) for x in told)] = True
                at = at[frequent[which]]
                starts = np.zeros(len(stream), bool)
                starts[at] = True
                covered = starts.copy()
                for i in range(1, size):
                    covered[at + i] = True
                keep = _thinned(covered)
                yield _state(block, np.where(covered, stream, 0)[keep].astype(np.int32), numbers, starts[keep])

    told = found.where(F.col("block").isNotNull()).groupBy("block").agg(F.collect_list("told").alias("told"))
    return arrow_map(state.join(told, "block").select("block", "stream", "numbers", "starts", "told"), run, _STATE)


def _walked(stream: DataFrame) -> DataFrame:
    """(w, f, parts, ext) for ``stream`` (w: a phrase as an array, f: its count),
    which has with each phrase all that begin it: the counts of the shorter phrases
    that begin it, and the highest count of one that is longer by one word.  A
    phrase may come several times, in part."""
    placed = with_row_index(stream, ["w"], "place").withColumn("cut", F.floor((F.col("place") - 1) / STEP))
    # what begins the first phrase after a cut
    opens = placed.where((F.col("place") - 1) % STEP == 0).where(F.size("w") > 1)
    opens = opens.select("cut", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda n: F.slice("w", 1, n))).alias("w"))
    opens = opens.join(stream, "w").select("w", "f", "cut", F.lit(False).alias("own"))
    dealt = placed.select("w", "f", "cut", F.lit(True).alias("own")).unionByName(opens)
    dealt = dealt.repartition("cut").sortWithinPartitions("cut", "w").select("cut", "own", "f", "w")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        open_: list[list] = []  # [phrase, own, count, counts of what begins it, highest extension]
        done: list[list] = []

        def close(n: int) -> None:
            while len(open_) > n:
                done.append(open_.pop())

        def out() -> pa.RecordBatch:
            rows = [(w, f if own else None, parts if own else None, ext) for w, own, f, parts, ext in done if len(w) > 1 and (own or ext)]
            done.clear()
            columns = zip(*rows, strict=True) if rows else [[], [], [], []]
            kinds = [pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["w", "f", "parts", "ext"])

        for batch in batches:
            for cut, own, f, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cut != here:
                    close(0)
                    here = cut
                while open_ and open_[-1][0] != w[: len(open_[-1][0])]:
                    done.append(open_.pop())
                parts = []
                if open_:
                    before = open_[-1]
                    parts = [*before[3], before[2]]
                    before[4] = max(before[4] or 0, f)
                open_.append([w, own, f, parts, None])
            yield out()
        close(0)
        yield out()

    return arrow_map(dealt, run, "w array<long>, f long, parts array<long>, ext long")


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def mine_phrases(
    df: DataFrame,
    min_count: int = 30,
    max_words: int = 4,
    absorbed_percent: int = 80,
    top: int = 2000,
    text_col: str = "text",
    group_col: str = "lang",
    unnamed: str = "und",
) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to
    ``max_words`` words of each group (null: ``unnamed``).

    A phrase of a occurrences, cut in two parts of l and r, scores
    floor(2000000 a / (l + r)); the lowest cut counts, of equal ones the first.
    A phrase is left out if a longer one that contains it occurs at least
    ``absorbed_percent`` percent as often.  Ties go to the higher a, then to the
    phrase that comes first in UTF-8.  Null and empty texts have no words; each
    repeated row counts; an empty table gives no rows."""
    blocks = stored(_blocks(df, text_col, group_col, unnamed))
    counted = counted_words(blocks, blocks.agg(F.sum("entries")).first()[0], min_count)
    totals = counted.where(F.col("total").isNotNull()).groupBy("g").agg(F.sum("total").alias("n"))
    frequent = counted.where(F.col("number").isNotNull()).select("number", "g", "w", "f")
    state = stored(_with_frequent_words(blocks, answers(counted)))
    streams = [frequent.select(F.array("number").alias("w"), "f")]
    for size in range(2, max_words + 1):
        found = _counted_phrases(state, size, min_count)
        streams.append(found.where(F.col("f").isNotNull()).select("w", "f"))
        if size < max_words:
            state = stored(_with_frequent_phrases(state, found, size))
    stream = stored(reduce(DataFrame.unionByName, streams))
    left = _walked(stream).select("w", "f", F.col("parts").alias("l"), F.lit(None).cast("array<long>").alias("r"), "ext")
    right = _walked(stream.select(F.reverse("w").alias("w"), "f")).select(F.reverse("w").alias("w"), "f", F.lit(None).cast("array<long>").alias("l"), F.col("parts").alias("r"), "ext")
    both = left.unionByName(right).groupBy("w").agg(*(F.max(c).alias(c) for c in ("f", "l", "r", "ext")))
    kept = stored(both.where(F.col("ext").isNull() | (_exact("ext") * 100 < _exact("f") * absorbed_percent)))

    def cut(k: Column) -> Column:
        first, rest = F.element_at("l", k), F.element_at("r", F.size("w") - k)
        return F.struct(F.call_function("div", _exact("f") * F.lit(2_000_000).cast("decimal(7,0)"), _exact(first) + _exact(rest)).alias("score"), k.alias("k"), first.alias("l"), rest.alias("r"))

    lowest = F.array_min(F.transform(F.sequence(F.lit(1), F.size("w") - 1), cut))
    scored = kept.select("w", F.col("f").alias("a"), lowest.alias("cut"))
    # back to words
    spelled = scored.select("*", F.posexplode("w").alias("i", "number")).join(frequent.select("number", "g", F.col("w").alias("word")), "number")
    spelled = spelled.groupBy("w").agg(
        F.first("a").alias("a"),
        F.first("cut").alias("cut"),
        F.first("g").alias("g"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"),
    )
    ranked = spelled.select("g", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("g").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "g").select(F.col("g").alias(group_col), "rank", "phrase", "a", "l", "r", "n", "score")
