"""Language-model scores by online logistic context mixing.

A text is its words, lower-cased in A-Z, and an end.  Each is coded by binary
decisions: known or not; a known one by the 16 bits of its hash, then which
of the learned words with that hash it is; an unknown one by the bits of its bytes
and a space.

Several predictors give each bit a probability, from counts of the bit under a
hashed context: none (the bits before it alone); each of the two words before; both
together; the topic that the text so far speaks for; and what the document itself
has had.  In the logistic domain
they are added up with weights, which a gate chooses (the bit's place, and whether
the document has come by there).  The weights learn online, from the text scored
so far; then an adaptive map refines the mixed probability.  A document is taken in
stretches, from 32 words up to 1024 far into it, and learns after each; documents
start alike and don't learn from each other.

1. Texts become blocks of word numbers (``word_blocks``); word counts of all learned
   texts are summed in parts and told to each block that has the word.
2. The context counts are sums over all blocks, in arrays of a fixed number of
   slots (``SLOTS``; 25 MB in all), which every scoring task gets.
3. Each block is scored in one task, many documents at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, ddl, pick, stored, strings, text_or_empty
from varlake.llm.word_blocks import BLOCK_BYTES, VOCAB, Numbers, answers, by_frequency, cells, counted_words, joined, squeezed, stretches, unsqueezed, vocabulary

END = b"\n"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
CODE = 16  #: bits of a word's hash
NEAR = 10  #: bits of it that contexts predict
BOTH = 8  #: bits of it that both words before predict
#: Contexts and outcomes of each predictor's counts: words, then bytes of unknown words.
SLOTS = {"word": (1, 1 << CODE), "one": (256, 1 << NEAR), "two": (256, 1 << NEAR), "both": (1024, 1 << BOTH), "topic": (8, 1 << CODE), "byte1": (256, 256), "byte2": (1024, 256), "byte3": (4096, 256), "byte4": (16384, 256)}
SPELLED = ("byte1", "byte2", "byte3", "byte4")
SLICE = 1 << 14  #: counts in a row
RARE = 5  #: words that occur so often or less teach how unknown words are spelled
GROUP_WORDS = 32_768  #: words of a stretch of all documents that are scored together
RATE, REFINE, BUCKETS = 0.01, 0.02, 24  #: learning rates of weights and map, and its buckets
#: Weights that documents start with, for contexts in the order of SLOTS, the document's own last.
WORD_WEIGHTS, FAR_WEIGHTS, SPELL_WEIGHTS = (0.05, 0.2, 0.2, 0.2, 0.6, 0.2), (0.2, 0.9), (0.1, 0.2, 0.3, 0.5)


def words_of(text: str) -> Iterator[list[bytes]]:
    for part in stretches(text.encode().translate(_LOWER)):
        yield part.split(b" ") if b"" not in (words := part.split(b" ")) else [w for w in words if w]


def codes_of(words: Iterable[bytes]) -> np.ndarray:
    mixed = np.fromiter((crc32(w) for w in words), np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - CODE)).astype(np.int32)


def _before(codes: np.ndarray, place: np.ndarray, by: int) -> np.ndarray:
    """The code of the word ``by`` places before each in its text; 0 where there is none."""
    out = np.zeros_like(codes)
    out[by:] = codes[:-by]
    return np.where(place >= by, out, 0)


def _contexts(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The contexts of each word under "one", "two" and "both"."""
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    one, two = _before(codes, place, 1), _before(codes, place, 2)
    both = (one.astype(np.uint32) * np.uint32(0x9E3779B1) ^ two.astype(np.uint32) * np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35)
    return one & 255, two & 255, (both >> np.uint32(22)).astype(np.int32)


def _topic_axes(one: np.ndarray) -> np.ndarray:
    """(1 << NEAR, 3): how much a word, by the first bits of its code, speaks for
    each of three topics: the main directions in which the counts of words after
    each class of words differ from those of all words."""
    counts = one.reshape(SLOTS["one"]).astype(np.float64)
    rows, share = counts.sum(axis=1, keepdims=True), (counts.sum(axis=0) + 1e-3) / (counts.sum() + 1)
    apart = (counts - rows * share) / np.sqrt((rows + 1) * share)
    axes = np.linalg.svd(apart, full_matrices=False)[2][:3].T / np.sqrt(share)[:, None]
    spread = 3 * axes.std(axis=0)
    return np.clip(axes, -spread, spread)


def _topics(codes: np.ndarray, starts: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The topic, below 8, that the words of a text before each word speak for."""
    sums = np.zeros((len(codes) + 1, 3))
    np.cumsum(axes[codes >> CODE - NEAR], axis=0, out=sums[1:])
    before = sums[:-1] - np.repeat(sums[starts], np.diff(np.append(starts, len(codes))), axis=0)
    return ((before > 1e-9) * np.array([1, 2, 4])).sum(axis=1)


def _spelling(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The bytes of words with a space after each, their contexts, and where words start."""
    data = np.frombuffer(b"".join([w + b" " for w in words]), np.uint8).astype(np.int64)
    lens = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    starts = np.cumsum(lens) - lens
    place = np.arange(len(data)) - np.repeat(starts, lens)
    before = []
    for by in (1, 2, 3, 4):
        b = np.zeros(len(data), np.int64)
        b[by:] = data[:-by]
        before.append(np.where(place >= by, b, 0))
    contexts, mixed = [before[0]], np.zeros(len(data), np.uint64)
    for i, b in enumerate(before):
        mixed = (mixed ^ b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if i:
            contexts.append((mixed % np.uint64(SLOTS[SPELLED[i]][0])).astype(np.int64))
    return data, contexts, starts


def _blocks(df: DataFrame, id_col: str, text_col: str, held_col: str) -> DataFrame:
    """A row per block: its documents (keys, held, words: with the end, bytes), the
    stream, the vocabulary with the counts of learned texts, and the words' codes."""
    rows = pick(df, key=id_col, held=held_col, text=text_col)
    rows = rows.select("key", F.coalesce(F.col("held"), F.lit(False)).alias("held"), text_or_empty(rows.text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, size = TaskContext.get().partitionId(), 0, 0
        taken: list[tuple[str, bytes]] = []
        numbers = Numbers(taken, "")
        keys: list[pa.Scalar] = []
        held: list[bool] = []
        lens: list[int] = []
        sizes: list[int] = []
        streams: list[np.ndarray] = []
        kind = None

        def out() -> pa.RecordBatch:
            stream, old, _ = by_frequency(joined(streams), len(taken))
            learned = np.repeat(~np.array(held), lens)
            counts = np.bincount(stream[learned], minlength=len(old) + 1)[1:]
            words = [taken[i] for i in old.tolist()]
            lists = [pa.array([x], pa.list_(t)) for x, t in ((held, pa.bool_()), (lens, pa.int64()), (sizes, pa.int64()))]
            key_list = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, kind))
            blobs = [pa.array([squeezed(x)], pa.binary()) for x in (stream, codes_of([w for _, w in words]))]
            columns = [pa.array([task << 32 | seq], pa.int64()), key_list, *lists, *blobs, vocabulary(words, counts), pa.array([len(old)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["block", "keys", "held", "lens", "sizes", "stream", "codes", "vocab", "entries"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, is_held, text in zip(batch.column(0), batch.column(1).to_pylist(), strings(batch.column(2)), strict=True):
                parts = [numbers.of(words) for words in words_of(text)]
                streams += [*parts, numbers.of([END])]
                keys.append(key.as_py())
                held.append(is_held)
                lens.append(sum(map(len, parts)) + 1)
                sizes.append(len(text.encode()))
                size += len(text)
                if size > BLOCK_BYTES:
                    yield out()
                    seq, size = seq + 1, 0
                    for x in (taken, numbers, keys, held, lens, sizes, streams):
                        x.clear()
        if keys:
            yield out()

    schema = f"block long, keys array<{ddl(rows, 'key')}>, held array<boolean>, lens array<long>, sizes array<long>, stream binary, codes binary, vocab {VOCAB}, entries long"
    return arrow_map(rows, run, schema)


def _summed(counts: DataFrame) -> dict[str, np.ndarray]:
    """The sums of arrays of counts that came in slices; zeros where none did."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, part, total = None, 0, None
        for batch in batches:
            for n, p, data in cells(batch):
                own = unsqueezed(data, np.int64)
                if (n, p) == (name, part):
                    total = total + own
                    continue
                if total is not None:
                    yield pa.RecordBatch.from_pydict({"name": [name], "part": [part], "counts": [squeezed(total)]})
                name, part, total = n, p, own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"name": [name], "part": [part], "counts": [squeezed(total)]})

    schema = "name string, part long, counts binary"
    found = {n: np.zeros(a * b, np.int64) for n, (a, b) in SLOTS.items()}
    # at most the number of slots / SLICE rows, whatever the input
    for r in arrow_map(counts.repartition("name", "part").sortWithinPartitions("name", "part"), run, schema).collect():
        if r["name"] in found:
            found[r["name"]][r["part"] * SLICE : (r["part"] + 1) * SLICE] = unsqueezed(bytes(r["counts"]), np.int64)
    return found


def _in_slices(arrays: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, counts in arrays.items():
        for p in range(0, len(counts), SLICE):
            if (part := counts[p : p + SLICE]).any():
                yield pa.RecordBatch.from_pydict({"name": [name], "part": pa.array([p // SLICE], pa.int64()), "counts": [squeezed(part)]})


def _word_counts(blocks: DataFrame) -> DataFrame:
    """Counts of learned words by context, one sum per task, in slices."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {n: np.zeros(SLOTS[n][0] * SLOTS[n][1], np.int64) for n in ("word", "one", "two", "both")}
        for batch in batches:
            for held, lens, stream, codes in cells(batch):
                words = unsqueezed(codes)[unsqueezed(stream) - 1]
                sizes = np.array(lens)
                learned = np.repeat(~np.array(held), sizes)
                one, two, both = (c[learned] for c in _contexts(words, np.cumsum(sizes) - sizes))
                words = words[learned]
                for n, slot in (("word", words), ("one", one << NEAR | words >> CODE - NEAR), ("two", two << NEAR | words >> CODE - NEAR), ("both", both << BOTH | words >> CODE - BOTH)):
                    sums[n] += np.bincount(slot, minlength=len(sums[n]))
        yield from _in_slices(sums)

    return arrow_map(blocks.select("held", "lens", "stream", "codes"), run, "name string, part long, counts binary")


def _topic_counts(blocks: DataFrame, axes: np.ndarray) -> DataFrame:
    """Counts of learned words by topic, likewise."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS["topic"][0] * SLOTS["topic"][1], np.int64)
        for batch in batches:
            for held, lens, stream, codes in cells(batch):
                words = unsqueezed(codes)[unsqueezed(stream) - 1]
                sizes = np.array(lens)
                learned = np.repeat(~np.array(held), sizes)
                slot = _topics(words, np.cumsum(sizes) - sizes, axes) << CODE | words
                total += np.bincount(slot[learned], minlength=len(total))
        yield from _in_slices({"topic": total})

    return arrow_map(blocks.select("held", "lens", "stream", "codes"), run, "name string, part long, counts binary")


def _spelling_counts(rare: DataFrame) -> DataFrame:
    """Counts of the bytes of rare words by context, likewise."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {n: np.zeros(SLOTS[n][0] * SLOTS[n][1], np.int64) for n in SPELLED}
        for batch in batches:
            data, contexts, _ = _spelling([w.encode() for w in batch.column(0).to_pylist()])
            for n, c in zip(SPELLED, contexts, strict=True):
                sums[n] += np.bincount(c << 8 | data, minlength=len(sums[n]))
        yield from _in_slices(sums)

    return arrow_map(rare, run, "name string, part long, counts binary")


def stretched(counts: np.ndarray, outcomes: int, more: float) -> np.ndarray:
    """ln(p / (1 - p)) of a 1 at each node of the bits of an outcome, under each
    context: (contexts, outcomes), the node being the bits before with a 1 in
    front.  ``more`` is added to both counts."""
    level = counts.reshape(-1, outcomes).astype(np.float64)
    out = np.zeros(level.shape, np.float32)
    while level.shape[1] > 1:
        zero, one = level[:, 0::2], level[:, 1::2]
        out[:, zero.shape[1] : 2 * zero.shape[1]] = np.log((one + more) / (zero + more))
        level = zero + one
    return np.clip(out, -12, 12)


def tables_of(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """``stretched`` counts; a topic with few words under a node is filled up with
    words of all topics."""
    word, topics = counts["word"], counts["topic"].reshape(SLOTS["topic"])
    filled = topics + 4 * (word + 0.01) / (word.sum() + 1)
    tables = {n: stretched(c, SLOTS[n][1], {"word": 0.02, "topic": 0}.get(n, 0.4 if n[:4] != "byte" else 0.1)) for n, c in counts.items() if n != "topic"}
    return {**tables, "topic": stretched(filled, SLOTS["topic"][1], 1e-6)}


class Model(NamedTuple):
    tokens: int  #: learned words and ends
    words: int  #: distinct ones
    singles: int  #: that occur once
    leaf: np.ndarray  #: learned words and ends by code
    axes: np.ndarray  #: of topics
    tables: dict[str, np.ndarray]


class _Mixer:
    """Weights and map for some gates of each of ``n`` documents."""

    def __init__(self, n: int, gates: int, weights: tuple[float, ...]):
        self.gates = gates
        self.weights = [np.full(n * gates, w, np.float32) for w in weights]
        middle = (np.arange(BUCKETS) - (BUCKETS - 1) / 2) / 2
        self.map = np.tile((1 / (1 + np.exp(-middle))).astype(np.float32), n * gates)

    def score(self, doc: np.ndarray, gate: np.ndarray, inputs: list[np.ndarray], bits: np.ndarray, docs: int) -> np.ndarray:
        """ln of the probability of each bit; then learns.  All (rows, bits)
        but ``doc``, the document of each row, below ``docs``."""
        cell = doc[:, None] * self.gates + gate
        dot = np.zeros(bits.shape, np.float32)
        for w, x in zip(self.weights, inputs, strict=False):
            dot += w[cell] * x
        np.clip(dot, -12, 12, out=dot)
        p = 1 / (1 + np.exp(-dot))
        slot = cell * BUCKETS + np.clip((dot * 2 + BUCKETS / 2).astype(np.int32), 0, BUCKETS - 1)
        final = 0.8 * p + 0.2 * self.map[slot]
        out = np.log(np.where(bits, final, 1 - final))
        n = docs * self.gates
        flat = cell.ravel()
        seen = np.bincount(flat, minlength=n)
        step = (RATE / (1 + seen / 64)).astype(np.float32)
        error = bits - p
        for w, x in zip(self.weights, inputs, strict=False):
            w[:n] += step * np.bincount(flat, (error * x).ravel(), n)
        slot = slot.ravel()
        ones, all_ = np.bincount(slot, bits.ravel(), n * BUCKETS), np.bincount(slot, minlength=n * BUCKETS)
        part = self.map[: n * BUCKETS]
        part += (ones - all_ * part) * (REFINE / (1 + REFINE * all_))
        return out


def _nodes(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The node before each of the ``bits`` bits of each code, and the bits."""
    j = np.arange(bits, dtype=codes.dtype)
    above = codes[:, None] >> (bits - j)
    return above | (1 << j), (codes[:, None] >> (bits - 1 - j) & 1).astype(bool)


def _score_block(model: Model, lens: np.ndarray, stream: np.ndarray, codes: np.ndarray, counts: np.ndarray, words: list[bytes]) -> np.ndarray:
    """ln of the model's probability of each document of a block.  ``counts`` are
    those of the learned texts for each number, ``words`` the words."""
    tables = model.tables
    starts = np.cumsum(lens) - lens
    out = np.zeros(len(lens))
    word = stream - 1
    code = codes[word]
    contexts = _contexts(code, starts)
    topic = _topics(code, starts, model.axes)
    known = counts[word] > 0
    # which of the learned words with this hash it is
    rest = np.zeros(len(codes))
    has = counts > 0
    rest[has] = np.log(counts[has] / model.leaf[codes[has]])
    rate = (model.singles + 0.5) / (model.tokens + 1)
    order = np.argsort(-lens, kind="stable")
    at = 0
    while at < len(order):
        longest = int(lens[order[at]])
        docs = order[at : at + max(1, GROUP_WORDS // max(32, min(longest, 1024, longest // 4)))]
        at += len(docs)
        first, size = starts[docs], lens[docs]
        near, far, spell = _Mixer(len(docs), 2 * NEAR, WORD_WEIGHTS), _Mixer(len(docs), CODE - NEAR, FAR_WEIGHTS), _Mixer(len(docs), 8, SPELL_WEIGHTS)
        seen, ones = np.zeros(len(docs) << NEAR, np.float32), np.zeros(len(docs) << NEAR, np.float32)
        strange = np.zeros(len(docs))
        done = 0
        while done < longest:
            ahead = min(1024, max(32, done // 4))
            alive = int((size > done).sum())
            n = np.minimum(size[:alive] - done, ahead)
            doc = np.repeat(np.arange(alive), n)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:alive] + done, n)
            ln = np.zeros(len(doc))
            # known or not
            is_known = known[place]
            p = ((strange[:alive] + 20 * rate) / (done + 20))[doc]
            ln += np.log(np.where(is_known, 1 - p, p))
            strange[:alive] += np.bincount(doc, ~is_known, alive)
            # known words
            mine, its = place[is_known], doc[is_known]
            if len(mine):
                nodes, bits = _nodes(code[mine], CODE)
                close = nodes[:, :NEAR]
                own = its[:, None] << NEAR | close
                been, had = seen[own], ones[own]
                inputs = [
                    tables["word"][0][close],
                    tables["one"].ravel()[contexts[0][mine, None] << NEAR | close],
                    tables["two"].ravel()[contexts[1][mine, None] << NEAR | close],
                    np.zeros(close.shape, np.float32),
                    tables["topic"].ravel()[topic[mine, None] << CODE | close],
                    np.log((had + 0.4) / (been - had + 0.4)),
                ]
                inputs[3][:, :BOTH] = tables["both"].ravel()[contexts[2][mine, None] << BOTH | close[:, :BOTH]]
                gate = 2 * np.arange(NEAR) + (been > 0)
                gain = near.score(its, gate, inputs, bits[:, :NEAR], alive).sum(axis=1)
                deep = nodes[:, NEAR:]
                inputs = [tables["word"][0][deep], tables["topic"].ravel()[topic[mine, None] << CODE | deep]]
                gain += far.score(its, np.arange(CODE - NEAR)[None, :], inputs, bits[:, NEAR:], alive).sum(axis=1)
                ln[is_known] += gain + rest[word[mine]]
                flat = own.ravel()
                seen[: alive << NEAR] += np.bincount(flat, minlength=alive << NEAR)
                ones[: alive << NEAR] += np.bincount(flat, bits[:, :NEAR].ravel(), alive << NEAR)
            # unknown words
            if not is_known.all():
                which = np.flatnonzero(~is_known)
                data, around, begins = _spelling([words[i] for i in word[place[which]].tolist()])
                long = np.diff(np.append(begins, len(data)))
                nodes, bits = _nodes(data, 8)
                inputs = [tables[n].ravel()[c[:, None] << 8 | nodes] for n, c in zip(SPELLED, around, strict=True)]
                gain = spell.score(np.repeat(doc[which], long), np.arange(8)[None, :], inputs, bits, alive).sum(axis=1)
                ln[which] += np.add.reduceat(gain, begins)
            out[docs[:alive]] += np.bincount(doc, ln, alive)
            done += ahead
    return out


def score_texts(df: DataFrame, held_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes,
    total_bits, bits_per_byte) of every row: what a model that has learned from the
    rows where ``held_col`` is not true gives.

    ``score`` is the log10 probability of the words and the end of the text,
    ``total_bits`` the same in bits, ``bits_per_byte`` over the UTF-8 bytes of the
    text (null without any).  ``base_score`` adds up log10((c + 1) / (N + V + 1)).
    Null text counts as empty, a null ``held_col`` as false; repeated rows are
    learned from as often as they come; without learned rows all words are
    unknown; an empty table gives no rows."""
    blocks = stored(_blocks(df, id_col, text_col, held_col))
    counted = counted_words(blocks, blocks.agg(F.sum("entries")).first()[0], 1)
    singles, words, tokens = counted.agg(F.count_if(F.col("f") == 1), F.count("number"), F.coalesce(F.sum("total"), F.lit(0))).first()
    rare = counted.where(F.col("f") <= RARE).select("w")
    counts = _summed(_word_counts(blocks).unionByName(_spelling_counts(rare)))
    axes = _topic_axes(counts["one"])
    counts["topic"] = _summed(_topic_counts(blocks, axes))["topic"]
    model = Model(tokens, words, singles, counts["word"], axes, tables_of(counts))
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for i in range(batch.num_rows):
                held, lens, sizes, stream, codes, vocab, told = (c[i].as_py() for c in batch.columns[1:])
                stream, codes = unsqueezed(stream), unsqueezed(codes)
                lens = np.array(lens, np.int64)
                counts = np.zeros(len(codes), np.int64)
                for x in told or ():
                    counts[unsqueezed(x["at"])] = unsqueezed(x["counts"], np.int64)
                words: list[bytes] = [b""] * len(codes)
                for entry in vocab:
                    for j, w in zip(unsqueezed(entry["at"]).tolist(), zstandard.ZstdDecompressor().decompress(entry["words"]).split(b" "), strict=True):
                        words[j] = w
                starts = np.cumsum(lens) - lens
                base = np.log10((counts + 1) / (tokens + model.words + 1))
                columns = [
                    keys[i].values,
                    pa.array(held, pa.bool_()),
                    pa.array(lens),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64)[stream - 1], starts)),
                    pa.array(np.full(len(lens), tokens)),
                    pa.array(np.add.reduceat(base[stream - 1], starts)),
                    pa.array(_score_block(model, lens, stream, codes, counts, words) / np.log(10)),
                    pa.array(sizes, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    whole = blocks.select("block", "keys", "held", "lens", "sizes", "stream", "codes", "vocab").join(answers(counted), "block", "left").drop("block")
    scored = arrow_map(whole, run, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")
    bits = -F.col("score") / float(np.log10(2))
    return scored.select(F.col("key").alias(id_col), *names[1:], bits.alias("total_bits"), F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"))
