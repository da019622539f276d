"""Token operators against the tokenizers library."""

import hashlib
import os
import zlib

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from varlake.llm import codec as codec_module
from varlake.llm.bpe import bpe_decode, bpe_encode
from varlake.llm.codec import Codec, codec
from varlake.llm.packing import pack_documents, plan_packing
from varlake.llm.queries import QUERIES
from varlake.llm.token_counts import token_counts

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
ODD = [
    None, "", " ", "\n\n", " lead", "trail ", "a  b", "tab\t x", "I'll've don't", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ ΟΔΟΣ", "İstanbul é",
    "x\x1cy\x1dz", "a\x85b\xa0c d", "½²③ 1234", "你好，世界。再见", "😀😀 👨‍👩‍👧", "aaaaaaaaaaaaaaaa" * 30, "abc" * 3_000, "word " * 3_000, "\x00 ​",
]


def ids_of(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


@pytest.fixture
def odd(spark):
    rows = [(i, t, "x", -1) for i, t in enumerate(ODD)] + [(1, "", "x", -1), (None, "null id", "y", -1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from(list("abeth 's\n\t.,!é<|>endoftxsar 12Σß́\x1c\xa0日")), max_size=60))
def test_codec_is_the_library(path, text):
    c = codec(path)
    ids = np.frombuffer(next(c.encode([text])), "<u4").tolist()
    assert ids == ids_of(path, text)
    assert c.decode(ids) == LIBRARY[path].decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_that_greedy_gets_wrong_are_merged_exactly(path):
    random = np.random.default_rng(5)
    words = ["".join(random.choice(list("aeinorst"), size=n)) for n in random.integers(1, 120, 400)]
    c = Codec(path)
    got = list(c.encode(words))
    assert c.repaired > 50
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(path, w) for w in words]


def test_compatibility_agrees_with_merging():
    t = codec(WORD).tables
    random = np.random.default_rng(6)
    plain = np.array([i for i, s in enumerate(t.strings) if s and not s.endswith("</w>") and i not in t.special.values()])
    any_ = np.array([i for i, s in enumerate(t.strings) if s and i not in t.special.values()])
    a, b = random.choice(plain, 3_000), random.choice(any_, 3_000)

    def symbols(i):
        return [i] if t.left[i] < 0 else symbols(int(t.left[i])) + symbols(int(t.right[i]))

    want = [t.merge_long(symbols(int(x)) + symbols(int(y))) == [x, y] for x, y in zip(a, b)]
    assert t.compatible(a, b).tolist() == want


@pytest.mark.parametrize("limit", [1, 3])
def test_long_texts_and_small_caches_change_nothing(monkeypatch, limit):
    monkeypatch.setattr(codec_module, "GROUP_CHARS", 50)
    monkeypatch.setattr(codec_module, "CACHE_UNITS", limit)
    text = "The cat's  hat, the\n\ncat sat. " * 30
    for path in (WORD, BYTE):
        c = Codec(path)
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for b in c.encode([text, "x", ""])] == [ids_of(path, t) for t in (text, "x", "")]


def test_encode_and_decode(odd):
    got = sorted(((r["doc_id"], r["ids"]) for r in bpe_encode(odd, WORD).collect()), key=str)
    assert got == sorted([(i, ids_of(WORD, t)) for i, t in enumerate(ODD)] + [(1, []), (None, ids_of(WORD, "null id"))], key=str)
    back = bpe_decode(bpe_encode(odd, WORD).withColumnRenamed("ids", "n"), WORD, ids_col="n", keep=("n",)).collect()
    assert all(r["text"] == LIBRARY[WORD].decode(r["n"], skip_special_tokens=False) for r in back)


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, 320, 10**6, -1])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe_decode(df, WORD).collect()} == {1: "", 2: "", 3: LIBRARY[WORD].decode([320], skip_special_tokens=False)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_encode(none, WORD).isEmpty() and token_counts(none, BYTE).isEmpty() and pack_documents(none, WORD).isEmpty()


@pytest.mark.parametrize("sizes", [(65_536, 32_768, 1_024), (40, 60, 40), (0, 33, 33)])
def test_token_counts(odd, sizes):
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts(odd, BYTE, huge_chars=sizes[0], chunk_chars=sizes[1], overlap_chars=sizes[2]).collect()), key=str)
    rows = [*enumerate(ODD), (1, ""), (None, "null id")]
    assert got == sorted([(i, len((t or "").encode()), len(ids_of(BYTE, t))) for i, t in rows], key=str)


def test_overlaps_widen_until_chunks_align(spark):
    texts = ["x" * 5_000, "ab" * 900 + " " + "c d " * 300 + "q" * 700, " " * 3_000 + "a" + "\n" * 2_000, "<|endoftext|>" * 400, "。".join(["日本語" * 200] * 5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(df, BYTE, huge_chars=100, chunk_chars=100, overlap_chars=50).collect()}
    assert got == {i: len(ids_of(BYTE, t)) for i, t in enumerate(texts)}


def check_packing(rows, texts, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*ids_of(WORD, text), 0]
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // capacity)))
        for r in parts:
            own = ids[r["start"] : r["start"] + capacity]
            assert r["start"] == capacity * r["piece"] and r["length"] == len(own)
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_odd_texts(spark, odd):
    rows = pack_documents(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), WORD, capacity=64).collect()
    check_packing(rows, dict(enumerate(ODD)), 64)
    assert len(pack_documents(odd.where("doc_id = 1 or doc_id is null"), WORD).collect()) == 3


def test_registered_token_queries(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op1_bpe_encode_decode"](spark, sf).collect()} == {
        i: (
            len(ids_of(WORD, t)),
            hashlib.sha256(" ".join(map(str, ids_of(WORD, t))).encode()).hexdigest(),
            hashlib.sha256(LIBRARY[WORD].decode(ids_of(WORD, t), skip_special_tokens=False).encode()).hexdigest(),
        )
        for i, t in docs.items()
    }
    assert {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_token_counts"](spark, sf).collect()} == {
        i: (len(t.encode()), len(ids_of(BYTE, t)), len(ids_of(BYTE, t)) > 512) for i, t in docs.items()
    }
    n = check_packing(QUERIES["op4_best_fit_packing"](spark, sf).collect(), docs, 2048)
    least = -(-sum(len(ids_of(WORD, t)) + 1 for t in docs.values()) // 2048)
    assert least <= n <= 1.01 * least + 1


@settings(max_examples=200, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=12))
def test_plans_use_every_piece_once(counts):
    plan = plan_packing(counts, 32)
    used: dict[int, int] = {}
    for lengths, times in plan:
        assert times > 0 and sum(lengths) <= 32
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    assert sum(t for _, t in plan) <= 2 * total / 32 + 2


def test_exact_complements_are_found():
    assert sum(t for _, t in plan_packing({1500: 10, 548: 10}, 2048)) == 10
    assert sum(t for _, t in plan_packing({1500: 7, 300: 7, 248: 7}, 2048)) == 7
    assert sum(t for _, t in plan_packing({1200: 5, 400: 5, 248: 5, 200: 5}, 2048)) == 5
    with pytest.raises(ValueError):
        plan_packing({0: 1}, 8)
