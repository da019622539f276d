"""Language-model scores: counts and base score by brute force, the model by
what any probability has to be, and by held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from varlake.llm import lm, word_blocks
from varlake.llm.lm import score_texts
from varlake.llm.queries import QUERIES


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def plain(rows):
    """{id: (held, n_tokens, n_known, N, base_score)} for (id, text, held)."""
    c = Counter(t for _, text, held in rows if not held for t in tokens(text))
    n = sum(c.values())
    out = {}
    for key, text, held in rows:
        ts = tokens(text)
        out[key] = (bool(held), len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 1) / (n + len(c) + 1)) for t in ts))
    return out


def check(got, rows):
    want = plain(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:4]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][4], rel=1e-12)
        assert -1e9 < r["score"] < 0


SCHEMA = "doc_id long, text string, held boolean"


def made(n, seed=0):
    random = np.random.default_rng(seed)
    kinds = [["the", "of", "and", "cat", "dog", "runs"], ["der", "und", "ist", "hund", "läuft"]]
    rows = []
    for i in range(n):
        words = kinds[i % 2]
        text = " ".join(words[min(random.geometric(0.4) - 1, len(words) - 1)] for _ in range(random.integers(1, 80)))
        rows.append((i, text.title() if i % 5 == 0 else text, i % 7 == 2))
    return rows


def test_counts_and_base(spark):
    rows = [*made(60), (100, None, False), (101, "", True), (102, " \t\n\x0b\x0c\r ", None), (103, "New wörter\xa0here\x1cand\x00 x", True), (104, "a" * 50_000 + " b", True)]
    check(score_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), "held").collect(), rows)


@pytest.mark.parametrize("learn", [True, False])
def test_probabilities_add_up_to_less_than_one(spark, learn):
    rows = [(i, t, not learn) for i, t, _ in made(40)]
    words = sorted({w for _, t, _ in rows for w in tokens(t)[:-1]})
    probes = ["", *words, "neu", "x", *(f"{a} {b}" for a in words for b in words)]
    df = spark.createDataFrame(rows + [(1000 + i, p, True) for i, p in enumerate(probes)], SCHEMA)
    got = [r for r in score_texts(df, "held").collect() if r["doc_id"] >= 1000]
    total = sum(10 ** r["score"] for r in got)
    assert 0 < total < 1
    assert total > 0.02 or not learn
    assert all(r["total_bits"] == pytest.approx(-r["score"] * math.log2(10)) for r in got)
    assert all(r["bits_per_byte"] == (pytest.approx(r["total_bits"] / r["n_bytes"]) if r["n_bytes"] else None) for r in got)


def test_blocks_and_groups_don_t_matter(spark, monkeypatch):
    rows = made(200, 3) + [(500, " ".join(f"{a} {b}" for _, a, _ in made(40, 4) for b in "xyz"), False)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {r["doc_id"]: r["score"] for r in score_texts(df, "held").collect()}
    for name, value in (("BLOCK_BYTES", 700), ("GROUP_WORDS", 64)):
        monkeypatch.setattr(lm, name, value)
    monkeypatch.setattr(word_blocks, "PART", 7)
    apart = {r["doc_id"]: r["score"] for r in score_texts(df.repartition(5), "held").collect()}
    assert apart.keys() == whole.keys()
    assert all(apart[k] == pytest.approx(whole[k], rel=1e-3) for k in whole)


def test_learning_helps(spark):
    """Learned texts make texts like them likelier, above all those of one kind of words; repeated ones more so."""
    rows = made(300, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = score_texts(df, "held").where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()
    without = score_texts(spark.createDataFrame([(k, t, True) for k, t, _ in rows], SCHEMA), "held").toPandas().set_index("doc_id")
    assert got.score.sum() > 0.5 * without.loc[got.doc_id].score.sum()


def test_odd_tables(spark):
    """Clashing columns, repeated rows, null ids and text ids, no rows, nothing to learn from."""
    schema = "KEY string, key string, text string, held boolean, n_bytes int, block int"
    df = spark.createDataFrame([("k", None, "a b", False, 1, 1), ("k", "z", "a b", False, 1, 1), ("k", "z", "a b", False, 1, 1)], schema)
    got = score_texts(df, "held", id_col="key").collect()
    assert sorted((r["key"] or "", r["n_tokens"], r["train_tokens"]) for r in got) == [("", 3, 9), ("z", 3, 9), ("z", 3, 9)]
    assert score_texts(df.limit(0), "held", id_col="key").collect() == []
    (only,) = score_texts(spark.createDataFrame([(1, "a", True)], SCHEMA), "held").collect()
    assert (only["n_known"], only["train_tokens"], only["base_score"]) == (0, 0, 0)


def test_registered_scores(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in docs]
    check(QUERIES["op13_lm_scoring"](spark, sf).collect(), rows)
